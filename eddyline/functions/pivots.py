"""Exact top-k search by cells of a corpus: what tasks do on Arrow batches.

Kept free of Spark imports, so Python workers load it quickly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from eddyline.functions.search import SCORE_DIGITS, _top_k, unit_rows

RING = 0.05  # radians between the rings of a pivot
NO_ANGLE = -1  # the pivot of vectors of length zero, whose score is 0 with all others
# A score is rounded, and angles near 0 are known to about the root of a cosine's error.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 2e-9


def matrix(column, n: int) -> np.ndarray:
    cells = column.flatten().to_numpy(zero_copy_only=False)
    return unit_rows(cells.astype(np.float64, copy=False).reshape(n, -1))


def angles(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ pivots.T, -1.0, 1.0))


def assign(pivots: np.ndarray):
    """mapInArrow body: adds each row's nearest pivot and the ring it lies on."""

    def body(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            units = matrix(batch.column("vector"), batch.num_rows)
            apart = angles(units, pivots)
            pivot = apart.argmin(1)
            ring = np.floor(apart[np.arange(len(pivot)), pivot] / RING).astype(np.int32)
            zero = ~units.any(1)
            pivot[zero], ring[zero] = NO_ANGLE, 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(pivot.astype(np.int32)), pa.array(ring)], names=["id", "vector", "pivot", "ring"]
            )

    return body


def best_possible(units: np.ndarray, pivots: np.ndarray, cell_pivot: np.ndarray, cell_ring: np.ndarray) -> np.ndarray:
    """The highest score that a row of each cell can have with each query.

    A row on a ring is between two angles from its pivot, and by the triangle inequality its
    angle from a query is no less than the gap between the query's own angle and these.
    """
    apart = np.zeros((len(units), len(cell_pivot)))
    turned = cell_pivot != NO_ANGLE
    to_pivot = angles(units, pivots)[:, cell_pivot[turned]]
    low = cell_ring[turned] * RING
    apart[:, turned] = np.maximum(np.maximum(to_pivot - (low + RING), low - to_pivot) - ANGLE_SLACK, 0.0)
    bound = np.cos(np.minimum(apart, np.pi))
    bound[:, ~turned] = 0.0
    bound[~units.any(1)] = 0.0
    return bound


def first_cells(pivots: np.ndarray, cell_pivot: np.ndarray, cell_ring: np.ndarray, rows: np.ndarray, k: int):
    """mapInArrow body: the cells with the best bounds that together hold ``k`` rows."""

    def body(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            bound = best_possible(matrix(batch.column("vector"), batch.num_rows), pivots, cell_pivot, cell_ring)
            order = np.argsort(-bound, 1, kind="stable")
            before = np.cumsum(rows[order], 1) - rows[order]
            yield _visits(batch, order, before < k)

    return body


def other_cells(pivots: np.ndarray, cell_pivot: np.ndarray, cell_ring: np.ndarray, rows: np.ndarray, k: int):
    """mapInArrow body over queries with ``least``, the k-th best score among their first
    cells: the other cells that may hold as good a row."""

    def body(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            bound = best_possible(matrix(batch.column("vector"), batch.num_rows), pivots, cell_pivot, cell_ring)
            order = np.argsort(-bound, 1, kind="stable")
            before = np.cumsum(rows[order], 1) - rows[order]
            least = np.nan_to_num(batch.column("least").to_numpy(zero_copy_only=False).astype(np.float64), nan=-2.0)
            wanted = (before >= k) & (np.take_along_axis(bound, order, 1) >= least[:, None] - SCORE_SLACK)
            yield _visits(batch, order, wanted)

    return body


def _visits(batch: pa.RecordBatch, order: np.ndarray, wanted: np.ndarray) -> pa.RecordBatch:
    at, place = np.nonzero(wanted)
    picked = pa.array(at)
    return pa.RecordBatch.from_arrays(
        [batch.column("id").take(picked), batch.column("vector").take(picked), pa.array(order[at, place].astype(np.int32))], names=["query_id", "vector", "cell"]
    )


def pack(size: int):
    """mapInArrow body over rows in order of ``cell``: blocks of up to ``size`` rows of one
    cell, as (cell, ids, cells of the vectors one after the other)."""

    def body(batches):
        held, ids, vectors, n = None, [], [], 0

        def block():
            return pa.RecordBatch.from_arrays(
                [pa.array([held], pa.int32()), _listed(pa.concat_arrays(ids)), _listed(pa.concat_arrays(vectors))], names=["cell", "ids", "cells"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column("cell").to_numpy()
            cuts = np.append(np.flatnonzero(np.diff(cells, prepend=cells[0] - 1)), len(cells))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if cells[a] != held and n:
                    yield block()
                    ids, vectors, n = [], [], 0
                held = int(cells[a])
                while a < b:
                    take = min(size - n, b - a)
                    part = batch.slice(a, take)
                    ids.append(part.column("id"))
                    vectors.append(part.column("vector").flatten())
                    n, a = n + take, a + take
                    if n == size:
                        yield block()
                        ids, vectors, n = [], [], 0
        if n:
            yield block()

    return body


def _listed(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def compare(k: int, string_ids: bool):
    """mapInArrow body over pairs of a query block and a corpus block of one cell: the k
    best rows of the block for each query."""

    def body(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda name: batch.column(name)[r].values
                query_ids, ids = get("query_ids"), get("ids").to_numpy(zero_copy_only=False)
                if string_ids:
                    ids = ids.astype(str)
                queries = unit_rows(get("query_cells").to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(query_ids), -1))
                rows = unit_rows(get("cells").to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1))
                scores = np.round(queries @ rows.T, SCORE_DIGITS)
                scores, best = _top_k(scores, np.broadcast_to(ids, scores.shape), k)
                owners = query_ids.take(pa.array(np.repeat(np.arange(len(query_ids)), scores.shape[1])))
                yield pa.RecordBatch.from_arrays([owners, pa.array(best.reshape(-1)), pa.array(scores.reshape(-1))], names=["query_id", "id", "score"])

    return body
