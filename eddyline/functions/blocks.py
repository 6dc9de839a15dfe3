"""Matrix work inside tasks, on Arrow batches of sparse rows (slots, values).

Kept free of Spark imports, so Python workers load it quickly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

ROWS_PER_PRODUCT = 64


def _dense_blocks(batch: pa.RecordBatch, kind=np.float64):
    """Sparse rows of an Arrow batch as (first row, used slots, dense block over them).

    Few rows per block keep the set of used slots, and so the dense block, small.
    """
    slots, values = batch.column("slots"), batch.column("values")
    for start in range(0, batch.num_rows, ROWS_PER_PRODUCT):
        part = slots.slice(start, ROWS_PER_PRODUCT)
        lengths = np.diff(part.offsets.to_numpy())
        flat = part.flatten().to_numpy(zero_copy_only=False)
        cells = values.slice(start, ROWS_PER_PRODUCT).flatten().to_numpy(zero_copy_only=False)
        used, place = np.unique(flat, return_inverse=True)
        dense = np.zeros((len(part), len(used)), kind)
        dense[np.repeat(np.arange(len(part)), lengths), place] = cells
        yield start, used, dense


class Directions:
    """Frequent Directions: ``size`` rows that stand for all rows put in.

    For every unit vector x the sketch B of the rows A has |Bx|² between |Ax|² less
    |A - A_k|² / (size - k) and |Ax|², for each k below ``size``. Sketches are rows, so
    putting the rows of one into another merges the two within the same bounds.
    """

    def __init__(self, features: int, size: int):
        self.size, self.filled = size, 0
        self.rows = np.zeros((2 * size, features), np.float32)

    def put(self, dense: np.ndarray, used: np.ndarray | None = None) -> None:
        """Rows, as cells of the ``used`` columns or of all."""
        for start in range(0, len(dense), self.size):
            part = dense[start : start + self.size]
            if self.filled + len(part) > len(self.rows):
                self.shrink()
            at = slice(self.filled, self.filled + len(part))
            if used is None:
                self.rows[at] = part
            else:
                self.rows[at] = 0.0
                self.rows[np.arange(at.start, at.stop)[:, None], used] = part
            self.filled += len(part)

    def shrink(self) -> None:
        """At most ``size`` rows: all squared singular values less the next one's."""
        if self.filled <= self.size:
            return
        rows = self.rows[: self.filled]
        squares, left = _turned(rows)
        less = np.maximum(squares[: self.size] - squares[self.size], 0.0)
        factor = np.sqrt(np.divide(less, squares[: self.size], out=np.zeros_like(less), where=less > 0.0))
        self.rows[: self.size] = (left[:, : self.size] * factor).T.astype(np.float32) @ rows
        self.filled = self.size

    def leading(self, count: int) -> np.ndarray:
        """The ``count`` leading right singular vectors as columns; zero ones beyond the rank."""
        rows = self.rows[: self.filled].astype(np.float64)
        out = np.zeros((rows.shape[1], count))
        if len(rows):
            squares, left = _turned(rows)
            good = squares[:count] > squares[0] * 1e-12
            found = (left[:, :count][:, good] / np.sqrt(squares[:count][good])).T @ rows
            out[:, : len(found)] = found.T
        return out


def _turned(rows: np.ndarray):
    """Squared singular values in falling order, and the left singular vectors."""
    squares, left = np.linalg.eigh((rows @ rows.T).astype(np.float64))
    return np.maximum(squares[::-1], 0.0), left[:, ::-1]


def _emit(sketch: Directions, node: int):
    sketch.shrink()
    for start in range(0, sketch.filled, ROWS_PER_PRODUCT):
        rows = np.ascontiguousarray(sketch.rows[start : min(start + ROWS_PER_PRODUCT, sketch.filled)])
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(rows), node, np.int32)), pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1)))], names=["node", "cells"]
        )


def sketch_rows(features: int, size: int):
    """mapInArrow body: one sketch of a task's sparse rows, under the number of the task."""

    def body(batches):
        from pyspark import TaskContext

        sketch = Directions(features, size)
        for batch in batches:
            for _, used, dense in _dense_blocks(batch, np.float32):
                sketch.put(dense, used)
        yield from _emit(sketch, TaskContext.get().partitionId())

    return body


def merge_sketches(features: int, size: int):
    """mapInArrow body: sketches of equal ``node``, which lie together, become one."""

    def body(batches):
        sketch, held = None, None
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            cells = batch.column("cells").flatten().to_numpy().reshape(len(nodes), features)
            for node in np.unique(nodes).tolist():
                if node != held:
                    if sketch is not None:
                        yield from _emit(sketch, held)
                    sketch, held = Directions(features, size), node
                sketch.put(cells[nodes == node])
        if sketch is not None:
            yield from _emit(sketch, held)

    return body


def project(directions: np.ndarray):
    def body(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, directions.shape[1]))
            for start, used, dense in _dense_blocks(batch):
                out[start : start + len(dense)] = dense @ directions[used]
            length = np.linalg.norm(out, axis=1, keepdims=True)
            out /= np.where(length == 0.0, 1.0, length)
            offsets = np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.reshape(-1)))],
                names=["id", "vector"],
            )

    return body
