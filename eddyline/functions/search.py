"""Exact top-k search inside a task, on Arrow batches of (id, vector).

Kept free of Spark imports, so Python workers load it quickly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

QUERIES_PER_PRODUCT = 1024
SCORE_DIGITS = 9


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(length == 0.0, 1.0, length)


def _top_k(scores: np.ndarray, ids: np.ndarray, k: int):
    """The k best columns per row of ``scores``: highest score, then lowest id."""
    if scores.shape[1] > k:
        picked = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        worst = np.take_along_axis(scores, picked, 1).min(axis=1)
        tied = (scores >= worst[:, None]).sum(axis=1) > k
        for row in np.flatnonzero(tied):
            near = np.flatnonzero(scores[row] >= worst[row])
            picked[row] = near[np.lexsort((ids[row, near], -scores[row, near]))[:k]]
        scores = np.take_along_axis(scores, picked, 1)
        ids = np.take_along_axis(ids, picked, 1)
    return scores, ids


def block_search(query_ids: np.ndarray, units: np.ndarray, k: int, string_ids: bool):
    """mapInArrow body: each task keeps the k best candidates per query while it reads."""

    def search(batches):
        starts = range(0, len(query_ids), QUERIES_PER_PRODUCT)
        best: list = [None] * len(starts)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            if string_ids:
                ids = ids.astype(str)
            cells = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            rows = unit_rows(cells.astype(np.float64, copy=False).reshape(batch.num_rows, -1))
            for i, start in enumerate(starts):
                block = units[start : start + QUERIES_PER_PRODUCT]
                scores = np.round(block @ rows.T, SCORE_DIGITS)
                found = _top_k(scores, np.broadcast_to(ids, scores.shape), k)
                if best[i] is not None:
                    joined = [np.concatenate(pair, axis=1) for pair in zip(best[i], found)]
                    found = _top_k(*joined, k)
                best[i] = found
        for start, found in zip(starts, best):
            if found is None:
                return
            scores, ids = found
            owners = np.repeat(query_ids[start : start + len(scores)], scores.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(owners), pa.array(ids.reshape(-1)), pa.array(scores.reshape(-1))],
                names=["query_id", "id", "score"],
            )

    return search
