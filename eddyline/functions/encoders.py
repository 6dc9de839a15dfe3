"""Batched calls of a text encoder inside tasks, and a stand-in encoder.

Kept free of Spark imports, so Python workers load it quickly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa


def _try_encode(encode, texts: list[str], width: int):
    """[(vector, None) or (None, error)] per text. A batch that fails, or whose answer is
    not one vector per text, is retried text by text, so one bad text does not cost its
    neighbours and no vector lands on another's text."""
    try:
        answer = list(encode(texts))
        if len(answer) != len(texts):
            raise ValueError(f"{len(answer)} vectors for {len(texts)} texts")
    except Exception as error:
        if len(texts) == 1:
            return [(None, f"{type(error).__name__}: {error}")]
        return [_try_encode(encode, [t], width)[0] for t in texts]
    return [_checked(vector, width) for vector in answer]


def _checked(vector, width: int):
    try:
        vector = np.asarray(vector, dtype=np.float32)
    except (TypeError, ValueError) as error:
        return None, f"{type(error).__name__}: {error}"
    if vector.shape != (width,):
        return None, f"ValueError: a vector of shape {vector.shape}, not ({width},)"
    if not np.isfinite(vector).all():
        return None, "ValueError: a vector with cells that are no finite numbers"
    return vector, None


def encode_body(column: int, factory, width: int, batch_size: int):
    """mapInArrow body that appends (vector, error) columns. Blank text gives a zero
    vector without a call of the encoder."""

    def body(batches):
        encode = factory()
        for batch in batches:
            texts = batch.column(column).to_pylist()
            cells = np.zeros((len(texts), width), dtype=np.float32)
            errors: list[str | None] = [None] * len(texts)
            filled = [i for i, t in enumerate(texts) if t and not t.isspace()]
            for start in range(0, len(filled), batch_size):
                chosen = filled[start : start + batch_size]
                for i, (vector, error) in zip(chosen, _try_encode(encode, [texts[i] for i in chosen], width)):
                    if error is None:
                        cells[i] = vector
                    errors[i] = error
            offsets = pa.array(np.arange(0, cells.size + 1, width, dtype=np.int32))
            missing = pa.array([e is not None for e in errors], pa.bool_())
            vectors = pa.ListArray.from_arrays(offsets, pa.array(cells.reshape(-1)), mask=missing)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, vectors, pa.array(errors, pa.string())],
                names=[*batch.schema.names, "vector", "encode_error"],
            )

    return body


def md5_encoder():
    """A stand-in for a sentence model: the same vectors as the hash expression."""

    def encode(texts: list[str]) -> np.ndarray:
        digests = np.frombuffer(b"".join(hashlib.md5(t.encode()).digest() for t in texts), np.uint8)
        return np.tile(digests.reshape(len(texts), 16) / 255.0, (1, 24))

    return encode
