"""Terms of documents inside tasks: words without stop words, and pairs of neighbours.

Kept free of Spark imports, so Python workers load it quickly. Batches have a column
``words``, a list of tokens per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Tokens, or one document's if it has more, that are counted at once.
TOKENS = 1 << 18
COUNTS = pa.schema([("term", pa.string()), ("tf", pa.int64()), ("df", pa.int64())])


def portions(batches):
    """The batches in runs of documents with about ``TOKENS`` tokens: what a task holds does
    not depend on how many documents a batch has, nor on how long they are together."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(batch.column("words")), 0), np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + TOKENS, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def _coded(batch: pa.RecordBatch, stop: pa.Array):
    """(rows, codes, words): the words that count, by document."""
    column = batch.column("words")
    coded = column.flatten().dictionary_encode()
    words = coded.dictionary
    counts = pc.and_(pc.greater(pc.utf8_length(words), 1), pc.invert(pc.is_in(words, value_set=stop)))
    keep = np.asarray(pc.fill_null(counts, False).to_numpy(zero_copy_only=False), bool)
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(batch.num_rows), lengths)
    kept = keep[codes] if len(codes) else np.zeros(0, bool)
    return rows[kept], codes[kept], words


def document_terms(batch: pa.RecordBatch, stop: pa.Array):
    """(row, place of the term, count) of every term in every document, and the terms."""
    rows, codes, words = _coded(batch, stop)
    size = len(words)
    beside = np.flatnonzero(rows[1:] == rows[:-1]) if len(rows) else np.zeros(0, np.int64)
    pairs, place = np.unique(codes[beside] * size + codes[beside + 1], return_inverse=True)
    joined = pc.binary_join_element_wise(words.take(pa.array(pairs // max(size, 1))), words.take(pa.array(pairs % max(size, 1))), " ")
    terms = pa.concat_arrays([words, joined]) if len(pairs) else words
    keys = np.concatenate([rows * len(terms) + codes, rows[beside] * len(terms) + size + place])
    found, times = np.unique(keys, return_counts=True)
    return found // max(len(terms), 1), found % max(len(terms), 1), times, terms


def _summed(parts: list[pa.Table]) -> pa.Table:
    if len(parts) == 1:
        return parts[0]
    return pa.concat_tables(parts).group_by("term").aggregate([("tf", "sum"), ("df", "sum")]).rename_columns(["term", "tf", "df"])


def all_terms(stop_words: list[str], size: int):
    """mapInArrow body: exact counts of a task's terms, in parts of about ``size`` terms."""

    def body(batches):
        stop, waiting = pa.array(stop_words, pa.string()), []
        for batch in portions(batches):
            waiting.append(_batch_counts(batch, stop))
            if sum(map(len, waiting)) > size:
                yield from _summed(waiting).cast(COUNTS).to_batches(max_chunksize=1 << 16)
                waiting = []
        if waiting:
            yield from _summed(waiting).cast(COUNTS).to_batches(max_chunksize=1 << 16)

    return body


def _batch_counts(batch: pa.RecordBatch, stop: pa.Array) -> pa.Table:
    _, place, times, terms = document_terms(batch, stop)
    tf = np.bincount(place, weights=times, minlength=len(terms)).astype(np.int64)
    df = np.bincount(place, minlength=len(terms)).astype(np.int64)
    some = tf > 0
    return pa.table({"term": terms.filter(pa.array(some)), "tf": tf[some], "df": df[some]})


def frequent_terms(stop_words: list[str], size: int):
    """mapInArrow body: a Misra-Gries summary of a task's terms.

    When the summary has more than twice ``size`` terms, the count of the next one after
    the ``size`` largest is taken off every count, and terms with nothing left go. So a
    count is short by no more than what was taken off in all, which the row of the NULL
    term tells, and a term that is not listed has no more than that. Summaries add up.
    """

    def body(batches):
        stop, held, off, waiting = pa.array(stop_words, pa.string()), None, 0, []
        for batch in portions(batches):
            waiting.append(_batch_counts(batch, stop))
            if sum(map(len, waiting)) > 2 * size:
                held, off = _cut(_summed(([held] if held is not None else []) + waiting), size, off)
                waiting = []
        if held is not None or waiting:
            held, off = _cut(_summed(([held] if held is not None else []) + waiting), size, off)
            yield from held.cast(COUNTS).to_batches(max_chunksize=1 << 16)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([off]), pa.array([0])], schema=COUNTS)

    return body


def _cut(table: pa.Table, size: int, off: int) -> tuple[pa.Table, int]:
    tf = table["tf"].to_numpy()
    if len(tf) <= 2 * size:
        return table, off
    less = int(np.partition(tf, len(tf) - size - 1)[len(tf) - size - 1])
    keep = tf > less
    return pa.table({"term": table["term"].filter(pa.array(keep)), "tf": tf[keep] - less, "df": table["df"].to_numpy()[keep]}), off + less


def count_terms(stop_words: list[str], vocabulary: pa.Array):
    """mapInArrow body: (slot, tf, df) of the terms of ``vocabulary`` in a task."""

    def body(batches):
        stop = pa.array(stop_words, pa.string())
        tf, df = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
        for batch in portions(batches):
            _, place, times, terms = document_terms(batch, stop)
            slots = _slots(terms, vocabulary)[place]
            known = slots >= 0
            tf += np.bincount(slots[known], weights=times[known], minlength=len(tf)).astype(np.int64)
            df += np.bincount(slots[known], minlength=len(df))
        some = np.flatnonzero(tf)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(tf[some]), pa.array(df[some])], names=["slot", "tf", "df"])

    return body


def _slots(terms: pa.Array, vocabulary: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.index_in(terms, value_set=vocabulary), -1).to_numpy(zero_copy_only=False), np.int64)


def weigh(stop_words: list[str], vocabulary: pa.Array, idf: np.ndarray):
    """mapInArrow body: (id, slots, tf, values): counts and unit-length weights of each document."""

    def body(batches):
        stop = pa.array(stop_words, pa.string())
        for batch in portions(batches):
            rows, place, times, terms = document_terms(batch, stop)
            slots = _slots(terms, vocabulary)[place]
            known = slots >= 0
            rows, slots, times = rows[known], slots[known], times[known]
            order = np.lexsort((slots, rows))
            rows, slots, times = rows[order], slots[order], times[order]
            raw = times * idf[slots]
            length = np.sqrt(np.bincount(rows, weights=raw * raw, minlength=batch.num_rows))
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))]).astype(np.int32))
            listed = lambda values, kind: pa.ListArray.from_arrays(offsets, pa.array(values, kind))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), listed(slots, pa.int32()), listed(times, pa.int64()), listed(raw / length[rows], pa.float64())],
                names=["id", "slots", "tf", "values"],
            )

    return body
