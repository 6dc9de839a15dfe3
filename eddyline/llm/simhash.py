"""SimHash near-duplicates, candidates by the pigeonring principle.

The 64 bits of a fingerprint lie on a ring of five segments. If two fingerprints differ
in at most four bits, some segment starts a chain whose every prefix of k segments
differs in at most 4k/5 bits, rounded down: 0, 1, 2, 3 and 4. So both meet in a bucket
of (start, first segment, second segment with at most one bit flipped). Inside a bucket
longer prefixes of the chain are checked before the whole distance.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import LOWER, UPPER, strings, whole_text, written
from eddyline.llm.components import smallest_reachable

RADIUS = 4
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # (first bit, width)
# Words, and the seed of the shingle hash.
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SEED = 42
CHUNK = 1 << 16


def folded_words(text: str) -> list[bytes]:
    return WORD.findall(text.translate(str.maketrans(UPPER, LOWER)).encode("utf-8", "replace"))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    hashes = hashes.astype(">u8")
    totals = np.zeros(64, np.int64)
    for a in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[a : a + CHUNK].view(np.uint8).reshape(-1, 8), axis=1)
        totals += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(totals * 2 > len(hashes)).tobytes(), "big")


def fingerprint(text: str, width: int = 4) -> int:
    """Majority bits over the hashes of all word shingles, repeats included."""
    words = folded_words(text)
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    ends = starts + lengths
    k = min(width, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(line[a:b], SEED) for a, b in spans], ">u8"))


def _fingerprints(width: int):
    def body(batches):
        for batch in batches:
            marks = np.array([fingerprint(t, width) for t in strings(batch, "text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks)], names=["doc_id", "mark"])

    return body


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, mark): the fingerprint's 64 bits as a signed number, one narrow pass."""
    rows = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))
    return rows.mapInArrow(_fingerprints(width), "doc_id bigint, mark bigint")


def _segment(mark, s: int):
    """Segment ``s`` of marks (bit 0 is the lowest)."""
    first, width = SEGMENTS[s % len(SEGMENTS)]
    return (mark >> np.uint64(first)) & np.uint64((1 << width) - 1)


def _spread(batches):
    """mapInArrow body: the bucket rows of each class. ``probe`` rows have the second
    segment as it is (one bucket per start) or with one bit flipped; only the former
    are what others are looked up against."""
    for batch in batches:
        mark = batch.column("mark").to_numpy().view(np.uint64)
        keys, exact, rows = [], [], []
        for start in range(len(SEGMENTS)):
            width = SEGMENTS[(start + 1) % len(SEGMENTS)][1]
            flips = np.concatenate([[0], 1 << np.arange(width)]).astype(np.uint64)
            head = (np.uint64(start) << np.uint64(26)) | (_segment(mark, start) << np.uint64(13))
            key = (head[:, None] | (_segment(mark, start + 1)[:, None] ^ flips)).reshape(-1)
            keys.append(key.astype(np.int32))
            exact.append(np.tile(flips == 0, len(mark)))
            rows.append(np.repeat(np.arange(len(mark)), len(flips)))
        at = pa.array(np.concatenate(rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys)), pa.array(np.concatenate(exact)), batch.column("mark").take(at), batch.column("doc_id").take(at)],
            names=["bucket", "exact", "mark", "doc_id"],
        )


def _viable(start: int, mark: np.uint64, others: np.ndarray) -> np.ndarray:
    """Which others are within RADIUS: chain prefixes first, then the whole distance."""
    apart = others ^ mark
    keep = np.arange(len(others))
    spent = np.zeros(len(others), np.int64)
    for k in range(1, len(SEGMENTS) + 1):
        spent = spent + np.bitwise_count(_segment(apart[keep], start + k - 1))
        within = spent <= RADIUS * k // len(SEGMENTS)
        keep, spent = keep[within], spent[within]
    return keep


def _bucket_links(start: int, marks: np.ndarray, ids: np.ndarray, exact: np.ndarray):
    """Links that join, within one bucket, all classes that chains of links join.

    A search from each class compares only with classes not reached yet, so a dense
    group gives one link fewer than it has classes instead of all its pairs. One side of
    a compared pair is an exact row: its flipped copy meets the other elsewhere.
    """
    left, right = [], []
    rest = np.arange(len(marks))
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            among = rest if exact[i] else rest[exact[rest]]
            if not len(among):
                continue
            found = among[_viable(start, marks[i], marks[among])]
            if len(found):
                left += [ids[i]] * len(found)
                right += ids[found].tolist()
                todo += found.tolist()
                rest = rest[~np.isin(rest, found)]
    return left, right


def _links(batches):
    """mapInArrow body over rows sorted by bucket: buckets may span batches."""
    names = ["bucket", "exact", "mark", "doc_id"]
    held = None
    for batch in batches:
        now = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if held is not None:
            now = [np.concatenate(pair) for pair in zip(held, now)]
        bucket = now[0]
        last = np.searchsorted(bucket, bucket[-1]) if len(bucket) else 0
        held = [c[last:] for c in now]
        yield _linked([c[:last] for c in now])
    if held is not None:
        yield _linked(held)


def _linked(columns):
    bucket, exact, mark, ids = columns
    left, right = [], []
    if len(bucket):
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1)), len(bucket))
        has_exact = np.add.reduceat(exact.astype(np.int64), cuts[:-1]) > 0
        for k in np.flatnonzero(has_exact & (np.diff(cuts) > 1)):
            a, b = cuts[k], cuts[k + 1]
            l, r = _bucket_links(int(bucket[a]) >> 26, mark[a:b].view(np.uint64), ids[a:b], exact[a:b])
            left += l
            right += r
    return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def class_links(classes: DataFrame) -> DataFrame:
    """(a, b): links between classes (mark, doc_id) with distinct marks, enough of them
    to join every two classes that a chain of links within RADIUS joins."""
    spread = classes.mapInArrow(_spread, "bucket int, exact boolean, mark bigint, doc_id bigint")
    return spread.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_links, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 4) -> DataFrame:
    """``doc_id, mark, component_id`` for every row of ``docs(doc_id, text)``.

    Texts of NULL or without words have fingerprint 0 and link like any other; texts of
    fewer words than a shingle are one shingle. Equal fingerprints are one class, which
    the smallest doc_id stands for; component_id is the smallest doc_id that links reach.
    Repeated rows give a row each. A row without an id belongs to its class; a class
    without any id has no links and a NULL component_id.
    """
    marks = written(fingerprints(docs, width), "simhash")
    classes = marks.groupBy("mark").agg(F.min("doc_id").alias("doc_id"))
    links = class_links(classes.filter("doc_id IS NOT NULL"))
    reached = smallest_reachable(links)
    named = classes.join(reached.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "mark", F.coalesce("component", "doc_id").alias("component_id")
    )
    return marks.join(named, "mark", "left").select("doc_id", "mark", "component_id")


def hex_mark(column: str = "mark"):
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")
