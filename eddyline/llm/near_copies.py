"""Groups of documents whose word shingles are nearly the same, for the pipeline's stage.

Candidates come from SimHash, by the pigeonring search of ``simhash``, with fingerprints over
the same shingles. Copies of Jaccard similarity 0.8 differ in about ten of 64 bits, beyond
any radius that can be searched, so the smallest shingle hashes give candidates too, in bands.
Every candidate is settled by the exact Jaccard similarity of the two texts' shingles.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import slices, strings, whole_text, written
from eddyline.llm.components import smallest_reachable
from eddyline.llm.simhash import SEED, class_links, folded_words, majority

BANDS, BAND_ROWS = 12, 5  # finds a pair of similarity 0.8 with a chance of 0.99
SKETCH = 64  # bytes that estimate a similarity within 0.05
SLACK = 0.1  # by which an estimate may fall short of the similarity wanted
CHUNK = 1024  # members of a bucket that are compared with each other at once
CARRIED = 128
_FACTORS = np.random.default_rng(5).integers(1, 1 << 63, max(SKETCH, BANDS * BAND_ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str, width: int) -> np.ndarray:
    """Hashes of all word shingles, repeats included; fewer words are one shingle."""
    words = folded_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    ends = starts + lengths
    k = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)


def smallest(hashes: np.ndarray) -> np.ndarray:
    """For each factor the smallest product with any hash."""
    low = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(hashes), 1 << 13):
        low = np.minimum(low, (hashes[a : a + (1 << 13), None] * _FACTORS).min(0))
    return low


def _marks(width: int):
    def body(batches):
        for batch in (part for whole in batches for part in slices(whole, "text", 1 << 20)):
            rows = []
            for text in strings(batch, "text"):
                every = shingles(text, width)
                low = smallest(np.unique(every))
                banded = low[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
                keys = [int.from_bytes(hashlib.blake2b(bytes([b]) + banded[b].tobytes(), digest_size=8).digest(), "big", signed=True) for b in range(BANDS)]
                digest = hashlib.blake2b(np.unique(every).tobytes(), digest_size=16).digest()
                rows.append((digest, majority(every), keys, (low[:SKETCH] >> np.uint64(56)).astype(np.uint8).tobytes()))
            digests, marks, keys, sketches = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(np.array(marks, np.uint64).view(np.int64)),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["doc_id", "digest", "mark", "bands", "sketch"],
            )

    return body


def _tree(ids: np.ndarray, sketches: np.ndarray, least: float, reached: int):
    """Links that join all members which chains of likely pairs join, the likeliest first.
    The first ``reached`` members are known already; links among them are not looked for."""
    m = len(ids)
    best, to = np.full(m, -1.0), np.zeros(m, np.int64)
    rest = np.ones(m, bool)
    left, right = [], []

    def reach(i):
        rest[i] = False
        alike = (sketches == sketches[i]).mean(1)
        closer = rest & (alike > best)
        best[closer], to[closer] = alike[closer], i

    for i in range(reached):
        reach(i)
    for _ in range(m - reached):
        open_ = np.flatnonzero(rest)
        i = open_[np.argmax(best[open_])]
        if best[i] >= least:
            left.append(ids[to[i]])
            right.append(ids[i])
        reach(i)
    return left, right


def _bucket_links(least: float):
    """mapInArrow body over (band, doc_id, sketch) sorted by band and sketch. Buckets of more
    than a chunk are compared chunk by chunk, each with members of groups before it; these
    are the likely links to begin with, and ``_untried`` gives the rest."""

    def body(batches):
        held, ids, sketches, carried = None, [], [], ([], [])

        def chunk():
            everyone = np.array([*carried[0], *ids], np.int64)
            rows = np.frombuffer(b"".join([*carried[1], *sketches]), np.uint8).reshape(len(everyone), SKETCH)
            left, right = _tree(everyone, rows, least, len(carried[0]))
            # Who was linked is like someone carried on already, or like its own chunk's first.
            linked = set(right)
            new = [k for k in range(len(carried[0]), len(everyone)) if everyone[k] not in linked]
            keep = sorted({*range(len(carried[0])), *new})[-CARRIED:]
            step = max(len(ids) // 16, 1)
            keep += [k for k in range(len(carried[0]), len(everyone), step) if k not in keep]
            return left, right, ([int(everyone[k]) for k in keep], [rows[k].tobytes() for k in keep])

        for batch in batches:
            out = ([], [])
            for band, doc_id, sketch in zip(*[batch.column(n).to_pylist() for n in ("band", "doc_id", "sketch")]):
                if band != held or len(ids) >= CHUNK:
                    if len(ids) + len(carried[0]) > 1:
                        left, right, kept = chunk()
                        out[0].extend(left)
                        out[1].extend(right)
                        carried = kept
                    if band != held:
                        carried = ([], [])
                    held, ids, sketches = band, [], []
                ids.append(doc_id)
                sketches.append(sketch)
            yield _pairs(*out)
        if len(ids) + len(carried[0]) > 1:
            left, right, _ = chunk()
            yield _pairs(left, right)

    return body


def _pairs(left, right) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _settle(width: int, least: float):
    """mapInArrow body over (a, b, text_a, text_b): the pairs that are alike enough."""

    def body(batches):
        for batch in (part for whole in batches for part in slices(whole, "text_a", 1 << 22)):
            keep = []
            for one, other in zip(strings(batch, "text_a"), strings(batch, "text_b")):
                x, y = np.unique(shingles(one, width)), np.unique(shingles(other, width))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= least * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return body


def _rest(least: float):
    """mapInArrow body over (bucket, doc_id, sketch, component, low, high) sorted by bucket and the
    two chunks: every likely pair of one chunk's members, or of two chunks', that are not in one
    component. What is held is two chunks."""

    def likely(members, low, high):
        ids = np.array([m[0] for m in members], np.int64)
        groups = np.array([m[2] for m in members], np.int64)
        side = np.array([m[3] for m in members], np.int64)
        sketches = np.frombuffer(b"".join(m[1] for m in members), np.uint8).reshape(len(ids), SKETCH)
        others = np.arange(len(ids)) if low == high else np.flatnonzero(side == high)
        for i in range(len(ids)) if low == high else np.flatnonzero(side == low):
            rest = others[others > i] if low == high else others
            rest = rest[groups[rest] != groups[i]]
            if len(rest):
                near = rest[(sketches[rest] == sketches[i]).mean(1) >= least]
                if len(near):
                    yield _pairs(np.full(len(near), ids[i]), ids[near])

    def body(batches):
        held, members = None, []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("bucket", "low", "high", "doc_id", "sketch", "component", "chunk")]
            for bucket, low, high, *member in zip(*columns):
                if (bucket, low, high) != held:
                    if members:
                        yield from likely(members, *held[1:])
                    held, members = (bucket, low, high), []
                members.append(member)
        if members:
            yield from likely(members, *held[1:])

    return body


def _untried(buckets: DataFrame, tried: DataFrame, components: DataFrame, least: float) -> DataFrame:
    """(a, b): the likely pairs of ``buckets(bucket, doc_id, sketch)`` that are in different
    components and were not settled yet.

    Buckets whose members are one component, nearly all, have none. The others are dealt to
    chunks by the id, and each two chunks meet in a group of their own, so a bucket of any size
    is compared whole and no task holds more than two chunks of it.
    """
    named = buckets.join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    mixed = named.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("one"), F.max("component").alias("other"))
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    members = named.join(mixed.filter("one <> other").select("bucket", chunks.alias("chunks")), "bucket").withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")
    )
    met = members.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "bucket", F.least("chunk", "with").alias("low"), F.greatest("chunk", "with").alias("high"), "doc_id", "sketch", "component", "chunk"
    )
    place = ["bucket", "low", "high"]
    pairs = met.repartition(*place).sortWithinPartitions(*place).mapInArrow(_rest(least), "a bigint, b bigint")
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return ordered.join(tried, ["a", "b"], "left_anti")


def _settled(candidates: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    wanted = candidates.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # Ids of several texts: any row that has the class's digest would do, and one is taken.
    lent = texts.join(wanted, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    lent = written(lent, "copy-texts")
    met = candidates.join(lent.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(
        lent.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    links = met.select("a", "b", "text_a", "text_b").mapInArrow(_settle(width, least), "a bigint, b bigint")
    return written(links, "copy-links")


def near_copies(docs: DataFrame, width: int = 5, least: float = 0.8) -> DataFrame:
    """``doc_id, component_id`` for every row of ``docs(doc_id, text)``.

    Documents link if the Jaccard similarity of their distinct ``width``-word shingles is
    ``least`` or more (A-Z in lower case, words between ASCII white space; fewer words are one
    shingle; texts without words are alike). Every link given is exact; of the links that
    exist those are found that SimHash within four bits or the bands show, most of them
    (tests measure the share). Few pairs of a bucket join most of what it joins, so these are
    settled first; then all pairs of a bucket that are still in different components are, of
    whatever size it is. Equal shingle sets are one class. component_id is the smallest
    doc_id that links reach. NULL texts count as empty. Repeated rows give a row each; a row
    without an id belongs to the class of its text, whose id is that of its other rows, or
    NULL. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))
    marks = written(texts.mapInArrow(_marks(width), "doc_id bigint, digest binary, mark bigint, bands array<bigint>, sketch binary"), "copy-marks")
    named = marks.filter("doc_id IS NOT NULL")
    classes = written(
        named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("mark").alias("mark"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
        "copy-classes",
    )
    # Of classes with one fingerprint each is a candidate with the smallest one.
    same = classes.groupBy("mark").agg(F.min("doc_id").alias("first"))
    simhash = written(class_links(same.withColumnRenamed("first", "doc_id")).unionByName(
        classes.join(same, "mark").filter("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    ), "copy-simhash")
    buckets = classes.select(F.explode("bands").alias("band"), "doc_id", "sketch")
    banded = buckets.repartition("band").sortWithinPartitions("band", "sketch", "doc_id").mapInArrow(_bucket_links(least - SLACK), "a bigint, b bigint")
    candidates = written(
        simhash.unionByName(banded).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "copy-candidates"
    )
    links = _settled(candidates, texts, width, least)
    reached = smallest_reachable(links)
    # Whom SimHash joins, by whatever chain, are a bucket as well. Should its number be a band's
    # too, more pairs are compared, not fewer.
    chains = smallest_reachable(simhash).withColumnRenamed("node", "doc_id").withColumnRenamed("component", "bucket")
    alike = chains.join(classes.select("doc_id", "sketch"), "doc_id").select("bucket", "doc_id", "sketch")
    every = buckets.select(F.col("band").alias("bucket"), "doc_id", "sketch").unionByName(alike)
    more = written(_untried(every, candidates, reached, least - SLACK), "copy-rest")
    reached = smallest_reachable(links.unionByName(_settled(more, texts, width, least)))
    groups = classes.select("digest", "doc_id").join(reached.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "digest", F.coalesce("component", "doc_id").alias("component_id")
    )
    return marks.select("doc_id", "digest").join(written(groups, "copy-groups"), "digest", "left").select("doc_id", "component_id")
