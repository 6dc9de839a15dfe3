"""Fingerprints by a randomised edit embedding.

Two texts are read by the same random walk: at step j a reader stands on a character,
gives out a hash of it, and moves on or stays by a coin that step and character decide.
After an edit the two readers soon stand on the same character again, so texts a few
edits apart give sequences that differ in few places: edit distance has become Hamming
distance. A fingerprint keeps one bit at a random sample of the steps.

Steps are sampled by level: level k covers the first ``UNIT * 2**k`` steps and keeps
each with probability ``BITS / (UNIT * 2**k)``; the lowest level has ``BITS`` steps and
keeps all. A text's level covers its whole walk. Samples are nested, so fingerprints of
different levels compare on the coarser one's steps.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import accumulate, groupby
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import by_size, strings, whole_text

UNIT = 1024
BITS = 256
LOWEST = -2  # Fixed value: the level of BITS steps.
SEED = 42
CHUNK_CHARS = 1 << 20
KINDS = 16
PERIOD = 256
NUMBER = itemgetter(KINDS)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x + np.uint64(seed & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=64)
def sampled_steps(level: int, seed: int = SEED) -> np.ndarray:
    """The steps a level keeps, ascending; those of a higher level below this level's
    end are among them."""
    reach = BITS << (level - LOWEST)
    steps = []
    for a in range(0, reach, 1 << 20):
        at = np.arange(a, min(a + (1 << 20), reach), dtype=np.uint64)
        steps.append(at[_mix(at, seed) <= np.uint64((BITS << 64) // reach - 1)])
    return np.concatenate(steps).astype(np.int64)


def level_of(n_chars: int, steps: int | None = None) -> int:
    """The lowest level that covers a walk of so many steps; two a character, which is the
    average, if they are not known."""
    level, steps = LOWEST, 2 * n_chars if steps is None else steps
    while BITS << (level - LOWEST) < steps:
        level += 1
    return level


class _Walk:
    """The walk as an automaton. A state is a step modulo ``PERIOD``, held as a list that
    leads from a character's kind to the state in which the next character is reached;
    its last entry is its number. Following it is one C call per character."""

    def __init__(self, seed: int):
        kinds = np.uint64(KINDS - 1)
        self.kind_of = (_mix(np.arange(1 << 16, dtype=np.uint64), seed) & kinds).astype(np.uint8)
        self.seed = seed
        coins = (_mix(np.arange(PERIOD, dtype=np.uint64), seed + 1)[:, None] >> np.arange(KINDS, dtype=np.uint64)) & np.uint64(1)
        # The first step at or after each one whose coin says go, then one on.
        following = np.where(np.concatenate([coins, coins]) == 1, np.arange(2 * PERIOD)[:, None], 4 * PERIOD)
        following = np.minimum.accumulate(following[::-1], axis=0)[::-1][:PERIOD] + 1
        states: list[list] = [[] for _ in range(PERIOD)]
        for s, state in enumerate(states):
            state.extend(states[t % PERIOD] for t in following[s].tolist())
            state.append(s)
        self.first = states[0]

    def bits(self, text: str) -> tuple[int, np.ndarray]:
        """(level, the bits at the text's sampled steps), to the walk's end."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kind_of[codes & np.uint32(0xFFFF)]
        states = map(NUMBER, accumulate(kinds.tobytes(), getitem, initial=self.first))
        reached = np.fromiter(states, np.int64, len(codes) + 1)
        arrivals = np.concatenate([[0], np.cumsum((np.diff(reached) - 1) % PERIOD + 1)])
        level = level_of(len(codes), int(arrivals[-1]))
        steps = sampled_steps(level, self.seed)
        steps = steps[: np.searchsorted(steps, arrivals[-1])]
        seen = kinds[np.searchsorted(arrivals, steps, side="right") - 1].astype(np.uint64)
        faces = _mix(steps.astype(np.uint64), self.seed + 2)
        return level, ((faces >> seen) & np.uint64(1)).astype(np.uint8)


@lru_cache(maxsize=4)
def _walk(seed: int) -> _Walk:
    return _Walk(seed)


def fingerprints(texts: list[str], seed: int = SEED) -> list[str]:
    """``level:bits-in-use:hex``; equal texts have equal fingerprints."""
    out = []
    for text in texts:
        level, bits = _walk(seed).bits(text) if text else (level_of(0), np.zeros(0, np.uint8))
        out.append(f"{level:x}:{len(bits):x}:{np.packbits(bits).tobytes().hex()}")
    return out


def _parsed(mark: str):
    level, n, data = mark.split(":")
    return int(level, 16), np.unpackbits(np.frombuffer(bytes.fromhex(data), np.uint8))[: int(n, 16)]


def likeness(one: str, other: str, seed: int = SEED) -> float:
    """How far above chance the common steps agree, 0 to 1. Steps that only one walk
    reaches count as chance; two empty texts are alike."""
    if one == other:
        return 1.0
    (la, a), (lb, b) = _parsed(one), _parsed(other)
    top = max(la, lb)
    a, b = _at_level(a, la, top, seed), _at_level(b, lb, top, seed)
    shared, longer = min(len(a), len(b)), max(len(a), len(b))
    if not longer:
        return 0.0
    agree = float((a[:shared] == b[:shared]).sum()) + 0.5 * (longer - shared)
    return max(0.0, 2.0 * agree / longer - 1.0)


def _at_level(bits: np.ndarray, level: int, top: int, seed: int) -> np.ndarray:
    if level == top:
        return bits
    steps = sampled_steps(level, seed)[: len(bits)]
    return bits[np.isin(steps, sampled_steps(top, seed), assume_unique=True)]


# -- documents and their edited neighbours


def _mark_body(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), pa.array(fingerprints(strings(batch, "text")), pa.string())],
            names=["doc_id", "text", "fingerprint"],
        )


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text, fingerprint`` for every row, one narrow pass; NULL text as ''."""
    rows = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))
    return rows.mapInArrow(_mark_body, "doc_id bigint, text string, fingerprint string")


def _band_body(bands: int, width: int):
    def body(batches):
        for batch in batches:
            rows, keys = [], []
            for i, mark in enumerate(batch.column("fingerprint").to_pylist()):
                level, bits = _parsed(mark)
                # A text near a level's end also goes by the next level's steps, and each by
                # the half and the whole of the bits it surely has: those of its near
                # copies differ a little in number.
                for at in (level, level + 1):
                    own = _at_level(bits, level, at, SEED)
                    whole = 1 << (len(own).bit_length() - 1) if len(own) else 0
                    for reach in {whole, whole // 2}:
                        rng = np.random.default_rng([SEED, at - LOWEST, reach])
                        for band in range(bands):
                            picks = (rng.random(width) * reach).astype(np.int64)
                            sample = np.packbits(own[picks]).tobytes().hex() if reach else "empty"
                            keys.append(f"{at:x}.{reach}.{band}.{sample}")
                            rows.append(i)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("mark_id").take(at), batch.column("fingerprint").take(at), pa.array(keys, pa.string())], names=["mark_id", "fingerprint", "band"]
            )

    return body


def _link_body(least: float):
    def body(batches):
        rows = (row for batch in batches for row in zip(*(batch.column(n).to_pylist() for n in ("band", "mark_id", "fingerprint"))))
        for _, bucket in groupby(rows, key=itemgetter(0)):
            members = [row[1:] for row in bucket]
            if len(members) > 1:
                links = _bucket_links([m for _, m in members], least)
                a, b = ([members[link[k]][0] for link in links] for k in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(min, a, b), pa.int64()), pa.array(map(max, a, b), pa.int64()), pa.array([x for *_, x in links], pa.float64())],
                    names=["a", "b", "likeness"],
                )

    return body


def _bucket_links(marks: list[str], least: float) -> list[tuple[int, int, float]]:
    """Links that join, within one bucket, all members that chains of likeness ``least``
    join. A search from each member compares only with members not reached yet."""
    parsed = [_parsed(m) for m in marks]
    levels = np.array([level for level, _ in parsed])
    forms = {}  # level: (bits of the members up to it, their numbers)
    for top in set(levels.tolist()):
        bits = [_at_level(own, level, top, SEED) if level <= top else own[:0] for level, own in parsed]
        sizes = np.array([len(x) for x in bits])
        table = np.full((len(bits), sizes.max()), 2, np.uint8)
        table[np.arange(sizes.max()) < sizes[:, None]] = np.concatenate(bits)
        forms[top] = table, sizes
    links, rest = [], np.arange(len(marks))
    while len(rest):
        todo, rest = [int(rest[0])], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            alike = np.zeros(len(rest))
            tops = np.maximum(levels[rest], levels[i])
            for top in set(tops.tolist()):
                table, sizes = forms[top]
                at = np.flatnonzero(tops == top)
                among, n = rest[at], sizes[i]
                longer, shared = np.maximum(sizes[among], n), np.minimum(sizes[among], n)
                agree = (table[among, :n] == table[i, :n]).sum(1) + 0.5 * (longer - shared)
                alike[at] = np.where(longer > 0, np.maximum(0.0, 2.0 * agree / np.maximum(longer, 1) - 1.0), 0.0)
            found = np.flatnonzero(alike >= least)
            links += [(i, int(rest[k]), float(alike[k])) for k in found]
            todo += rest[found].tolist()
            rest = np.delete(rest, found)
    return links


def edited_pairs(docs: DataFrame, bands: int = 24, width: int = 16, least: float = 0.8) -> DataFrame:
    """(a, b, likeness): links between classes of equal texts whose fingerprints are at
    least ``least`` alike, by their smallest ids, found where bands of sampled bits agree.

    Enough links are given to join every two classes that meet in a band and are alike,
    be it by a chain: all classes of a bucket are searched, not only beside its smallest
    one. Classes of equal fingerprints are linked with the smallest of them, which stands
    for them in the bands. A bucket is searched by one task. Rows without an id stay out.
    """
    marks = with_fingerprints(docs).select("doc_id", "fingerprint", F.sha2("text", 256).alias("digest")).filter("doc_id IS NOT NULL")
    classes = marks.groupBy("digest", "fingerprint").agg(F.min("doc_id").alias("mark_id")).drop("digest")
    heads = classes.groupBy("fingerprint").agg(F.min("mark_id").alias("a"))
    equal = classes.join(heads, "fingerprint").filter("a <> mark_id").select("a", F.col("mark_id").alias("b"), F.lit(1.0).alias("likeness"))
    keyed = heads.withColumnRenamed("a", "mark_id").mapInArrow(_band_body(bands, width), "mark_id bigint, fingerprint string, band string")
    met = keyed.repartition("band").sortWithinPartitions("band")
    return met.mapInArrow(_link_body(least), "a bigint, b bigint, likeness double").unionByName(equal).distinct()


def _neighbour_body(batches):
    """mapInArrow body over rows sorted by (part, head last, doc_id, text): every row that
    is no head meets the row after it."""
    last = None
    for batch in batches:
        texts, ids = strings(batch, "text"), batch.column("doc_id").to_pylist()
        part, head = batch.column("part").to_pylist(), batch.column("head").to_pylist()
        for a, b in by_size([len(t) for t in texts], CHUNK_CHARS):
            rows = ([last] if last else []) + list(zip(ids[a:b], texts[a:b], part[a:b], head[a:b]))
            last = rows.pop()
            yield _compared([(r, n) for r, n in zip(rows, [*rows[1:], last]) if not r[3]])
    if last and not last[3]:
        # Only the whole table's single row ends without a head after it: its own next.
        yield _compared([(last, last)])


def _compared(pairs):
    import hashlib

    texts = [row[1] for row, _ in pairs]
    nexts = [follower[1] for _, follower in pairs]
    edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(texts, nexts)]
    # A row's text is mostly also the next of the row before it: one walk serves both.
    unique = list(dict.fromkeys(texts + nexts))
    marks = dict(zip(unique, fingerprints(unique)))
    changed = fingerprints(edited)
    own = [marks[t] for t in texts]
    columns = [
        pa.array([row[0] for row, _ in pairs], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited], pa.string()),
        pa.array(own, pa.string()), pa.array(changed, pa.string()),
        pa.array([likeness(x, y) for x, y in zip(own, changed)], pa.float64()),
        pa.array([likeness(x, marks[n]) for x, n in zip(own, nexts)], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def compare_with_next(docs: DataFrame, pieces: int | None = None) -> DataFrame:
    """Each document beside the one after it by ascending doc_id (after the last: the first).

    The edited text has its last quarter replaced by the beginning of the next text.
    NULL text is ''; NULL ids come first; rows of one id follow each other by text. One
    row in gives one row out; an empty table gives none; a single row is its own next.

    The id range is cut into pieces of equal row count. A piece's first row (or rows, if
    they share an id) also goes, marked, to the end of the piece before it, so no window
    over the whole table is needed and texts shuffle once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))
    pieces = pieces or 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / pieces for i in range(1, pieces)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 10_000).alias("cuts"), F.min("doc_id").alias("low"), F.count("*").alias("n"), F.count_if(F.isnull("doc_id")).alias("nulls")).first()
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    if not found.n:
        return spark.createDataFrame([], schema)
    cuts = np.array(sorted(set(found.cuts or []) - {found.low}), np.int64)

    @F.pandas_udf("int")
    def piece(ids):
        import pandas as pd

        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), side="right").astype(np.int32))

    part = piece(F.coalesce("doc_id", F.lit(-(2**63))))
    placed = rows.withColumn("part", part).withColumn("head", F.lit(False))
    first = F.col("doc_id").isNull() if found.nulls else F.col("doc_id") == found.low
    starts = F.col("doc_id").isin([int(c) for c in cuts]) if len(cuts) else F.lit(False)
    heads = rows.filter(starts | first).select(
        "doc_id", "text",
        F.when(first, F.lit(len(cuts))).otherwise(part - 1).cast("int").alias("part"), F.lit(True).alias("head"),
    )
    ordered = placed.unionByName(heads).repartition("part").sortWithinPartitions("part", "head", "doc_id", "text")
    return ordered.mapInArrow(_neighbour_body, schema)
