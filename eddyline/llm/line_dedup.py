"""Reversible removal of lines that many documents share.

State, in a folder all executors reach:

* ``references``: the exact table. One row per change: (key, doc_id, +1 or -1) for each
  distinct key of a document inserted or deleted. A document refers to a key if the last
  change that names both is an insertion, so a repeated insertion counts once.
* ``repeated``: the counts of the keys that reach ``min_docs`` documents, with the
  largest document of each.
* ``filters``: one cuckoo filter per shard over those keys. An insertion adds the keys that
  got there, a deletion takes out those that fell below. A shard is a slice of the key hash.
* ``state``: which tables are current. It is written last, so a change that did not finish
  has not happened, and an index opened again on its folder goes on from there.

``dedupe`` asks the filters about each line key; only keys they report go on to the
exact table, which settles false alarms and names the document that keeps its lines.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm.common import ASCII_SPACE, ascii_lower, parts, slices, strings, whole_text
from eddyline.llm.cuckoo import CuckooFilter, built

KEY = ["hi", "lo"]
REFERENCE = "hi bigint, lo bigint, doc_id bigint, delta int"
FILTER = "shard int, kept binary"
STATE = "changes int, shards int, filters_path string, repeated_path string"
REPEATED = "hi bigint, lo bigint, n_docs bigint, last_doc bigint"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def _hashed(key: Column) -> list[Column]:
    """128 bits of a key; two keys are taken as equal when all 128 agree."""
    return [F.xxhash64(key).alias("hi"), F.xxhash64(F.lit(1), key).alias("lo")]


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, hi, lo) once per key and row: repeats inside a text go before the explode."""
    lines = F.array_distinct(F.split(whole_text(), "\n", -1))
    keys = docs.select("doc_id", F.explode(lines).alias("line")).select("doc_id", line_key(F.col("line")).alias("key"))
    return keys.filter(F.length("key") >= min_chars).select("doc_id", *_hashed(F.col("key"))).distinct()


def _shard(n: int) -> Column:
    return F.pmod(F.shiftright("hi", 8), F.lit(n)).cast("int")


def _build(batches):
    """mapInArrow body over rows (shard, hi) sorted by shard: one filter per shard."""
    shard, held = None, []
    for batch in batches:
        shards, keys = batch.column("shard").to_numpy(), batch.column("hi").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1), len(shards)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if shard is not None and shards[a] != shard:
                yield _row(shard, built(np.concatenate(held)).to_bytes())
                held = []
            shard = shards[a]
            held.append(keys[a:b].view(np.uint64).copy())
    if shard is not None:
        yield _row(shard, built(np.concatenate(held)).to_bytes())


def _update(batches):
    """mapInArrow body over (shard, kept, hi, change) sorted by shard with the filter's
    row first: applies a shard's insertions and deletions to its filter."""
    shard, kept, add, drop = None, None, [], []

    def done():
        current = kept or CuckooFilter(len(add))
        if drop:
            current.delete(np.array(drop, np.int64).view(np.uint64))
        if add and not current.insert(np.array(add, np.int64).view(np.uint64)):
            return None
        return current.to_bytes()

    for batch in batches:
        for s, blob, hi, change in zip(*[batch.column(c).to_pylist() for c in ("shard", "kept", "hi", "change")]):
            if s != shard:
                if shard is not None:
                    yield _row(shard, done())
                shard, kept, add, drop = s, None, [], []
            if blob is not None:
                kept = CuckooFilter.from_bytes(blob)
            elif change > 0:
                add.append(hi)
            else:
                drop.append(hi)
    if shard is not None:
        yield _row(shard, done())


def _row(shard, blob):
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([blob], pa.binary())], names=["shard", "kept"])


def _probe(batches):
    """mapInArrow body over filters and keys sorted by (shard, filter first): passes on
    the keys that their shard's filter reports. Holds one filter at a time."""
    shard, kept = None, None
    for batch in batches:
        shards, keys = batch.column("shard").to_numpy(), batch.column("hi").fill_null(0).to_numpy()
        is_key = batch.column("is_key").to_numpy(zero_copy_only=False)
        hit = np.zeros(len(shards), bool)
        heads = np.flatnonzero(~is_key)
        cuts = sorted({0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), *(heads + 1).tolist(), *heads.tolist(), len(shards)})
        for a, b in zip(cuts, cuts[1:]):
            if not is_key[a]:
                shard, kept = shards[a], CuckooFilter.from_bytes(batch.column("kept")[a].as_py())
            elif shards[a] == shard and kept is not None:
                hit[a:b] = kept.contains(keys[a:b].view(np.uint64))
        yield batch.select(["doc_id", "hi", "lo"]).filter(pa.array(hit))


class LineIndex:
    """Reference counts and filters of the lines of a growing and shrinking corpus.

    A line's key is the line without ASCII white space at both ends, A-Z in lower case;
    keys under ``min_chars`` code points are not counted. NULL and empty texts are one
    empty line. Rows with the same ``doc_id`` are one document; a NULL id is an id of its
    own below all others. Delete a document with the text it has; inserting it again,
    as a retried batch does, changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, min_docs: int = 3, min_chars: int = 20, keys_per_shard: int = 1 << 18):
        self.spark, self.path = spark, path
        self.min_docs, self.min_chars, self.keys_per_shard = min_docs, min_chars, keys_per_shard
        self.changes, self.shards = 0, 0
        self.filters_path = self.repeated_path = None
        self._load()

    def _load(self) -> None:
        state = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/state")
        files = state.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if files.exists(state):
            done = [int(f.getPath().getName()) for f in files.listStatus(state)]
            for number in sorted(done, reverse=True):
                row = self.spark.read.schema(STATE).parquet(f"{self.path}/state/{number}").first()
                if row is not None:
                    self.changes, self.shards, self.filters_path, self.repeated_path = row
                    return

    def _save(self) -> None:
        row = [(self.changes, self.shards, self.filters_path, self.repeated_path)]
        self.spark.createDataFrame(row, STATE).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/state/{self.changes}")

    # -- exact table

    def _references(self) -> DataFrame:
        return self.spark.read.schema(f"{REFERENCE}, change int").option("basePath", f"{self.path}/references").parquet(
            *[f"{self.path}/references/change={i}" for i in range(self.changes)]
        )

    def counts(self, references: DataFrame | None = None) -> DataFrame:
        """(hi, lo, n_docs, last_doc) of every referenced key, exact."""
        held = self._references() if references is None else references
        if self.changes > 1:
            held = held.groupBy(*KEY, "doc_id").agg(F.max_by("delta", "change").alias("delta")).filter("delta > 0")
        return held.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))

    def _over_limit(self, references: DataFrame | None = None) -> DataFrame:
        return self.counts(references).filter(F.col("n_docs") >= self.min_docs)

    def repeated(self) -> DataFrame:
        """The keys whose lines go, as a table: a join with it shuffles both sides, so a
        very frequent key can be split."""
        return self.spark.read.schema(REPEATED).parquet(self.repeated_path)

    def _write_repeated(self, rows: DataFrame) -> None:
        path = f"{self.path}/repeated/{self.changes}-{uuid.uuid4().hex}"
        rows.select("hi", "lo", "n_docs", "last_doc").write.parquet(path)
        self.repeated_path = path

    # -- changes

    def insert(self, docs: DataFrame) -> None:
        self._change(docs, 1)

    def delete(self, docs: DataFrame) -> None:
        self._change(docs, -1)

    def _change(self, docs: DataFrame, sign: int) -> None:
        step = f"{self.path}/references/change={self.changes}"
        keys = line_keys(docs, self.min_chars).withColumn("delta", F.lit(sign))
        keys.select(*KEY, "doc_id", "delta").write.mode("overwrite").parquet(step)
        self.changes += 1
        if self.changes == 1:
            self._write_repeated(self._over_limit())
            self._build_filters()
        else:
            self._apply(step)
        self._save()

    def _apply(self, step: str) -> None:
        changed = self.spark.read.schema(REFERENCE).parquet(step)
        touched = changed.select(*KEY).distinct()
        # Only touched keys are counted again.
        now = self._references().join(touched, KEY, "left_semi")
        held = self.repeated()
        untouched = held.join(touched, KEY, "left_anti")
        before = held.join(touched, KEY, "left_semi")
        self._write_repeated(untouched.unionByName(self._over_limit(now)))
        after = self.repeated().join(touched, KEY, "left_semi")
        added = after.join(before, KEY, "left_anti").select(*KEY, F.lit(1).alias("change"))
        dropped = before.join(after, KEY, "left_anti").select(*KEY, F.lit(-1).alias("change"))
        self._update_filters(added.unionByName(dropped))

    # -- filters

    def _filters(self) -> DataFrame:
        return self.spark.read.schema(FILTER).parquet(self.filters_path)

    def _write_filters(self, filters: DataFrame) -> None:
        path = f"{self.path}/filters/{self.changes}-{uuid.uuid4().hex}"
        filters.write.parquet(path)
        self.filters_path = path

    def _build_filters(self) -> None:
        keys = self.repeated().select("hi")
        # Shards follow the number of keys, so no filter outgrows a task.
        self.shards = max(1, -(-keys.count() // self.keys_per_shard))
        placed = keys.select(_shard(self.shards).alias("shard"), "hi").repartition("shard").sortWithinPartitions("shard")
        self._write_filters(placed.mapInArrow(_build, FILTER))

    def _update_filters(self, changes: DataFrame) -> None:
        rows = changes.select(_shard(self.shards).alias("shard"), F.lit(None).cast("binary").alias("kept"), "hi", "change")
        current = self._filters().select("shard", "kept", F.lit(None).cast("bigint").alias("hi"), F.lit(0).alias("change"))
        ordered = current.unionByName(rows).withColumn("rank", F.col("kept").isNull()).repartition("shard").sortWithinPartitions("shard", "rank")
        self._write_filters(ordered.drop("rank").mapInArrow(_update, FILTER))
        if not self._filters().filter("kept IS NULL").isEmpty():
            self._build_filters()  # a shard is full: more shards, larger filters

    # -- use

    def suspects(self, docs: DataFrame) -> DataFrame:
        """(doc_id, hi, lo) of the lines that the filters report.

        A shard's keys go to several tasks, each with a copy of that shard's filter: to 16
        at least, so a line that a third of all documents hold is spread, and to enough
        of them to keep all tasks busy while there are few shards. A task streams over
        its keys with one filter in memory.
        """
        salts = max(16, -(-4 * parts(self.spark) // self.shards))
        keys = line_keys(docs, self.min_chars).select(
            _shard(self.shards).alias("shard"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
            F.lit(True).alias("is_key"), F.lit(None).cast("binary").alias("kept"), "doc_id", *KEY,
        )
        filters = self._filters().select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(False).alias("is_key"), "kept",
            F.lit(None).cast("bigint").alias("doc_id"), *[F.lit(None).cast("bigint").alias(k) for k in KEY],
        )
        met = filters.unionByName(keys).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "is_key")
        return met.mapInArrow(_probe, "doc_id bigint, hi bigint, lo bigint")

    def drops(self, docs: DataFrame) -> DataFrame:
        """(doc_id, keys): the keys whose lines a document loses, as one sorted array."""
        exact = self.suspects(docs).join(self.repeated(), KEY).filter(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
        return exact.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("drop_keys"))

    def dedupe(self, docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """``docs`` without the lines that at least ``min_docs`` documents share; the
        largest doc_id that holds a line keeps it, wherever it stands in that text.

        Adds ``n_lines`` (before) and ``n_dropped`` beside ``doc_id, text``; lines kept are
        joined by newline and unchanged. A text that loses every line becomes ''. Columns
        named in ``keep`` pass through.
        """
        drops = self.drops(docs).withColumnRenamed("doc_id", "drop_id")
        rows = docs.select("doc_id", whole_text().alias("text"), F.struct(*keep, F.lit(0)).alias("kept"))
        met = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("drop_id")), "left")
        lines = F.split("text", "\n", -1)
        hashes = F.transform(lines, lambda x: F.struct(*_hashed(line_key(x))))
        # Where a document loses something, the lines' hashes travel with it to the task
        # that cuts the text; other texts pass through untouched.
        held = F.when(F.col("drop_keys").isNotNull(), hashes)
        cutting = met.select("doc_id", "text", F.size(lines).cast("bigint").alias("n_lines"), "drop_keys", held.alias("hashes"), "kept")
        carried = cutting.schema["kept"].dataType.simpleString()
        cut = cutting.mapInArrow(_cut, f"doc_id bigint, text string, n_lines bigint, n_dropped bigint, kept {carried}")
        return cut.select("doc_id", "text", "n_lines", "n_dropped", *[F.col(f"kept.{c}").alias(c) for c in keep])


def _cut(batches):
    """mapInArrow body: takes the lines with a dropped key out of the texts."""
    for batch in (part for whole in batches for part in slices(whole, "text", 1 << 20)):
        texts, dropped = strings(batch, "text"), np.zeros(batch.num_rows, np.int64)
        drop_keys, hashes = batch.column("drop_keys"), batch.column("hashes")
        for i in np.flatnonzero(drop_keys.is_valid().to_numpy(zero_copy_only=False)):
            lose = set(_pairs(drop_keys[int(i)].values))
            lines = texts[i].split("\n")
            kept = [line for line, key in zip(lines, _pairs(hashes[int(i)].values)) if key not in lose]
            dropped[i] = len(lines) - len(kept)
            texts[i] = "\n".join(kept)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.string()), batch.column("n_lines"), pa.array(dropped), batch.column("kept")],
            names=["doc_id", "text", "n_lines", "n_dropped", "kept"],
        )


def _pairs(structs) -> list[tuple[int, int]]:
    return list(zip(structs.field("hi").to_pylist(), structs.field("lo").to_pylist()))
