"""Models fitted on every labelled row: tasks learn from shards of rows, and after each
epoch what they learned is averaged.

Documents are dealt to shards by their id and kept as numbers, some at a time in a row of
bytes, so a task holds few of them at once. The same table gives the same shards and, as
averages are of whole numbers, the same model at any partitioning.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import give_back, remainder_of_id, whole_text, written

SHARD_ROWS = 16384
PACK_ITEMS = 1 << 16  # of its first list, at which a pack is closed
BROADCAST_ROWS = 1_000_000  # 24 MB of ids, targets and places
EMITTED_ROWS = 1 << 15
SCALE = float(1 << 32)


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int) -> tuple[DataFrame, int]:
    """``doc_id, target, shard, place, mark, text`` of all labelled documents, and how many
    shards there are.

    Rows of the held-out fold, rows without a label or id and labels without a document
    stay out; contradicting labels of one id count as the larger.
    """
    usable = labels.filter(
        F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder_of_id("doc_id", folds) != held_out)
    )
    one_each = usable.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(label).cast("int").alias("target"))
    n = one_each.count()
    shards = max(1, -(-n // SHARD_ROWS))
    dealt = one_each.withColumn("place", F.xxhash64("doc_id")).withColumn("shard", F.pmod("place", F.lit(shards)).cast("int"))
    # So many are a broadcast of proven size, and spare a shuffle of all texts.
    dealt = F.broadcast(dealt) if n <= BROADCAST_ROWS else dealt
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")).join(dealt, "doc_id")
    return rows.select("doc_id", "target", "shard", "place", F.xxhash64("text").alias("mark"), "text"), shards


KEYS = ("doc_id", "target", "shard", "place", "mark")
KEYS_DDL = "doc_id bigint, target int, shard int, place bigint, mark bigint"


def _packer(lists: list[str]):
    def pack(shard, held):
        rows = pa.Table.from_batches(held).combine_chunks()
        found = [rows["target"].combine_chunks(), *(rows[n].combine_chunks() for n in lists)]
        flat = [found[0].to_numpy(), np.diff(found[1].offsets.to_numpy()).astype(np.int32), *(f.flatten().to_numpy() for f in found[1:])]
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *(pa.array([f.tobytes()]) for f in flat)], names=["shard", "targets", "sizes", *lists])

    def body(batches):
        held, items, last, batch = [], 0, None, None
        for batch in batches:
            sizes = batch.column(lists[0]).value_lengths().to_pylist()
            for i, key in enumerate(zip(batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist())):
                if key == last:
                    continue
                if held and (key[0] != last[0] or items + sizes[i] > PACK_ITEMS):
                    yield pack(last[0], held)
                    held, items = [], 0
                held.append(batch.slice(i, 1))
                items, last = items + sizes[i], key
        if held:
            yield pack(last[0], held)
        del held, batch
        give_back()

    return body


def packed(rows: DataFrame, shards: int, lists: list[str], purpose: str) -> DataFrame:
    """``shard, targets, sizes`` and the flat ``lists`` of some of ``rows`` together, which
    have the ``KEYS`` and those lists; the numbers as bytes. Of rows with one id one counts,
    whichever order they come in. A shard is in one file, its packs in order."""
    ordered = rows.repartition(shards, "shard").sortWithinPartitions("shard", "place", "doc_id", "mark").drop("place", "mark")
    fields = ", ".join(["shard int", *(f"{n} binary" for n in ("targets", "sizes", *lists))])
    return written(ordered.mapInArrow(_packer(lists), fields), purpose)


def packs_of(batches, **lists):
    """(shard, targets, an iterator over each row's numbers for each of ``lists``, which are
    given with their types) of each pack."""
    for batch in batches:
        for i in range(batch.num_rows):
            read = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)  # noqa: E731, B023
            ends = np.cumsum(read("sizes", np.int32))[:-1]
            yield batch.column("shard")[i].as_py(), read("targets", np.int32), *(np.split(read(n, kind), ends) for n, kind in lists.items())


def _totals(batches):
    n = ones = 0
    for batch in batches:
        for targets in batch.column("targets"):
            found = np.frombuffer(targets.as_buffer(), np.int32)
            n, ones = n + len(found), ones + int(found.sum())
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([ones])], names=["n", "ones"])


def totals(packs: DataFrame) -> tuple[int, int]:
    """(rows, rows of label 1) of all packs."""
    n, ones = packs.select("targets").mapInArrow(_totals, "n bigint, ones bigint").agg(F.sum("n"), F.sum("ones")).first()
    return n or 0, ones or 0


def averaged(packs: DataFrame, state: tuple, learn: Callable, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of parameter rows, their values): each value the mean over the shards that
    learned its row. ``learn(batches, *state)`` yields such a pair for each shard. The state
    is broadcast, and given up when the means are there: workers outlive an epoch."""
    names = [f"v{i}" for i in range(width)]

    shared = packs.sparkSession.sparkContext.broadcast(state)

    def body(batches):
        for rows, values in learn(batches, *shared.value):
            for a in range(0, len(rows), EMITTED_ROWS):
                whole = np.rint(np.asarray(values[a : a + EMITTED_ROWS], np.float64) * SCALE).astype(np.int64)
                numbers = pa.array(rows[a : a + EMITTED_ROWS].astype(np.int32))
                yield pa.RecordBatch.from_arrays([numbers, *(pa.array(np.ascontiguousarray(c)) for c in whole.T)], names=["row", *names])

    learned = packs.mapInArrow(body, ", ".join(["row int", *(f"{n} bigint" for n in names)]))
    means = learned.groupBy("row").agg(*((F.sum(n) / F.count("row") / SCALE).alias(n) for n in names)).toArrow()
    shared.destroy()
    if not means.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, width))
    return means["row"].to_numpy().astype(np.int64), np.stack([means[n].to_numpy() for n in names], 1)
