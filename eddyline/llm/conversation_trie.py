"""Prefix trie of conversations: which conversations begin with the same turns.

A prefix is known by 128 bits: the XOR, over its turns, of a hash of (depth, turn). A
prefix's parent is then one XOR away, and prefixes of a very long conversation can be
summed in chunks. A count-min sketch with counters that stop at two screens all prefixes:
where it says one, the prefix belongs to one conversation only, and its node is written
from the row at hand. Only the other prefixes are shuffled and grouped exactly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.common import parts, whole_text, written

CHUNK = 4096  # turns of one conversation that one window holds
BLOCK = 1 << 15  # cells of the sketch in one row
MOST_CELLS = 1 << 26  # of each of the sketch's two rows: 16 MB in all, on every executor
SKETCH_TASKS = 512
END_IDS = 1024  # conversation ids that one piece of a list of ends spans
LOW = (1 << 33) - 1  # row numbers of one partition in monotonically_increasing_id


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, digest, n_bytes, n_turns``: the turns of
    ``conversations(conv_id, turn, role, text)`` numbered from 1 within a conversation.

    Turns are in the order of ``turn``, NULL first; equal ones follow by the digest of
    (role, text), repeated rows each count. A NULL role or text is empty. Rows without
    a conv_id are in no conversation. Other columns are ignored. The order comes from one
    sort by ranges, so a conversation with most of the rows lies in many tasks.
    """
    spark = conversations.sparkSession
    role, text = whole_text("role"), whole_text()
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"), F.monotonically_increasing_id().alias("tag"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("tag")]
    lined = written(
        written(turns, "turns").repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
        .select("conv_id", "digest", "n_bytes", F.monotonically_increasing_id().alias("row")),
        "turn-order",
    )
    share = F.shiftright("row", 33)
    before, offsets = 0, []
    for part, n in sorted(map(tuple, lined.groupBy(share.alias("part")).count().collect())):
        offsets.append((part, before))
        before += n
    placed = lined.withColumn("part", share).join(
        F.broadcast(spark.createDataFrame(offsets, "part bigint, before bigint")), "part"
    ).withColumn("at", F.col("before") + F.col("row").bitwiseAND(LOW))
    starts = written(placed.groupBy("conv_id").agg(F.min("at").alias("start"), F.count("*").alias("n_turns")), "turn-starts")
    return placed.join(starts, "conv_id").select(
        "conv_id", (F.col("at") - F.col("start") + 1).alias("pos"), "digest", "n_bytes", "n_turns"
    )


def _running(rows: DataFrame, fold, combine, names: list[str], back: bool) -> DataFrame:
    """Replaces ``names`` by their running folds along each conversation's ``depth``,
    from its end if ``back``. Conversations longer than a chunk are folded chunk by
    chunk, and each chunk is handed the fold of those before it. ``length`` is the highest
    depth of the row's conversation, or more."""
    chunk = (F.col("depth") / CHUNK).cast("bigint")
    rows = rows.withColumn("chunk", chunk)
    order = F.col("depth").desc() if back else F.col("depth")
    inside = Window.partitionBy("conv_id", "chunk").orderBy(order).rangeBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy(F.col("chunk").desc() if back else F.col("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    handed = rows.filter(F.col("length") >= CHUNK).groupBy("conv_id", "chunk").agg(*[fold(n).alias(n) for n in names]).select(
        "conv_id", "chunk", *[fold(n).over(earlier).alias(f"{n}_before") for n in names]
    )
    kept = [c for c in rows.columns if c not in names]
    local = rows.select(*kept, *[fold(n).over(inside).alias(n) for n in names])
    return local.join(handed, ["conv_id", "chunk"], "left").select(
        *[c for c in kept if c != "chunk"],
        *[combine(F.col(n), F.coalesce(F.col(f"{n}_before"), F.lit(0).cast("bigint"))).alias(n) for n in names],
    )


def _prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, n_bytes, length``, the prefix (p1, p2) that ends with the turn,
    and the one before it (q1, q2). The empty prefix is (0, 0)."""
    own = turns.select(
        "conv_id", "depth", "n_bytes", "length",
        F.xxhash64("depth", "digest").alias("x1"), F.xxhash64(F.lit(1), "depth", "digest").alias("x2"),
    ).select("*", F.col("x1").alias("p1"), F.col("x2").alias("p2"))
    return _running(own, F.bit_xor, lambda a, b: a.bitwiseXOR(b), ["p1", "p2"], False).select(
        "conv_id", "depth", "n_bytes", "length", "p1", "p2",
        F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"),
    )


def _cells(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(width - 1)


def _count(width: int):
    """mapInArrow body: which cells this task met once, and which at least twice."""

    def body(batches):
        counts = np.zeros((2, width), np.uint8)
        for batch in batches:
            for line, name in zip(counts, ("p1", "p2")):
                cells, times = np.unique(_cells(batch, name, width), return_counts=True)
                line[cells] = np.minimum(line[cells] + np.minimum(times, 2), 2)
        for k, line in enumerate(counts):
            for a in range(0, width, BLOCK):
                some = line[a : a + BLOCK]
                if some.any():
                    yield pa.RecordBatch.from_pylist([{
                        "line": k, "block": a // BLOCK,
                        "once": np.packbits(some > 0).tobytes(), "twice": np.packbits(some > 1).tobytes(),
                    }], schema=_BLOCKS)

    return body


_BLOCKS = pa.schema([("line", pa.int32()), ("block", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    """The blocks of all tasks as one: met twice in a task, or in two tasks."""
    once = np.zeros(BLOCK // 8, np.uint8)
    twice = once.copy()
    for a, b in zip(group["once"], group["twice"]):
        a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
        n = len(a)
        twice[:n] |= b | (once[:n] & a)
        once[:n] |= a
    return pd.DataFrame({"line": [group["line"].iloc[0]], "block": [group["block"].iloc[0]], "twice": [twice.tobytes()]})


def sketch_width(n_prefixes: int) -> int:
    """Cells of a sketch row: twice the prefixes, as a power of two, within the bound."""
    return min(MOST_CELLS, max(1 << 12, 1 << (2 * n_prefixes - 1).bit_length()))


def _sketch(prefixes: DataFrame, width: int) -> np.ndarray:
    """Two rows of cells: True where the count-min sketch of all prefixes counts two or more."""
    rows = prefixes.select("p1", "p2")
    if rows.rdd.getNumPartitions() > SKETCH_TASKS:
        rows = rows.coalesce(SKETCH_TASKS)
    blocks = rows.mapInArrow(_count(width), "line int, block int, once binary, twice binary")
    merged = blocks.groupBy("line", "block").applyInPandas(_merge, "line int, block int, twice binary")
    bits = np.zeros((2, max(width, BLOCK) // 8), np.uint8)
    for line, block, twice in merged.collect():
        bits[line, block * BLOCK // 8 : (block + 1) * BLOCK // 8] = np.frombuffer(twice, np.uint8)
    return bits


def _screen(sketch, width: int):
    """mapInArrow body: adds ``shared`` (the sketch does not prove the prefix single) and
    ``top`` (the prefix before it is not proven single either; the empty one never is)."""

    def several(batch, names):
        found = np.ones(batch.num_rows, bool)
        for line, name in zip(sketch.value, names):
            cells = _cells(batch, name, width)
            found &= (line[(cells >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (cells & np.uint64(7)).astype(np.uint8))) & 1 == 1
        return found

    def body(batches):
        for batch in batches:
            top = several(batch, ("q1", "q2")) | (batch.column("depth").to_numpy() == 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(several(batch, ("p1", "p2"))), pa.array(top)], names=[*batch.schema.names, "shared", "top"]
            )

    return body


def _hash_ends(batches):
    """mapInArrow body over pieces of lists in order of (prefix, piece): one hash per list,
    fed piece by piece."""
    schema = pa.schema([("p1", pa.int64()), ("p2", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    held, digest = None, None
    for batch in batches:
        out = []
        for p1, p2, depth, ids in zip(*[batch.column(n).to_pylist() for n in ("p1", "p2", "depth", "ids")]):
            if (p1, p2, depth) != held:
                if held is not None:
                    out.append((*held, digest.hexdigest()))
                held, digest = (p1, p2, depth), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*held, digest.hexdigest()), schema)], schema=schema)


def _ends(ended: DataFrame) -> DataFrame:
    """Per prefix the SHA-256 of the ids of the conversations that end with it."""
    piece = F.floor(F.col("conv_id") / END_IDS)
    pieces = ended.groupBy("p1", "p2", "depth", piece.alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    return pieces.repartition("p1", "p2", "depth").sortWithinPartitions("p1", "p2", "depth", "piece").mapInArrow(
        _hash_ends, "p1 bigint, p2 bigint, depth bigint, ends_sha256 string"
    )


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations, the empty prefix included.

    ``turns(conv_id, depth, digest, n_bytes, length)`` has the turns of every conversation
    at depths 1 to ``length``; ``lengths(conv_id, length)`` names each conversation once,
    also those without turns. Result: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (NULL for the root), ``n_convs`` (members), ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over the subtree: members less one, times the bytes of
    the node's last text) and ``ends_sha256`` (over the ascending ids of the members that
    end here, joined by commas). No conversations: no rows, not even a root.
    """
    spark = turns.sparkSession
    rows = written(_prefixes(turns), "prefixes")
    n_rows = rows.count()
    width = sketch_width(max(n_rows, 1))
    sketch = spark.sparkContext.broadcast(_sketch(rows, width))
    screened = rows.mapInArrow(
        _screen(sketch, width),
        "conv_id bigint, depth bigint, n_bytes bigint, length bigint, p1 bigint, p2 bigint, q1 bigint, q2 bigint, shared boolean, top boolean",
    )
    several = written(screened.filter("shared").drop("shared", "top"), "shared-prefixes")
    single = written(screened.filter("NOT shared").select("conv_id", "depth", "length", "q1", "q2", "top"), "single-prefixes")

    nodes = written(
        several.groupBy("p1", "p2", "depth").agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("q1").alias("q1"), F.min("q2").alias("q2"),
            F.max("length").alias("longest"), F.max("n_bytes").alias("n_bytes"),
        ).select(
            "p1", "p2", "depth", "conv_id", "n_convs", "q1", "q2", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
            (F.col("longest") == F.col("depth")).cast("bigint").alias("leaf"), F.col("longest").alias("length"),
        ),
        "nodes",
    )
    # The smallest member of a node is the smallest of all nodes below it on its own path.
    # So what a node adds to all above it is put down once, at its smallest member, folded
    # from the end of that conversation and then added up over the members of each node.
    none = F.lit(None).cast("bigint")
    zero = F.lit(0).cast("bigint")
    leaves = single.filter("depth = length").select("conv_id", "depth", none.alias("p1"), none.alias("p2"), zero.alias("saved"), (zero + 1).alias("leaf"), "length")
    put = nodes.filter("saved > 0 OR leaf > 0").select("conv_id", "depth", none.alias("p1"), none.alias("p2"), "saved", "leaf", "length")
    members = several.select("conv_id", "depth", "p1", "p2", zero.alias("saved"), zero.alias("leaf"), "length")
    along = written(members.unionByName(put).unionByName(leaves), "subtrees")
    folded = _running(along, F.sum, lambda a, b: a + b, ["saved", "leaf"], True)
    sums = folded.filter("p1 IS NOT NULL").groupBy("p1", "p2", "depth").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    tops = single.filter("top").select("conv_id", "depth", "q1", "q2")
    children = nodes.select("q1", "q2", "depth").unionByName(tops.select("q1", "q2", "depth")).groupBy(
        F.col("q1").alias("p1"), F.col("q2").alias("p2"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count("*").alias("n_children"))

    whole = _root(nodes, single, lengths).first()
    if whole is None:
        return spark.createDataFrame([], RESULT)
    root_conv = F.lit(whole["conv_id"]).cast("bigint")
    ended = several.filter("depth = length").select("p1", "p2", "depth", "conv_id").unionByName(
        lengths.filter("length = 0").select(zero.alias("p1"), zero.alias("p2"), zero.alias("depth"), "conv_id")
    )
    ends = written(_ends(ended), "ends")
    nothing = F.sha2(F.lit("").cast("binary"), 256)

    above = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above"))
    parent = F.when(F.col("depth") == 1, root_conv).otherwise(F.coalesce("above", "conv_id"))
    key = ["p1", "p2", "depth"]
    grouped = (
        nodes.join(sums, key).join(children, key, "left").join(ends, key, "left").join(above, ["q1", "q2", "depth"], "left")
        .select(
            "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", F.coalesce("n_children", zero).alias("n_children"),
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )
    last = F.col("depth") == F.col("length")
    one = (zero + 1)

    def alone(rows: DataFrame, parent_conv: Column) -> DataFrame:
        return rows.select(
            "conv_id", "depth", parent_conv.alias("parent_conv_id"), one.alias("n_convs"), F.when(last, zero).otherwise(one).alias("n_children"),
            one.alias("n_leaves"), zero.alias("saved_tokens"),
            F.sha2(F.when(last, F.col("conv_id").cast("string")).otherwise(F.lit("")).cast("binary"), 256).alias("ends_sha256"),
        )

    below = alone(single.filter("NOT top"), F.col("conv_id"))
    first = alone(single.filter("top AND depth = 1"), root_conv).unionByName(
        alone(single.filter("top AND depth > 1").join(above, ["q1", "q2", "depth"], "left"), F.coalesce("above", "conv_id"))
    )
    root = spark.createDataFrame([tuple(whole[n] for n in ROOT_FIELDS)], ", ".join(f"{n} bigint" for n in ROOT_FIELDS)).join(
        ends.filter("depth = 0").select("depth", "ends_sha256"), "depth", "left"
    ).select("conv_id", "depth", none.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
    return grouped.unionByName(below).unionByName(first).unionByName(root)


ROOT_FIELDS = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")
RESULT = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def _root(nodes: DataFrame, single: DataFrame, lengths: DataFrame) -> DataFrame:
    """The root's numbers as one row, or none where there is no conversation."""
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    first = (F.col("depth") == 1).cast("bigint")
    counted = [
        lengths.select("conv_id", (zero + 1).alias("n_convs"), zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens")),
        nodes.select(none.alias("conv_id"), zero.alias("n_convs"), first.alias("n_children"), F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens")),
        single.select(
            none.alias("conv_id"), zero.alias("n_convs"), first.alias("n_children"),
            (F.col("depth") == F.col("length")).cast("bigint").alias("n_leaves"), zero.alias("saved_tokens"),
        ),
    ]
    rows = counted[0].unionByName(counted[1]).unionByName(counted[2])
    return rows.agg(
        F.min("conv_id").alias("conv_id"), F.min(zero).alias("depth"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.greatest(F.sum("n_leaves"), zero + 1).alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
    ).filter("n_convs > 0")


def regrafted(turns: DataFrame, family: int = 5, spread: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths) of conversations that begin as another of their family does.

    Conversation c takes the first h turns of conversation c - c % ``family``, and then
    its own after its first h; h is crc32 of c in decimal, modulo ``spread``.
    """
    turns = written(turns, "placed-turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread
    heads = turns.filter(F.col("pos") < spread).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "n_bytes"))).alias("head")
    )
    own = turns.filter("pos = 1").select("conv_id", "n_turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    taken = F.least(F.col("h"), F.coalesce(F.size("head"), F.lit(0)))
    grafts = written(
        own.join(heads, "base", "left").select("conv_id", "n_turns", "h", F.when(F.col("head").isNull(), 0).otherwise(taken).cast("bigint").alias("taken"), "head")
        .select("conv_id", "h", "taken", F.slice(F.coalesce("head", F.array().cast(HEAD)), F.lit(1), F.col("taken").cast("int")).alias("head"),
                (F.col("taken") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("length")),
        "grafts",
    )
    first = grafts.select("conv_id", "length", F.explode("head").alias("t")).select(
        "conv_id", F.col("t.pos").alias("depth"), "t.digest", "t.n_bytes", "length"
    )
    rest = turns.filter(F.col("pos") > h).join(grafts.select("conv_id", "h", "taken", "length"), "conv_id").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "digest", "n_bytes", "length"
    )
    return first.unionByName(rest), grafts.select("conv_id", "length")


HEAD = "array<struct<pos:bigint,digest:binary,n_bytes:bigint>>"
