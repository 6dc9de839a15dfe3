"""Benchmark items inside documents: MinHash containment search by item size, then an
exact check. Only DataFrame functions; no Python runs on the executors.

Items are partitioned by the number n of their distinct word shingles (powers of two).
An item's sketch is its k smallest shingle hashes, with one k for a partition: one more
than the shingles that an item of that partition may lack. A document that contains the
item to ``least`` therefore holds at least one shingle of the sketch, so the search loses
nothing, however long the document is. Each partition's largest sketch hash bounds which
shingles of a document can matter to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.common import whole_text, written

WIDTH = 5
LEAST = 0.8


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case; a text without any gives ['']."""
    return F.split(F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def shingles(w: Column, width: int, of) -> Column:
    """All runs of ``width`` words through ``of``; a shorter text is a single one."""
    last = F.greatest(F.size(w) - width + 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), last), lambda i: of(w, i))


def _hashes(hashed: Column, width: int) -> Column:
    """Shingle hashes from word hashes: no shingle string is built. Absent words of a
    short text are NULL, which the hash skips."""
    return shingles(hashed, width, lambda w, i: F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(width)]))


def _strings(w: Column, width: int) -> Column:
    return shingles(w, width, lambda w, i: F.array_join(F.slice(w, i, width), " "))


def _hashed_words(rows: DataFrame, key: str) -> DataFrame:
    worded = rows.select(key, words(whole_text()).alias("w"))
    return worded.select(key, "w", F.transform("w", lambda x: F.xxhash64(x)).alias("hashed"))


def item_shingles(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item_id, shingle, hash, n): distinct shingles of each item and their number.
    Items without id or words have none; rows that repeat an id count as one item."""
    rows = _hashed_words(items.filter("item_id IS NOT NULL"), "item_id").filter(F.col("w") != F.array(F.lit("")))
    pairs = F.arrays_zip(_strings(F.col("w"), width).alias("shingle"), _hashes(F.col("hashed"), width).alias("hash"))
    exploded = rows.select("item_id", F.explode(F.array_distinct(pairs)).alias("s")).select("item_id", "s.shingle", "s.hash").distinct()
    return exploded.withColumn("n", F.count("*").over(Window.partitionBy("item_id")))


def sketches(of_items: DataFrame, least: float = LEAST) -> DataFrame:
    """(size_class, hash, item_id, bound): the index. A class holds the items with
    2^size_class to 2^(size_class + 1) - 1 shingles; ``bound`` is its largest hash."""
    size_class = F.floor(F.log2("n")).cast("int")
    largest = F.pow(F.lit(2.0), F.col("size_class") + 1).cast("bigint") - 1
    k = largest - F.ceil(largest * F.lit(least) - 1e-9) + 1
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("hash", "shingle"))
    kept = of_items.withColumn("size_class", size_class).withColumn("rank", rank).filter(F.col("rank") <= k)
    bound = F.max("hash").over(Window.partitionBy("size_class"))
    return kept.select("size_class", "hash", "item_id").distinct().withColumn("bound", bound)


def candidates(docs: DataFrame, index: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, item_id) that share a sketch hash. One pass over the texts; what leaves a
    task are the pairs found in it, once each."""
    bounds = index.agg(F.max("bound").alias("most")).first()
    rows = _hashed_words(docs, "doc_id").select("doc_id", F.explode(_hashes(F.col("hashed"), width)).alias("hash"))
    small = rows.filter(F.col("hash") <= (bounds.most if bounds.most is not None else -(2**63)))
    met = small.join(index.select("hash", "item_id", "bound"), "hash").filter(F.col("hash") <= F.col("bound"))
    return met.groupBy("doc_id", "item_id").agg(F.count("*").alias("sketch_hits"))


def leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """``doc_id, item_id, shared, item_shingles, containment`` for every pair of which the
    document holds at least ``least`` of the item's distinct ``width``-word shingles.

    Words are runs of letters and digits in lower case, so case and punctuation do not
    hide a copy. NULL texts are empty and hold nothing. Texts and items of fewer than
    ``width`` words are one shingle each: such an item is found where it is the whole
    text. Documents without an id are left out; rows of one id count as one document.
    Repeated passages in a document count once. Empty tables give no rows.

    The item side is the benchmark: it is written once, so its size is known and the
    optimizer broadcasts it only under its threshold.
    """
    of_items = written(item_shingles(items.select("item_id", "text"), width), "item-shingles")
    index = written(sketches(of_items, least), "item-sketches")
    known = docs.filter("doc_id IS NOT NULL").select("doc_id", "text")
    found = written(candidates(known, index, width), "leak-candidates")
    # Exact check: only candidate documents are read again, word for word.
    suspects = known.join(found.select("doc_id").distinct(), "doc_id", "left_semi")
    spoken = suspects.select("doc_id", words(whole_text()).alias("w")).select(
        "doc_id", F.explode(F.array_distinct(_strings(F.col("w"), width))).alias("shingle")
    )
    # Shingles that no item has leave before anything is shuffled or counted.
    spoken = spoken.join(of_items.select("shingle").distinct(), "shingle", "left_semi")
    wanted = spoken.join(of_items.select("shingle", "item_id", "n"), "shingle")
    shared = wanted.groupBy("doc_id", "item_id", "n").agg(F.count_distinct("shingle").alias("shared"))
    proven = shared.join(found.select("doc_id", "item_id"), ["doc_id", "item_id"], "left_semi")
    enough = F.col("shared") >= F.ceil(F.col("n") * F.lit(least) - 1e-9)
    return proven.filter(enough).select(
        "doc_id", "item_id", "shared", F.col("n").alias("item_shingles"), (F.col("shared") / F.col("n")).alias("containment")
    )
