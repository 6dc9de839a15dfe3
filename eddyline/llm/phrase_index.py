"""Phrases of two to five words and how much oftener they occur than chance, by a word-level
FM-index per shard of the texts.

A shard is some texts of one language in one task. Its index is the Burrows-Wheeler
transform of its word ids, in the order of suffixes by their first five words, and its
dictionary; the texts are read once. Stepping from row to row with the LF mapping extends
the intervals of all phrases by one word at once: the rows of an interval share a phrase,
their BWT symbols are its left extensions, and their order splits it by right extensions.
The counts of a phrase are added up over shards.

A phrase can only be frequent if its parts are. So words are counted first, then pairs of
frequent words, then triples of frequent pairs, and phrases last, of frequent parts alone.
Shards know these by bitmaps of hashes of bounded size: a false hit costs time, and the exact
sums decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.common import give_back, whole_text, written

DEPTH = 5
SHARD_WORDS = 1 << 18  # of one language, at which a task closes a shard
HELD_WORDS = 1 << 19  # of all languages together that a task holds
HELD_PHRASES = 1 << 17  # that a task adds to its sums at once
MOST_PHRASES = 1 << 19  # different ones that a task holds
SCREENED = 3  # words of the longest phrases that are summed by hash before they are by text
MOST_BITS = 1 << 27  # of a bitmap: 16 MB on every executor
BUCKET = 1 << 15  # bits of one bitmap row in Spark's bitmap functions
SALTS = 64
MIX = np.uint64(0x9E3779B97F4A7C15)
# The language of texts without one, what ends a piece, and what separates words.
NO_LANG = "und"
PIECE_END = r"[.,;:!?\x0A-\x0D]+"
BLANKS = "[ \t]+"
END = "\n"  # stands for the end of a piece; no word holds it

INDEX = pa.schema([("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.list_(pa.string())), ("bwt", pa.binary())])
COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("f", pa.int64())])
COUNTS_DDL = "lang string, phrase string, size int, f bigint"


def words_of(texts: pa.Array) -> pa.Array:
    """The words of all texts in order, an ``END`` after each piece."""
    lowered = pc.ascii_lower(texts)
    marked = pc.binary_join_element_wise(pc.replace_substring_regex(lowered, PIECE_END, f" {END} "), f" {END}", "")
    words = pc.list_flatten(pc.split_pattern_regex(marked, BLANKS))
    return words.filter(pc.not_equal(words, ""))


def _dense(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    ordered = keys[order]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
    return ranks


def transform(ids: np.ndarray) -> np.ndarray:
    """BWT of ``ids`` (0 ends a piece), suffixes ordered by their first five symbols and
    running on from the end to the start."""
    top = np.int64(ids.max() + 1)
    two = _dense(ids * top + np.roll(ids, -1))
    four = _dense(two * (two.max() + 1) + np.roll(two, -2))
    order = np.argsort(four * top + np.roll(ids, -4))
    return ids[order - 1]


def _shard(lang: str, chunks: list[pa.Array]) -> pa.RecordBatch:
    coded = pa.chunked_array(chunks).dictionary_encode().combine_chunks()
    codes, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    end = words.index(END).as_py()
    place = np.arange(1, len(words) + 1)
    place[end], place[end + 1 :] = 0, place[end + 1 :] - 1
    bwt = transform(place[codes]).astype("<i4")
    kept = words.filter(pc.not_equal(words, END))
    listed = pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept)
    return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([int((bwt > 0).sum())]), listed, pa.array([bwt.tobytes()])], schema=INDEX)


def _build(batches):
    """mapInArrow body: the indexes of a task's texts, one for each language and fill."""
    held, sizes = {}, {}
    for batch in batches:
        langs = batch.column("lang")
        for lang in pc.unique(langs).to_pylist():
            words = words_of(batch.column("text").filter(pc.equal(langs, lang)))
            held.setdefault(lang, []).append(words)
            sizes[lang] = sizes.get(lang, 0) + len(words)
            while sizes and (max(sizes.values()) >= SHARD_WORDS or sum(sizes.values()) >= HELD_WORDS):
                largest = max(sizes, key=sizes.get)
                del sizes[largest]
                yield _shard(largest, held.pop(largest))
    for lang in list(held):
        yield _shard(lang, held.pop(lang))


def build_index(docs: DataFrame) -> DataFrame:
    """One row per shard of ``docs(lang, text)``: its language, words and BWT."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), whole_text().alias("text"))
    return written(rows.mapInArrow(_build, "lang string, n_words bigint, words array<string>, bwt binary"), "fm-index")


def _hashes(lang: str, words) -> np.ndarray:
    """A hash for each word of a language."""
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), seed) for w in words], np.uint64)


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first * MIX) ^ ((second << np.uint64(31)) | (second >> np.uint64(33)))


def _word_keys(batches):
    """mapInArrow body: the low half of each word's hash."""
    for batch in batches:
        keys = [_hashes(lang, [word]) for lang, word in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())]
        yield _keyed(np.concatenate([np.array([], np.uint64), *keys]), None)


def _keyed(keys: np.ndarray, counts) -> pa.RecordBatch:
    low = pa.array(keys.astype(np.uint32).view(np.int32))
    return pa.RecordBatch.from_arrays([low] if counts is None else [low, pa.array(counts)], names=["key"] if counts is None else ["key", "f"])


def _bitmap(keys: DataFrame) -> np.ndarray:
    """The low bits of all ``key``, as a bitmap."""
    n = max(keys.count(), 1)
    n_bits = min(MOST_BITS, max(BUCKET, 1 << (16 * n - 1).bit_length()))
    # Spark numbers the bits of its bitmaps from 1.
    bit = F.col("key").cast("bigint").bitwiseAND(n_bits - 1) + 1
    rows = keys.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    bits = np.zeros(n_bits // 8, np.uint8)
    for bucket, some in rows.collect():
        bits[(bucket - 1) * BUCKET // 8 : bucket * BUCKET // 8] = np.frombuffer(some, np.uint8)
    return bits


def _known(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    places = keys & np.uint64(len(bits) * 8 - 1)
    return (bits[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _phrases(lang: str, words: pa.Array, columns: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
    parts = [words.take(pa.array(c - 1)) for c in columns]
    phrase = parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, " ")
    n = len(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), phrase, pa.array(np.full(n, len(columns), np.int32)), pa.array(counts.astype(np.int64))], schema=COUNTS
    )


def extend(bwt: np.ndarray, usable, sizes):
    """(word columns, counts) of all phrases of each of ``sizes`` words.

    ``usable(columns)`` says which phrases, given as columns of words, may be part of one;
    the others are not extended. Row j of the index goes to the row of the suffix that begins
    one word later, by the inverse of the LF mapping. A phrase of k + 1 words is a first word
    and, there, the interval of k words; its first k words are the interval of row j itself.
    """
    later = np.argsort(bwt, kind="stable")
    first = bwt[later]
    label, k = first, 1
    valid = first > 0
    valid[valid] = usable([first[valid]])
    while k < max(sizes):
        k += 1
        rows = np.flatnonzero(valid & valid[later])
        if not len(rows):
            return
        inner = label[later[rows]]
        new = np.concatenate([[True], (first[rows][1:] != first[rows][:-1]) | (inner[1:] != inner[:-1])])
        starts = np.flatnonzero(new)
        at, columns = rows[starts], []
        for _ in range(k):
            columns.append(first[at])
            at = later[at]
        good, counts = usable(columns), np.diff(np.append(starts, len(rows)))
        if k in sizes:
            yield [c[good] for c in columns], counts[good]
        label = np.zeros(len(bwt), np.int64)
        label[rows] = np.cumsum(new)
        valid = np.zeros(len(bwt), bool)
        valid[rows] = np.repeat(good, counts)


def _count_words(batches):
    for batch in batches:
        for lang, words, bwt in zip(*[batch.column(n) for n in ("lang", "words", "bwt")]):
            words = words.values
            counts = np.bincount(np.frombuffer(bwt.as_buffer(), "<i4"), minlength=len(words) + 1)[1:]
            yield _phrases(lang.as_py(), words, [np.arange(1, len(words) + 1)], counts)


def _screened(batches, screens):
    """(language, words, keys of phrases by their columns, BWT, which phrases may be frequent)
    of each shard. ``screens`` has a bitmap for phrases of one word, of two and so on."""
    for batch in batches:
        for lang, words, bwt in zip(*[batch.column(n) for n in ("lang", "words", "bwt")]):
            lang, words = lang.as_py(), words.values
            of_word = np.concatenate([[np.uint64(0)], _hashes(lang, words.to_pylist())])

            def key(columns, of_word=of_word):
                found = of_word[columns[-1]]
                for column in columns[-2::-1]:
                    found = _pair(of_word[column], found)
                return found

            def usable(columns, key=key):
                return _known(screens[len(columns) - 1], key(columns)) if len(columns) <= len(screens) else np.ones(len(columns[0]), bool)

            yield lang, words, key, np.frombuffer(bwt.as_buffer(), "<i4").astype(np.int64), usable


def _count_keys(screens, size: int):
    """mapInArrow body: (key, count) of the phrases of ``size`` words whose parts may be frequent."""

    def body(batches):
        for _, _, key, bwt, usable in _screened(batches, [bits.value for bits in screens]):
            for columns, counts in extend(bwt, usable, (size,)):
                for a in range(0, len(counts), 1 << 18):
                    at = slice(a, a + (1 << 18))
                    yield _keyed(key([c[at] for c in columns]), counts[at].astype(np.int32))

    return body


def _count_phrases(screens, sizes):
    """mapInArrow body: the phrases of ``sizes`` words that may be frequent, each once a task
    with the sum over its shards, as far as memory allows."""

    def summed(held):
        table = pa.concat_tables(held).group_by(["lang", "phrase", "size"]).aggregate([("f", "sum")])
        return table.select(["lang", "phrase", "size", "f_sum"]).rename_columns(COUNTS.names).cast(COUNTS)

    def body(batches):
        held, n = [], 0
        for lang, words, _, bwt, usable in _screened(batches, [bits.value for bits in screens]):
            for columns, counts in extend(bwt, usable, sizes):
                held.append(pa.Table.from_batches([_phrases(lang, words, columns, counts)]))
                n += len(counts)
                if n > HELD_PHRASES:
                    held, n = [summed(held)], 0
                    if held[0].num_rows > MOST_PHRASES:
                        yield from held.pop().to_batches(max_chunksize=1 << 16)
        if held:
            yield from summed(held).to_batches(max_chunksize=1 << 16)
        del held
        give_back()

    return body


def frequent_phrases(docs: DataFrame, least: int, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): ``lang, phrase, size, f`` of every phrase of one to ``depth`` words
    (five at most) that occurs at least ``least`` times in its language, and ``lang, n``, the
    words of each language."""
    spark = docs.sparkSession
    index = build_index(docs)
    total = lambda rows: written(
        rows.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).filter(F.col("f") >= least), "phrases"
    )
    shards = index.select("lang", "words", "bwt")
    words = total(shards.mapInArrow(_count_words, COUNTS_DDL))
    screens = [spark.sparkContext.broadcast(_bitmap(words.mapInArrow(_word_keys, "key int")))]
    # Pairs and triples are summed by half of their hash: what this finds too many, the exact
    # sums drop.
    for size in range(2, min(depth, SCREENED) + 1):
        sums = shards.mapInArrow(_count_keys(screens, size), "key int, f int").groupBy("key").agg(F.sum("f").alias("f"))
        keys = written(sums.filter(F.col("f") >= least).select("key"), "phrase-keys")
        screens.append(spark.sparkContext.broadcast(_bitmap(keys)))
    found = words.unionByName(total(shards.mapInArrow(_count_phrases(screens, range(2, depth + 1)), COUNTS_DDL)))
    return found, index.groupBy("lang").agg(F.sum("n_words").alias("n"))


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, depth: int = DEPTH) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of
    ``docs(lang, text)``.

    Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces at
    blanks and tabs into words; a NULL text is empty and a NULL language ``und``. Repeated
    rows count each time, documents need no id, other columns are ignored. A phrase of two to
    ``depth`` words with a = f(phrase) >= ``least`` scores floor(1000 a n / (l r)) at its worst
    cut into l = f(first part) and r = f(rest), the earliest of equal ones. It is left out if
    one more word to its left or right gives a phrase as frequent, and so lies in every
    longer one as frequent. Ties in score go by a, then by phrase.
    """
    found, totals = frequent_phrases(docs, least, depth)
    words = F.split("phrase", " ")
    extended = found.filter("size > 2").select(
        "lang", F.explode(F.array(F.slice(words, F.lit(1), F.col("size") - 1), F.slice(words, 2, 4))).alias("part"), F.col("f").alias("extension")
    ).groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("extension").alias("extension"))
    closed = found.filter("size > 1").join(extended, ["lang", "phrase"], "left").filter("extension IS NULL OR extension < f")
    cuts = closed.select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.lit(depth)), " ").alias("rest"),
    )
    part = lambda name, f: found.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    judged = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    exact = lambda name: F.col(name).cast("decimal(19,0)")
    judged = judged.withColumn("over", (F.lit(1000).cast("decimal(4,0)") * exact("a")).cast("decimal(22,0)")).withColumn(
        "over", (F.col("over") * F.col("n").cast("decimal(16,0)")).cast("decimal(38,0)")
    ).withColumn("under", (exact("l") * exact("r")).cast("decimal(38,0)")).withColumn("score", F.expr("CAST(over DIV under AS bigint)"))
    worst = judged.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = worst.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
