"""Text vectors from term weights: TF-IDF, then truncated SVD, then unit length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.functions.blocks import Directions, merge_sketches, project, sketch_rows
from eddyline.functions.terms import all_terms, count_terms, frequent_terms, weigh
from eddyline.schemas import VECTOR_WIDTH
from eddyline.session import cut_lineage

# Fixed value: tokens are runs of at least two letters, digits or underscores.
BETWEEN_TOKENS = r"[^\p{L}\p{N}_]+"
MAX_FEATURES = 10_000
SUMMARY_TERMS = 1 << 17
MOST_SUMMARY_TERMS = 1 << 17  # larger ones would not fit beside each other on an executor
SPARE_DIRECTIONS = 128
SKETCH_TASKS = 256
FAN_IN = 4


def english_stop_words() -> list[str]:
    """Spark's English list (needs a running session)."""
    return StopWordsRemover.loadDefaultStopWords("english")


def _words(docs: DataFrame, text: str, *columns) -> DataFrame:
    """Tokens of each text, stop words and single letters included."""
    return docs.select(*columns, F.coalesce(F.split(F.lower(F.col(text)), BETWEEN_TOKENS), F.array().cast("array<string>")).alias("words"))


def vocabulary(docs: DataFrame, text: str, stop_words: list[str], max_features: int) -> list[tuple[str, int, int]]:
    """(term, tf, df) of the ``max_features`` terms with the highest corpus count, by count
    and then by term.

    Tasks keep Misra-Gries summaries, so what they shuffle does not grow with the texts.
    A term that the sum of the summaries misses has at most as many occurrences as they
    took off. Where the last term wanted has more, all terms that may be wanted are counted
    exactly in a second pass; otherwise the summaries are made anew, larger ones, up to
    ``MOST_SUMMARY_TERMS``. Where nothing was taken off they are exact already. Terms so even
    that summaries of that size cannot tell them apart are counted by one aggregation over
    all terms, which Spark spills.
    """
    words = _words(docs, text)
    order = [F.desc("tf"), F.asc("term")]
    size = max(SUMMARY_TERMS, 4 * max_features)
    while size <= MOST_SUMMARY_TERMS:
        summaries = cut_lineage(words.mapInArrow(frequent_terms(stop_words, size), "term string, tf bigint, df bigint"))
        off = summaries.filter("term IS NULL").agg(F.sum("tf")).first()[0] or 0
        counts = summaries.filter("term IS NOT NULL").groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
        if off == 0:
            return [tuple(r) for r in counts.orderBy(*order).limit(max_features).collect()]
        best = counts.orderBy(*order).limit(max_features).agg(F.min("tf"), F.count("*")).first()
        least = best[0] if best[1] == max_features else 0
        if off < least:
            return _recounted(words, counts.filter(F.col("tf") + off >= least).select("term"), stop_words, max_features)
        size *= 4
    everything = words.mapInArrow(all_terms(stop_words, SUMMARY_TERMS), "term string, tf bigint, df bigint")
    exact = everything.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    return [tuple(r) for r in exact.orderBy(*order).limit(max_features).collect()]


def _recounted(words: DataFrame, candidates: DataFrame, stop_words: list[str], max_features: int) -> list[tuple[str, int, int]]:
    # Each candidate's count is at least the last wanted one less what was taken off, so
    # there are no more than occurrences / that; a summary's size bounds them too.
    terms = pa.array([r.term for r in candidates.collect()], pa.string())
    counted = words.mapInArrow(count_terms(stop_words, terms), "slot int, tf bigint, df bigint").groupBy("slot").agg(F.sum("tf"), F.sum("df"))
    rows = [(terms[slot].as_py(), tf, df) for slot, tf, df in counted.collect()]
    return sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:max_features]


class TermWeights:
    """A fitted vocabulary with its inverse document frequencies.

    Holds at most ``max_features`` terms, which is what travels to the executors.
    """

    def __init__(self, terms: list[str], idf: np.ndarray, stop_words: list[str]):
        self.terms, self.idf, self.stop_words = terms, idf, stop_words

    @classmethod
    def fit(cls, docs: DataFrame, text: str, stop_words=None, max_features: int = MAX_FEATURES):
        stop_words = list(english_stop_words() if stop_words is None else stop_words)
        rows = vocabulary(docs, text, stop_words, max_features)
        df = np.array([r[2] for r in rows], dtype=np.float64)
        n = docs.count()
        return cls([r[0] for r in rows], np.log((1.0 + n) / (1.0 + df)) + 1.0, stop_words)

    def vectors(self, docs: DataFrame, id_column: str, text: str) -> DataFrame:
        """``id, slots, tf, values``: a document's terms by number, their counts and the
        unit-length weights. Narrow: no shuffle."""
        kind = dict(docs.dtypes)[id_column]
        words = _words(docs, text, F.col(id_column).alias("id"))
        body = weigh(self.stop_words, pa.array(self.terms, pa.string()), self.idf)
        return words.mapInArrow(body, f"id {kind}, slots array<int>, tf array<bigint>, values array<double>")


def term_weights(docs: DataFrame, id_column: str, text: str, **fit) -> DataFrame:
    """(id, term, tf, weight) for the vocabulary terms of each document."""
    model = TermWeights.fit(docs, text, **fit)
    spark = docs.sparkSession
    names = spark.createDataFrame(list(enumerate(model.terms)), "slot int, term string")
    entries = model.vectors(docs, id_column, text).select(
        F.col("id").alias(id_column), F.explode(F.arrays_zip(F.col("slots").alias("slot"), F.col("tf"), F.col("values").alias("weight"))).alias("e")
    ).select(id_column, "e.*")
    # The names table has at most max_features rows.
    return entries.join(F.broadcast(names), "slot").select(id_column, "term", "tf", "weight")


def principal_directions(rows: DataFrame, features: int, components: int) -> np.ndarray:
    """The leading right singular vectors (features x components) of the row matrix.

    One pass: each task keeps a Frequent Directions sketch of ``components`` +
    ``SPARE_DIRECTIONS`` rows, and sketches are merged ``FAN_IN`` at a time. At most
    ``SKETCH_TASKS`` tasks read the rows, several splits each, so what is shuffled does not
    grow with the number of splits. The subspace found leaves at most
    1 + components / SPARE_DIRECTIONS times what the best one leaves of the squared lengths.
    """
    size = components + SPARE_DIRECTIONS
    parts = rows.rdd.getNumPartitions()
    if parts > SKETCH_TASKS:
        rows, parts = rows.coalesce(SKETCH_TASKS), SKETCH_TASKS
    schema = "node int, cells array<float>"
    sketches = rows.mapInArrow(sketch_rows(features, size), schema)
    while parts > 1:
        parts = -(-parts // FAN_IN)
        sketches = sketches.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("int"))
        sketches = sketches.repartition(parts, "node").sortWithinPartitions("node").mapInArrow(merge_sketches(features, size), schema)
    whole = Directions(features, size)
    cells = sketches.select("cells").toArrow()["cells"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    whole.put(cells.reshape(-1, features))
    directions = whole.leading(components)
    # Signs are free; make the largest cell of each direction positive.
    top = np.abs(directions).argmax(axis=0)
    return directions * np.where(directions[top, np.arange(components)] < 0, -1.0, 1.0)


def svd_vectors(
    docs: DataFrame, id_column: str, text: str, components: int = VECTOR_WIDTH, **fit
) -> DataFrame:
    """(id, vector): TF-IDF rows projected on their leading directions, unit length.

    Without any term in the corpus every vector is zero. So is that of a document without
    terms, or with none in the directions.
    """
    model = TermWeights.fit(docs, text, **fit)
    if not model.terms:
        return docs.select(F.col(id_column).alias("id"), F.array_repeat(F.lit(0.0), components).alias("vector"))
    rows = cut_lineage(model.vectors(docs, id_column, text).select("id", "slots", "values"))
    directions = principal_directions(rows, len(model.terms), min(components, len(model.terms)))
    return rows.mapInArrow(project(directions), f"id {rows.dtypes[0][1]}, vector array<double>")
