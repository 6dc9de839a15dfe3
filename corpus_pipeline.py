"""The training-data pipeline over ``documents``: quality, repeated lines, near
duplicates, benchmark leaks, subword pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm.common import prepare, read_table
from eddyline.session import fresh_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good.

    A NULL text is scored as an empty one; rows without an id are scored too, and no label
    is theirs. Repeated rows share their fate. Without labels of both kinds every document
    has the share of good labels, or 0.5, as its score. Columns beside those of documents go.
    """
    from eddyline.llm.fm_quality import score_quality

    prepare(spark)
    scored = score_quality(docs.select(*COLUMNS), read_table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 1").select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that three or more documents share, but for their keeper.

    A NULL text becomes an empty one, as does one that loses every line; no row goes. Rows of
    one id are one document, and so are all rows without an id, which is below all others.
    ``n_chars`` is counted anew.
    """
    from eddyline.llm.line_dedup import LineIndex

    prepare(spark)
    index = LineIndex(spark, fresh_folder(spark, "line-index"))
    index.insert(docs)
    rest = docs.select("doc_id", "text", "lang", "source")
    return index.dedupe(rest, ("lang", "source")).select(
        "doc_id", "text", "lang", "source", F.length("text").cast("bigint").alias("n_chars")
    )


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the document with the
    smallest id.

    Texts without words, NULL ones too, are one group. Repeated rows of the id that stays all
    stay, and rows without an id stay: what is removed is named by its id.
    """
    from eddyline.llm.near_copies import near_copies

    prepare(spark)
    found = near_copies(docs.select("doc_id", "text"))
    others = found.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    NULL and empty texts hold none; items without words are in no text. All rows of an id go
    if one of them holds an item; rows without an id stay. Without items all stay.
    """
    from eddyline.llm.decontamination import leaks

    prepare(spark)
    found = leaks(docs.select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each text's pieces and of what they decode to, a row for every row.

    NULL texts are empty and have no pieces. Rows of one id and text get the same pieces, as
    do all rows of one text without an id.
    """
    from eddyline.llm.queries import piece_digests

    prepare(spark)
    return piece_digests(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding and decoding", as_pieces),
]

#: Learned scores and subword pieces are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's result written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = fresh_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
