"""Similarity search and vector checks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.search import block_search, unit_rows
from eddyline.functions.vectors import has_width
from eddyline.session import fresh_folder, remove_folder

QUERY_BLOCK_BYTES = 64 * 1024 * 1024


def split_missing(points: DataFrame, vector: str = "vector") -> tuple[DataFrame, DataFrame]:
    """(rows with a vector, rows without). One bad row does not cost the others."""
    return points.filter(F.col(vector).isNotNull()), points.filter(F.col(vector).isNull())


def _query_matrix(rows, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, unit vectors) of an Arrow table of queries."""
    cells = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = cells.astype(np.float64).reshape(rows.num_rows, width)
    return rows.column("id").to_numpy(), unit_rows(vectors)


def _best_of_block(corpus: DataFrame, rows, k: int, width: int, schema: str) -> DataFrame:
    ids, units = _query_matrix(rows, width)
    string_ids = corpus.dtypes[0][1] == "string"
    candidates = corpus.mapInArrow(block_search(ids, units, k, string_ids), schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return candidates.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def cosine_top_k(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    width: int = 384,
    block_bytes: int = QUERY_BLOCK_BYTES,
) -> DataFrame:
    """The k most similar corpus rows (query_id, id, score, rank) of each query.

    Both frames are (id, vector); ids are BIGINT or STRING, those of queries unique. A
    block of queries (64 MB) travels to the executors with the task; each task
    multiplies it with the Arrow batches of its corpus split and emits k rows per query,
    so the shuffle carries candidates only and never a pair per corpus row. Scores tie at
    nine digits, then the lower id wins.

    Queries beyond one block are written to the shared folder in blocks of that size.
    Each is fetched, searched and its result written before the next one, so the
    driver holds one block however many queries there are. The search is exact, and so
    reads the corpus once per block.

    A query whose vector has another width, or a cell that is no finite number, gets one
    row with NULL id, score and rank. Such corpus rows are not compared with anything
    (``split_by_width`` has them).
    """
    fit = has_width(F.col("vector"), width)
    corpus = corpus.select("id", "vector").filter(fit)
    everything = queries.select("id", "vector")
    queries = everything.filter(fit)
    refused = everything.filter(~fit).select(
        F.col("id").alias("query_id"), F.lit(None).cast(corpus.dtypes[0][1]).alias("id"),
        F.lit(None).cast("double").alias("score"), F.lit(None).cast("int").alias("rank"),
    )
    return _searched(queries, corpus, k, width, block_bytes).unionByName(refused)


def _searched(queries: DataFrame, corpus: DataFrame, k: int, width: int, block_bytes: int) -> DataFrame:
    schema = f"query_id {queries.dtypes[0][1]}, id {corpus.dtypes[0][1]}, score double"
    per_block = max(1, block_bytes // (width * 8))
    rows = queries.limit(per_block + 1).toArrow()
    if rows.num_rows == 0:
        return corpus.sparkSession.createDataFrame([], f"{schema}, rank int")
    if rows.num_rows <= per_block:
        return _best_of_block(corpus, rows, k, width, schema)
    spark = corpus.sparkSession
    n_blocks = -(-queries.count() // per_block)
    # Row numbers of a split follow each other, so blocks are even whatever the ids.
    placed, folder = fresh_folder(spark, "query-blocks"), fresh_folder(spark, "top-k")
    number = F.pmod(F.monotonically_increasing_id(), F.lit(n_blocks)).cast("int")
    queries.withColumn("block", number).write.partitionBy("block").parquet(placed)
    blocks = spark.read.parquet(placed)
    for block in range(n_blocks):
        rows = blocks.filter(F.col("block") == block).select("id", "vector").toArrow()
        if rows.num_rows:
            _best_of_block(corpus, rows, k, width, schema).write.mode("append").parquet(folder)
    remove_folder(spark, placed)
    return spark.read.schema(f"{schema}, rank int").parquet(folder)


def search_similar(points: DataFrame, vector: list[float], limit: int = 5) -> DataFrame:
    """The ``limit`` points nearest to one given vector, best first."""
    query = points.sparkSession.createDataFrame([(0, vector)], "id bigint, vector array<double>")
    found = cosine_top_k(query, points, limit, len(vector))
    return found.select("id", "score").orderBy(F.desc("score"), F.asc("id"))
