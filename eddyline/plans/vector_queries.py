"""Queries over vectors and the points table."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from eddyline.functions.vectors import has_width, l2_normalize
from eddyline.operators.events import events_to_points
from eddyline.operators.pivot_search import PivotIndex
from eddyline.operators.vectors import cosine_top_k, search_similar, split_missing
from eddyline.plans import tables
from eddyline.plans.catalog import hash_vector_columns, query, rounded
from eddyline.plans.event_queries import STREAM_SQL
from eddyline.plans.tables import hash_vector_sql, with_sql
from eddyline.session import fresh_folder
from eddyline.sinks.points import compact, read_points, upsert_points, with_payload, with_point_ids


@query("l2_normalize", """
WITH u AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS len FROM u)
SELECT vec_id, CAST(unnest(range(len(v))) AS INTEGER) AS position,
  round(unnest(CASE WHEN len = 0 THEN v ELSE list_transform(v, lambda x: x / len) END), 6) AS x FROM n""")
def normalized(spark, sf_dir):
    vectors = tables.vectors(spark, sf_dir)
    cells = vectors.select(
        F.col("id").alias("vec_id"), F.posexplode(l2_normalize(F.col("vector"))).alias("position", "x")
    )
    return cells.select("vec_id", "position", rounded("x"))


def _mean_vector():
    mean = Summarizer.mean(array_to_vector(F.col("vector").cast("array<double>")))
    return vector_to_array(mean).alias("vector")


_MEANS = """
WITH cells AS (
  SELECT label, unnest(range(len(embedding))) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings),
means AS (SELECT label, i, avg(x) AS x FROM cells GROUP BY label, i),
queries AS (SELECT label, list(x ORDER BY i) AS v FROM means GROUP BY label)"""


TOPK_SQL = _MEANS + """
SELECT query_id, id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
    SELECT q.label AS query_id, c.vec_id AS id,
      round(list_cosine_similarity(q.v, CAST(c.embedding AS DOUBLE[])), 9) AS score
    FROM queries q, embeddings c)) WHERE rank <= 5"""


@query("cosine_topk", TOPK_SQL)
def cosine_topk(spark, sf_dir):
    """The vectors nearest to the mean vector of each label."""
    corpus = tables.vectors(spark, sf_dir)
    means = corpus.groupBy(F.col("label").alias("id")).agg(_mean_vector())
    found = cosine_top_k(means, corpus, k=5, width=64)
    return found.select("query_id", "id", rounded("score"), "rank")


@query("cosine_topk_pruned", TOPK_SQL)
def cosine_topk_pruned(spark, sf_dir):
    """The same by cells around pivots; means and corpus stay on the executors."""
    corpus = tables.vectors(spark, sf_dir)
    means = corpus.groupBy(F.col("label").alias("id")).agg(_mean_vector())
    found = PivotIndex.build(corpus, width=64).search(means, k=5)
    return found.select("query_id", "id", rounded("score"), "rank")


@query("search_similar", _MEANS.replace("label, ", "0 AS label, ", 1) + """
SELECT c.vec_id AS id, round(list_cosine_similarity(q.v, CAST(c.embedding AS DOUBLE[])), 6) AS score
FROM queries q, embeddings c
ORDER BY round(list_cosine_similarity(q.v, CAST(c.embedding AS DOUBLE[])), 9) DESC, c.vec_id LIMIT 5""")
def search_one(spark, sf_dir):
    """The default five results for one vector, the mean of all."""
    corpus = tables.vectors(spark, sf_dir)
    mean = corpus.agg(_mean_vector()).first().vector
    return search_similar(corpus, mean).select("id", rounded("score"))


@query("vector_split", """
SELECT vec_id, vec_id % 20 <> 0 AS has_vector,
  CASE WHEN vec_id % 20 = 0 THEN 'embedding_error' END AS reason FROM embeddings""")
def vector_split(spark, sf_dir):
    """Every twentieth vector is taken away; those rows go to the dead letters."""
    points = tables.vectors(spark, sf_dir).withColumn(
        "vector", F.when(F.pmod("id", F.lit(20)) != 0, F.col("vector"))
    )
    good, bad = split_missing(points)
    return good.select(
        F.col("id").alias("vec_id"), F.lit(True).alias("has_vector"), F.lit(None).cast("string").alias("reason")
    ).unionByName(bad.select(
        F.col("id").alias("vec_id"), F.lit(False).alias("has_vector"), F.lit("embedding_error").alias("reason")
    ))


@query("vector_width_check", """
SELECT vec_id, CASE WHEN vec_id % 25 = 0 THEN 63 ELSE 64 END AS width, vec_id % 25 <> 0 AS fits FROM embeddings""")
def vector_width_check(spark, sf_dir):
    """Every 25th vector loses a cell."""
    points = tables.vectors(spark, sf_dir).withColumn(
        "vector", F.when(F.pmod("id", F.lit(25)) == 0, F.slice("vector", 1, 63)).otherwise(F.col("vector"))
    )
    return points.select(
        F.col("id").alias("vec_id"), F.size("vector").alias("width"), has_width(F.col("vector"), 64).alias("fits")
    )


def _two_epochs(spark, sf_dir, path: str) -> None:
    """All events, then the purchases again with another text."""
    events = tables.events(spark, sf_dir)
    first = events_to_points(events, carry=("eid",)).withColumnRenamed("eid", "offset")
    upsert_points(first, path, epoch_id=0)
    again = F.concat(F.lit("updated "), F.coalesce("product.name", F.lit("")))
    later = events_to_points(events.filter("event_type = 'purchase'"), again, carry=("eid",))
    upsert_points(later.withColumnRenamed("eid", "offset"), path, epoch_id=1)


_UPSERT = with_sql("ev", body=f"""
SELECT event_id AS id, epoch_id, text, {hash_vector_sql('text')} FROM (
  SELECT event_id, CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS epoch_id,
    CASE WHEN event_type = 'purchase' THEN 'updated ' || product_name ELSE {STREAM_SQL} END AS text FROM ev)""")


def _shown(points):
    return points.select("id", "epoch_id", "payload.text", *hash_vector_columns())


@query("upsert_points", _UPSERT)
def upserted(spark, sf_dir):
    path = fresh_folder(spark, "points")
    _two_epochs(spark, sf_dir, path)
    return _shown(read_points(spark, path))


@query("upsert_points_compacted", _UPSERT)
def upserted_compacted(spark, sf_dir):
    """The same with the first epoch folded into a base before the second arrives."""
    path = fresh_folder(spark, "points")
    events = tables.events(spark, sf_dir)
    first = events_to_points(events, carry=("eid",)).withColumnRenamed("eid", "offset")
    upsert_points(first, path, epoch_id=0)
    compact(spark, path, keep=0)
    again = F.concat(F.lit("updated "), F.coalesce("product.name", F.lit("")))
    later = events_to_points(events.filter("event_type = 'purchase'"), again, carry=("eid",))
    upsert_points(later.withColumnRenamed("eid", "offset"), path, epoch_id=1)
    return _shown(read_points(spark, path))


@query("point_defaults", """
SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN CAST(vec_id AS VARCHAR)
    ELSE sha2(CASE WHEN vec_id % 3 = 0 THEN '{"label":"' || label || '"}'
      WHEN vec_id % 3 = 1 THEN '{"source":"batch"}' ELSE '{}' END) END AS id,
  CASE WHEN vec_id % 3 = 0 THEN CAST(label AS VARCHAR) END AS label,
  CASE WHEN vec_id % 3 = 1 THEN 'batch' END AS source
FROM embeddings""".replace("sha2(", "sha256("))
def point_defaults(spark, sf_dir):
    """Missing ids and payloads filled in."""
    vec, label = F.col("id"), F.col("label").cast("string")
    points = tables.vectors(spark, sf_dir).select(
        vec.alias("vec_id"), F.when(F.pmod(vec, F.lit(2)) == 0, vec.cast("string")).alias("id"),
        F.when(F.pmod(vec, F.lit(3)) == 0, F.create_map(F.lit("label"), label)).alias("payload"),
        F.when(F.pmod(vec, F.lit(3)) == 1, F.create_map(F.lit("source"), F.lit("batch"))).alias("metadata"),
    )
    filled = with_point_ids(with_payload(points))
    return filled.select(
        "vec_id", "id", F.col("payload")["label"].alias("label"), F.col("payload")["source"].alias("source")
    )
