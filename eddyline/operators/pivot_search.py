"""Exact similarity search that skips what the triangle inequality rules out.

A corpus is laid out once: every row belongs to its nearest pivot and, there, to a ring of
angles around it. Pivot and ring are a cell. A query first searches the cells whose bound is
best until they hold k rows; then only cells that can hold a row as good as its k-th best.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eddyline.functions import pivots as tasks
from eddyline.functions.search import unit_rows
from eddyline.functions.vectors import has_width
from eddyline.session import fresh_folder

PIVOTS = 64
MOST_PIVOTS = 1024
BLOCK_CELLS = 1 << 18  # vector cells in one block of rows


class PivotIndex:
    """A corpus laid out by cells, at a folder. What the driver and the tasks hold is the
    pivots (``MOST_PIVOTS`` at most) and one line per cell that has rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        pivots = spark.read.parquet(f"{path}/pivots").orderBy("place").toArrow()
        self.width = len(pivots["vector"][0]) if pivots.num_rows else 0
        self.pivots = unit_rows(np.array(pivots["vector"].to_pylist(), np.float64).reshape(pivots.num_rows, self.width))
        cells = spark.read.parquet(f"{path}/cells").orderBy("cell").toArrow()
        self.cell_pivot, self.cell_ring, self.rows = (cells[n].to_numpy() for n in ("pivot", "ring", "n"))

    @classmethod
    def build(cls, corpus: DataFrame, path: str | None = None, width: int = 384, pivots: int = PIVOTS) -> PivotIndex:
        """Lays out ``corpus(id, vector)``. Pivots are rows of it, drawn at random; their
        choice decides what can be skipped and never what is found. Rows whose vector does
        not fit are left out."""
        spark = corpus.sparkSession
        path = path or fresh_folder(spark, "pivot-index")
        rows = corpus.select("id", "vector").filter(has_width(F.col("vector"), width))
        wanted = min(pivots, MOST_PIVOTS)
        drawn = rows.filter(F.exists("vector", lambda x: x != 0)).select("vector").withColumn("place", F.xxhash64("vector")).dropDuplicates(["place"])
        drawn.orderBy("place").limit(wanted).write.parquet(f"{path}/pivots")
        units = unit_rows(np.array([r.vector for r in spark.read.parquet(f"{path}/pivots").orderBy("place").collect()], np.float64).reshape(-1, width))
        if not len(units):  # nothing but zero vectors: any direction does
            units = np.eye(1, width)
            spark.createDataFrame([(units[0].tolist(), 0)], "vector array<double>, place bigint").write.mode("overwrite").parquet(f"{path}/pivots")
        kinds = dict(rows.dtypes)
        placed = rows.mapInArrow(tasks.assign(units), f"id {kinds['id']}, vector {kinds['vector']}, pivot int, ring int")
        placed.write.partitionBy("pivot").parquet(f"{path}/placed")
        placed = spark.read.schema(placed.schema).parquet(f"{path}/placed")
        counted = placed.groupBy("pivot", "ring").agg(F.count("*").alias("n")).collect()
        # Cells are numbered on the driver: pivots times rings at most.
        lines = [(number, p, r, n) for number, (p, r, n) in enumerate(sorted(map(tuple, counted)))]
        cells = spark.createDataFrame(lines, "cell int, pivot int, ring int, n bigint")
        cells.coalesce(1).write.parquet(f"{path}/cells")
        numbered = placed.join(F.broadcast(cells.drop("n")), ["pivot", "ring"]).select("cell", "id", "vector")
        blocks = numbered.repartitionByRange("cell", "id").sortWithinPartitions("cell").mapInArrow(
            tasks.pack(max(1, BLOCK_CELLS // width)), f"cell int, ids array<{kinds['id']}>, cells {kinds['vector']}"
        )
        blocks.write.parquet(f"{path}/blocks")
        return cls(spark, path)

    def _met(self, visits: DataFrame, k: int) -> DataFrame:
        """The k best rows per query of the cells that it visits."""
        kinds = dict(visits.dtypes)
        packed = visits.withColumnRenamed("query_id", "id").repartition("cell").sortWithinPartitions("cell").mapInArrow(
            tasks.pack(max(1, BLOCK_CELLS // self.width)), f"cell int, ids array<{kinds['query_id']}>, cells {kinds['vector']}"
        ).select("cell", F.col("ids").alias("query_ids"), F.col("cells").alias("query_cells"))
        blocks = self.spark.read.parquet(f"{self.path}/blocks")
        kind = dict(blocks.dtypes)["ids"][len("array<"):-1]
        found = blocks.join(packed, "cell").mapInArrow(
            tasks.compare(k, kind == "string"), f"query_id {kinds['query_id']}, id {kind}, score double"
        )
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    def _visits(self, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(first cells, the best rows found there, other cells to look into)."""
        kinds = dict(queries.dtypes)
        arguments = (self.pivots, self.cell_pivot, self.cell_ring, self.rows, k)
        schema = f"query_id {kinds['id']}, vector {kinds['vector']}, cell int"
        visits, path = queries.mapInArrow(tasks.first_cells(*arguments), schema), fresh_folder(self.spark, "first-cells")
        self._met(visits, k).write.parquet(path)
        first = self.spark.read.parquet(path)
        least = first.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
        return visits, first, queries.join(least, "id", "left").mapInArrow(tasks.other_cells(*arguments), schema)

    def search(self, queries: DataFrame, k: int = 5) -> DataFrame:
        """``query_id, id, score, rank``: the ``k`` most similar rows of each query.

        ``queries`` is (id, vector) with unique ids. They never pass through the driver, and
        no pair is a row: blocks of queries meet blocks of rows in one product. Scores tie at
        nine digits, then the lower id wins. A query whose vector does not fit gets one row
        with NULL id, score and rank.
        """
        asked = queries.select("id", "vector")
        fit = has_width(F.col("vector"), self.width)
        _, first, rest = self._visits(asked.filter(fit), k)
        both = first.drop("rank").unionByName(self._met(rest, k).drop("rank"))
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
        found = both.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        refused = asked.filter(~fit).select(
            F.col("id").alias("query_id"), F.lit(None).cast(dict(first.dtypes)["id"]).alias("id"),
            F.lit(None).cast("double").alias("score"), F.lit(None).cast("int").alias("rank"),
        )
        return found.unionByName(refused)

    def share_read(self, queries: DataFrame, k: int = 5) -> float:
        """Of all pairs of a query and a row, the share that ``search`` compares."""
        asked = queries.select("id", "vector").filter(has_width(F.col("vector"), self.width))
        visits, _, rest = self._visits(asked, k)
        sizes = self.spark.createDataFrame(list(enumerate(self.rows.tolist())), "cell int, n bigint")
        read = visits.unionByName(rest).join(F.broadcast(sizes), "cell").agg(F.sum("n")).first()[0] or 0
        return read / max(asked.count() * int(self.rows.sum()), 1)
