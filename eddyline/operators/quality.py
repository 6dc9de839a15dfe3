"""Cleaning of batch documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from eddyline.schemas import MAX_CONTENT_CHARS, MIN_CONTENT_CHARS


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def has_content() -> Column:
    """Neither NULL nor '' nor a single space (two spaces do count as content)."""
    content = F.col("content")
    return content.isNotNull() & (content != "") & (content != " ")


def has_long_content(min_chars: int = MIN_CONTENT_CHARS) -> Column:
    return has_content() & (F.length("content") > min_chars)


def with_default_id(df: DataFrame) -> DataFrame:
    """``doc_<n>`` where there is no id column: unique, but neither dense nor ordered."""
    if "id" in df.columns:
        return df
    return df.withColumn("id", F.concat(F.lit("doc_"), F.monotonically_increasing_id()))


def with_default_timestamp(df: DataFrame, now: Column | None = None) -> DataFrame:
    if "timestamp" in df.columns:
        return df
    return df.withColumn("timestamp", F.current_timestamp() if now is None else now)


def cap_content(df: DataFrame, max_chars: int = MAX_CONTENT_CHARS) -> DataFrame:
    """The stored-content limit of the data model: the first ``max_chars`` characters."""
    return df.withColumn("content", F.substring("content", 1, max_chars))


def drop_duplicate_content(df: DataFrame, id_column: str = "id") -> DataFrame:
    """Keep the row with the lowest id of each content.

    Whole contents are compared by their SHA-256 and length. Only digests and ids meet in
    the first shuffle, where copies collapse inside each map task; contents that occur
    once pass by the table of those that occur more often. Of rows that share content
    and id one stays. NULL contents are one content.
    """
    digest = F.struct(F.unhex(F.sha2(F.coalesce("content", F.lit("")), 256)).alias("sha"), F.length("content").alias("n"))
    tagged = df.withColumn("_digest", digest)
    repeated = tagged.groupBy("_digest").agg(F.min(id_column).alias("_first"), F.count("*").alias("_copies"))
    repeated = repeated.filter("_copies > 1").drop("_copies")
    single = tagged.join(repeated.select("_digest"), "_digest", "left_anti")
    chosen = tagged.join(repeated, "_digest").filter(F.col(id_column).eqNullSafe(F.col("_first"))).drop("_first")
    return single.unionByName(chosen.dropDuplicates(["_digest"])).select(*df.columns)


def clean_documents(
    df: DataFrame,
    strict: bool = False,
    dedupe: bool = False,
    now: Column | None = None,
    max_chars: int | None = None,
) -> DataFrame:
    """Checks, filter, defaults and, if asked for, duplicate removal and a cap.

    Duplicates are whole contents; ``max_chars`` cuts what is stored, after them, so two
    documents with one beginning stay two.
    """
    require_columns(df, "content")
    kept = df.filter(has_long_content() if strict else has_content())
    kept = with_default_timestamp(with_default_id(kept), now)
    if dedupe:
        kept = drop_duplicate_content(kept)
    return kept if max_chars is None else cap_content(kept, max_chars)


def _counts() -> list[Column]:
    return [
        F.count("*").alias("total_rows"),
        F.count_if(has_content()).alias("standard_rows"),
        F.count_if(has_long_content()).alias("strict_rows"),
        F.count_if(F.length("content") > MAX_CONTENT_CHARS).alias("over_cap_rows"),
    ]


def quality_counts(df: DataFrame) -> DataFrame:
    """Rows before and after each filter, in one pass."""
    return df.agg(*_counts())


def observe_quality(df: DataFrame, observation: Observation) -> DataFrame:
    """The same counts gathered while the rows pass on to whatever is done with them."""
    return df.observe(observation, *_counts())
