"""Column builders for the text that stands for an event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME, DESCRIPTION, CATEGORY = "product.name", "product.description", "product.category"
QUERY, KIND = "search_query", "event_type"


def strip(text: Column) -> Column:
    """Drop white space of every kind at both ends (``trim`` alone removes spaces only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _present(fields: tuple[str, ...]) -> Column:
    """The non-empty fields, in order, one space apart."""
    return F.concat_ws(" ", *[F.nullif(F.col(f), F.lit("")) for f in fields])


def _or_event_name(text: Column) -> Column:
    fallback = F.concat(F.lit("event_"), F.coalesce(F.col("event_id"), F.lit("unknown")))
    return F.when(text == "", fallback).otherwise(text)


def stream_text() -> Column:
    """NULLs are skipped, empty strings keep their separator."""
    return F.concat_ws(" ", KIND, NAME, DESCRIPTION, CATEGORY, QUERY)


def partition_text() -> Column:
    """Four fields with NULL as '', single separators, outer white space removed."""
    parts = [F.coalesce(F.col(f), F.lit("")) for f in (KIND, NAME, DESCRIPTION, CATEGORY)]
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit(" "), part)
    return strip(joined)


def pipeline_text() -> Column:
    return _or_event_name(_present((NAME, DESCRIPTION, CATEGORY, QUERY, KIND)))


def task_text() -> Column:
    return _or_event_name(_present((DESCRIPTION, NAME, CATEGORY, QUERY, KIND)))


def labelled_text() -> Column:
    return F.concat_ws(
        " ",
        F.nullif(F.col(DESCRIPTION), F.lit("")),
        F.concat(F.lit("Product: "), F.coalesce(F.col(NAME), F.lit(""))),
        F.concat(F.lit("Category: "), F.coalesce(F.col(CATEGORY), F.lit(""))),
    )


TEXT_PRESETS = {
    "stream": stream_text,
    "partition": partition_text,
    "pipeline": pipeline_text,
    "task": task_text,
    "labelled": labelled_text,
}


def stable_id(id: Column, payload: Column) -> Column:
    """The id as text; a NULL or empty one becomes the hash of the payload, so rows
    without an id stay apart and a replay finds the same id again."""
    return F.coalesce(F.nullif(id.cast("string"), F.lit("")), F.sha2(F.to_json(payload), 256))
