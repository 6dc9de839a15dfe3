"""JSON output."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_json(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    compression: str | None = None,
    max_records_per_file: int | None = None,
) -> None:
    """The file cap is a writer option, so no counting pass comes before the write."""
    writer = df.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.json(path)
