"""Batch documents as a stream of files: every new file is read once, cleaned, turned
into vectors, written as JSON, upserted, and entered in the file ledger.

The query's checkpoint remembers finished files, so a scheduled run drains what is new
(``every=None``) and a crash repeats at most the open epoch, which overwrites itself.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eddyline.functions.text import stable_id
from eddyline.functions.vectors import has_width, stored_hash_vector
from eddyline.operators.deadletters import dead_letter_rows
from eddyline.operators.encoder import encode_texts
from eddyline.operators.quality import clean_documents
from eddyline.schemas import VECTOR_WIDTH
from eddyline.session import fresh_folder, remove_folder
from eddyline.sinks.digest_index import add_digests, content_digest, fold_digests, known_digests
from eddyline.sinks.epoch_log import VERSION, latest_rows, read_log, write_epoch
from eddyline.sinks.json_files import write_json
from eddyline.sinks.points import upsert_points
from eddyline.sources.documents import CORRUPT, unreadable_files
from eddyline.streaming.pipeline import start


def with_file(docs: DataFrame) -> DataFrame:
    """Adds ``file``, the path a row was read from. Apply directly to the file source."""
    return docs.select("*", F.col("_metadata.file_path").alias("file"))


def ledger_rows(docs: DataFrame, seconds: float | None = None) -> DataFrame:
    """One row per file. A file without a row that has the content field is an error, one
    with lines that cannot be decoded besides is partial; ``record_count`` counts the
    decoded rows."""
    has_field, broken = F.count("content") > 0, F.count(CORRUPT)
    status = F.when(~has_field, F.lit("error")).when(broken > 0, F.lit("partial")).otherwise(F.lit("success"))
    error = F.when(broken > 0, F.concat(broken.cast("string"), F.lit(" lines are not JSON"))).when(
        ~has_field, F.lit("missing required columns: content")
    )
    return docs.groupBy("file").agg(
        status.alias("status"),
        F.when(has_field, F.count("*") - broken).otherwise(F.lit(0)).cast("bigint").alias("record_count"),
        F.lit(seconds).cast("double").alias("processing_time"),
        error.alias("error"),
        F.current_timestamp().alias("timestamp"),
    )


def error_entries(broken: DataFrame, seconds: float) -> DataFrame:
    """Ledger entries of ``broken(file, error)``: files that could not be read."""
    return broken.select(
        "file", F.lit("error").alias("status"), F.lit(0).cast("bigint").alias("record_count"), F.lit(seconds).cast("double").alias("processing_time"),
        "error", F.current_timestamp().alias("timestamp"),
    )


def corrupt_letters(docs: DataFrame) -> DataFrame:
    """Lines that cannot be decoded, as dead letters of their file."""
    lines = docs.filter(F.col(CORRUPT).isNotNull()).select(
        F.col("file").alias("topic"), F.lit(None).cast("int").alias("partition"), F.lit(None).cast("bigint").alias("offset"),
        F.col("file").alias("key"), F.col(CORRUPT).alias("value"),
    )
    return dead_letter_rows(lines, F.lit("parse_error"), F.lit("malformed JSON"), F.current_timestamp())


def document_points(
    cleaned: DataFrame, vector=stored_hash_vector, width: int = VECTOR_WIDTH, encoder=None
) -> DataFrame:
    """Points, with ``encode_error`` where an encoder failed. A document without an id is
    known by its content and file, whenever it is read."""
    known = cleaned.withColumn("id", stable_id(F.col("id"), F.struct("content", "file")))
    if encoder is None:
        made = known.withColumn("vector", vector(F.col("content"), width)).withColumn("encode_error", F.lit(None).cast("string"))
    else:
        made = encode_texts(known, "content", encoder, width)
    return made.select(
        "id", "vector", F.struct("content", "timestamp", "file", F.lit("spark_batch").alias("source")).alias("payload"),
        F.monotonically_increasing_id().alias("offset"), "encode_error",
    )


def start_document_stream(
    docs: DataFrame,
    points_path: str,
    json_path: str,
    ledger_path: str,
    checkpoint: str,
    strict: bool = False,
    dedupe: bool = False,
    vector=stored_hash_vector,
    width: int = VECTOR_WIDTH,
    now: Column | None = None,
    generation: int = 0,
    encoder=None,
    letters_path: str | None = None,
    digests_path: str | None = None,
    fold_every: int = 16,
    **options,
) -> StreamingQuery:
    """``docs`` comes from ``with_file(stream_documents(...))``.

    Lines that cannot be decoded, and documents an encoder fails on or whose vector does
    not fit, become dead letters (``letters_path``, beside the ledger by default).
    ``dedupe`` keeps the first document of each whole content: of one epoch the lowest id,
    and none whose content an earlier epoch had (a digest index at ``digests_path``, beside
    the ledger by default, folded every ``fold_every`` epochs). So which contents are stored
    does not depend on how files fall into epochs.

    A packed file that breaks off does not stop the others: it gets an ``error`` entry with
    what is wrong, and none of its rows are taken. One that gives no row at all is found when
    the ledger is read together with the list of files.
    """
    letters_path = letters_path or f"{ledger_path}-letters"
    digests_path = digests_path or f"{ledger_path}-digests"

    def unseen(cleaned: DataFrame, epoch: int) -> DataFrame:
        spark, tagged = cleaned.sparkSession, fresh_folder(cleaned.sparkSession, "tagged-epoch")
        # First, as the rows below are read from the index until they are stored.
        if epoch and epoch % fold_every == 0:
            fold_digests(spark, digests_path)
        cleaned.withColumn("digest", content_digest(F.col("content"))).write.parquet(tagged)
        rows = spark.read.parquet(tagged)
        known = known_digests(spark, digests_path, rows, (generation, epoch))
        fresh = rows.join(known, "digest", "left_anti")
        add_digests(fresh.select("digest"), digests_path, epoch, generation)
        return fresh.drop("digest")

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        packed = batch.select("file").filter(F.col("file").rlike(r"\.(gz|deflate|bz2)$")).distinct()
        names = [r.file for r in packed.collect()]  # of one epoch
        if not names:
            store(batch, epoch, None)
            return
        found = fresh_folder(spark, "broken-files")
        unreadable_files(spark, names).write.parquet(found)
        broken = spark.read.parquet(found)
        store(batch.join(broken.select("file"), "file", "left_anti").select(*batch.columns), epoch, broken)
        remove_folder(spark, found)

    def store(batch: DataFrame, epoch: int, broken: DataFrame | None) -> None:
        began = time.monotonic()
        spark, staged = batch.sparkSession, fresh_folder(batch.sparkSession, "staged-epoch")
        stamped = batch.filter(F.col(CORRUPT).isNull()).withColumn("timestamp", F.coalesce("timestamp", _iso(now)))
        cleaned = clean_documents(stamped, strict, dedupe)
        drafted = document_points(unseen(cleaned, epoch) if dedupe else cleaned, vector, width, encoder)
        # Judged once, cell by cell; the outputs below ask for the verdict, and the letters read
        # no vector of a document that fits.
        drafted.withColumn("fits", F.col("encode_error").isNull() & has_width(F.col("vector"), width)).write.parquet(staged)
        made = spark.read.parquet(staged)
        points = made.filter("fits").drop("encode_error", "fits")
        folder = f"{json_path}/generation={generation}/epoch_id={epoch}"
        write_json(points.select("id", "vector", "payload"), folder, compression="gzip")
        upsert_points(points, points_path, epoch, generation)
        failed = made.filter("NOT fits").select(
            F.col("payload.file").alias("topic"), F.lit(None).cast("int").alias("partition"), "offset",
            F.col("id").alias("key"), F.to_json("payload").alias("value"),
            F.when(F.col("encode_error").isNotNull(), F.lit("embedding_error")).otherwise(F.lit("validation_error")).alias("reason"),
            F.coalesce("encode_error", F.lit(f"not a vector of {width} finite cells")).alias("error"),
        )
        refused = dead_letter_rows(failed, F.col("reason"), F.col("error"), F.current_timestamp())
        write_epoch(corrupt_letters(batch).unionByName(refused), letters_path, epoch, generation)
        entries, seconds = ledger_rows(batch, time.monotonic() - began), time.monotonic() - began
        if broken is not None:
            entries = entries.unionByName(error_entries(broken, seconds))
        write_epoch(entries, ledger_path, epoch, generation)
        remove_folder(spark, staged)

    return start(docs, write, checkpoint, **options)


def _iso(now: Column | None) -> Column:
    return F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def read_ledger(spark, path: str, files: DataFrame | None = None) -> DataFrame:
    """The newest entry per file. Of the given ``files`` those that yielded no row at all are
    added as ``empty``, or as ``error`` where they cannot be unpacked."""
    entries = latest_rows(read_log(spark, path), ["file"], list(VERSION)).drop(*VERSION)
    if files is None:
        return entries
    silent = files.select(F.col("path").alias("file")).join(entries.select("file"), "file", "left_anti")
    packed = [r.file for r in silent.filter(F.col("file").rlike(r"\.(gz|deflate|bz2)$")).collect()]
    broken = unreadable_files(spark, packed)
    status = F.when(F.col("error").isNotNull(), F.lit("error")).otherwise(F.lit("empty"))
    others = silent.join(broken, "file", "left").select("file", status.alias("status"), F.lit(0).cast("bigint").alias("record_count"), "error")
    return entries.unionByName(others, allowMissingColumns=True)
