"""The event pipeline as a stream: raw records in, points and dead letters out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eddyline.functions.vectors import has_width, stored_hash_vector
from eddyline.operators.deadletters import dead_letter_rows
from eddyline.operators.encoder import encode_texts
from eddyline.operators.events import decode_events, event_texts, split_malformed
from eddyline.schemas import EVENT, VECTOR_WIDTH
from eddyline.session import fresh_folder, remove_folder
from eddyline.sinks.epoch_log import write_epoch
from eddyline.sinks.points import upsert_points


def start(
    df: DataFrame, write, checkpoint: str, mode: str = "append", name: str | None = None,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """Run ``write(batch, epoch)`` per micro-batch. ``every=None`` drains what is there and
    stops. An error in ``write`` fails the query, so its offsets are not committed."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def start_point_stream(
    raw: DataFrame,
    points_path: str,
    letters_path: str,
    checkpoint: str,
    text: Column | None = None,
    vector=stored_hash_vector,
    encoder=None,
    width: int = VECTOR_WIDTH,
    generation: int = 0,
    processed_at: Column | None = None,
    constants: dict | None = None,
    **options,
) -> StreamingQuery:
    """Parse, build text and vector, upsert. ``vector`` makes vectors as a column;
    ``encoder``, a factory for ``encode_texts``, replaces it where a model is needed.

    Every record of an epoch becomes a point or a dead letter, but for events that have no
    text at all: malformed records (``validation_error``), failures of the encoder
    (``embedding_error``) and vectors that do not fit (``validation_error``) are letters.
    A replayed epoch overwrites both outputs. ``processed_at`` and ``constants``, such as a
    model's name, are stored in the payload, and so is the epoch wherever one of them is.
    """
    stamps = dict(constants or {})

    def write(batch: DataFrame, epoch: int) -> None:
        staged = fresh_folder(batch.sparkSession, "staged-epoch")
        # Written once, so that neither the source, nor the parser, nor a model runs again
        # for the second output; nothing is held on executor disks.
        added = {"epoch": epoch, **stamps} if stamps or processed_at is not None else {}
        _outcomes(batch, text, vector, encoder, width, processed_at, added).write.parquet(staged)
        rows = batch.sparkSession.read.parquet(staged)
        points = rows.filter("reason IS NULL").select("id", "vector", "payload", "offset")
        upsert_points(points, points_path, epoch, generation)
        letters = dead_letter_rows(
            rows.filter("reason IS NOT NULL"), key="message_key", value="message_value",
            reason=F.col("reason"), error=F.col("error"), failed_at=F.col("kafka_timestamp"),
        )
        write_epoch(letters, letters_path, epoch, generation)
        remove_folder(batch.sparkSession, staged)

    return start(raw, write, checkpoint, **options)


COORDINATES = ("topic", "partition", "offset", "kafka_timestamp", "message_key", "message_value")


def _outcomes(batch: DataFrame, text, vector, encoder, width: int, processed_at, added: dict) -> DataFrame:
    """A row per record: a point, or with ``reason`` and ``error`` what goes to the letters."""
    good, bad = split_malformed(decode_events(batch))
    events = good.select(*COORDINATES, *[F.col(f"parsed.{n}").alias(n) for n in EVENT.names])
    texts = event_texts(events, text, processed_at, COORDINATES, **added)
    if encoder is None:
        made = texts.withColumn("vector", vector(F.col("payload.text"), width).cast("array<float>"))
        made = made.withColumn("encode_error", F.lit(None).cast("string"))
    else:
        made = encode_texts(texts.withColumn("text", F.col("payload.text")), "text", encoder, width).drop("text")
    failed, fits = F.col("encode_error").isNotNull(), has_width(F.col("vector"), width)
    judged = made.withColumn(
        "reason", F.when(failed, F.lit("embedding_error")).when(~fits, F.lit("validation_error"))
    ).withColumn("error", F.coalesce("encode_error", F.when(~fits, F.lit(f"not a vector of {width} finite cells"))))
    broken = bad.select(*COORDINATES).withColumn("reason", F.lit("validation_error")).withColumn("error", F.lit("malformed JSON"))
    return judged.drop("encode_error").unionByName(broken, allowMissingColumns=True)
