"""A persistent index of content digests, for finding what earlier epochs already held.

Each epoch adds a segment: its digests in buckets, and a Bloom filter per bucket as bitmap
rows. A lookup asks the filters first. Only buckets in which some filter knows some digest
are opened, and digests that no filter knows are not joined with anything.

Layout: ``<path>/epochs/<generation>-<epoch>`` and ``<path>/folded/<generation>-<epoch>``,
each with ``digests/bucket=<n>`` and ``filters``. Filters are written last; a segment
without finished filters does not count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITMAP = 1 << 15  # bits of one of Spark's bitmaps
PER_BLOCK = 1 << 12  # digests in one: 8 bits each
PROBES = 4
PER_BUCKET = 1 << 16
MOST_BUCKETS = 1 << 10


def content_digest(content: Column) -> Column:
    """SHA-256 of the whole content; NULL is a content of its own."""
    kind = F.when(content.isNull(), F.lit("-")).otherwise(F.lit("+"))
    return F.unhex(F.sha2(F.concat(kind, F.coalesce(content, F.lit(""))), 256))


def _size(n: int, each: int, most: int) -> int:
    """How many parts of ``each``: a power of two."""
    return min(most, 1 << max(-(-n // each) - 1, 0).bit_length())


def _block(digest: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(digest), blocks)


def _bits(digest: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(digest, F.lit(k)), F.lit(BITMAP)) for k in range(1, PROBES + 1)])


def _write_segment(digests: DataFrame, folder: str, per_bucket: int) -> None:
    """Blocks are hash classes small enough for one bitmap; a bucket is some blocks."""
    n = digests.count()
    buckets = _size(n, per_bucket, MOST_BUCKETS)
    blocks = max(buckets, _size(n, PER_BLOCK, 1 << 30))
    placed = digests.select("digest", _block(F.col("digest"), F.lit(blocks)).alias("block"))
    placed = placed.withColumn("bucket", F.pmod("block", F.lit(buckets)).cast("int"))
    placed.select("digest", "bucket").repartition("bucket").sortWithinPartitions("bucket", "digest").write.mode("overwrite").partitionBy(
        "bucket"
    ).parquet(f"{folder}/digests")
    bitmaps = placed.select("block", "bucket", F.explode(_bits(F.col("digest"))).alias("bit")).groupBy("block", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits")
    )
    bitmaps.select(
        F.lit(folder).alias("segment"), F.lit(blocks).cast("bigint").alias("blocks"), "block", "bucket", "bits"
    ).write.mode("overwrite").parquet(f"{folder}/filters")


def _finished(spark: SparkSession, top: str) -> dict[tuple[int, int], str]:
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(top).getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    if files.exists(path(top)):
        for status in files.listStatus(path(top)):
            name = status.getPath().getName()
            if files.exists(path(f"{top}/{name}/filters/_SUCCESS")):
                found[tuple(map(int, name.split("-")))] = f"{top}/{name}"
    return found


def segments(spark: SparkSession, path: str) -> dict[tuple[int, int], str]:
    """Finished segments by (generation, epoch): the newest fold, and the epochs after it."""
    folds = _finished(spark, f"{path}/folded")
    upto = max(folds, default=(-1, -1))
    later = {at: folder for at, folder in _finished(spark, f"{path}/epochs").items() if at > upto}
    return ({upto: folds[upto]} if folds else {}) | later


def add_digests(digests: DataFrame, path: str, epoch_id: int, generation: int = 0, per_bucket: int = PER_BUCKET) -> None:
    """Enters the ``digest`` column as one epoch; entering it again replaces it."""
    _write_segment(digests, f"{path}/epochs/{int(generation)}-{int(epoch_id)}", per_bucket)


def suspects(spark: SparkSession, digests: DataFrame, folders: list[str]) -> DataFrame:
    """``digest, segment, bucket``: where the filters of segments know a digest."""
    filters = spark.read.parquet(*[f"{folder}/filters" for folder in folders])
    # One row per digest and segment that it may be in; folding keeps segments few.
    sizes = filters.groupBy("segment").agg(F.max("blocks").alias("blocks")).agg(F.collect_list(F.struct("segment", "blocks"))).scalar()
    asked = digests.select("digest", F.explode(sizes).alias("s")).select(
        "digest", "s.segment", _block(F.col("digest"), F.col("s.blocks")).alias("block")
    )
    byte = lambda b: F.conv(F.hex(F.substring("bits", F.floor(b / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    known = F.forall(_bits(F.col("digest")), lambda b: F.getbit(byte(b), F.pmod(b, F.lit(8)).cast("int")) == 1)
    return asked.join(filters.drop("blocks"), ["segment", "block"]).filter(known).select("digest", "segment", "bucket")


def buckets_to_open(found: DataFrame) -> list[str]:
    """The bucket folders that hold what the filters know. Names, at most ``MOST_BUCKETS``
    for each segment, pass through the driver."""
    return sorted(f"{s}/digests/bucket={b}" for s, b in found.select("segment", "bucket").distinct().collect())


def known_digests(spark: SparkSession, path: str, digests: DataFrame, before: tuple[int, int]) -> DataFrame:
    """The distinct ones of ``digests`` that an epoch before ``before`` has entered."""
    folders = [folder for at, folder in segments(spark, path).items() if at < before]
    asked = digests.select("digest").distinct()
    if not folders:
        return asked.limit(0)
    found = suspects(spark, asked, folders)
    opened = buckets_to_open(found)
    if not opened:
        return asked.limit(0)
    held = spark.read.option("recursiveFileLookup", True).parquet(*opened).select("digest")
    return found.select("digest").distinct().join(held, "digest", "left_semi")


def fold_digests(spark: SparkSession, path: str, keep: int = 1, per_bucket: int = PER_BUCKET) -> int:
    """Makes one segment of all but the newest ``keep``, and deletes those once it is
    finished; returns how many. A restarted query may enter the newest epoch again."""
    found = segments(spark, path)
    done = sorted(found)[: max(len(found) - max(keep, 1), 0)]
    if len(done) < 2:
        return 0
    rows = spark.read.option("recursiveFileLookup", True).parquet(*[f"{found[at]}/digests" for at in done]).select("digest").distinct()
    _write_segment(rows, f"{path}/folded/{done[-1][0]}-{done[-1][1]}", per_bucket)
    for at in done:
        gone = spark._jvm.org.apache.hadoop.fs.Path(found[at])
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return len(done)
