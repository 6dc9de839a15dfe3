"""Operational metrics over an operation log and over event times."""

from __future__ import annotations
import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.labels import meets_target, resource_class, throughput_class
from eddyline.schemas import HISTOGRAM_EDGES
from eddyline.session import cut_lineage

# Counter name -> (labels, filter on the operation log).
COUNTERS = {
    "messages_consumed": (("topic", "partition"), None),
    "messages_processed": (("topic", "status"), None),
    "messages_failed": (("topic", "error_type"), "error_type IS NOT NULL"),
    "store_operations": (("operation", "collection", "status"), "operation IS NOT NULL"),
    "embeddings": (("model", "status"), "model IS NOT NULL"),
    "errors": (("component", "error_type"), "error_type IS NOT NULL"),
}
ALL_LABELS = (
    "topic", "partition", "status", "error_type", "operation", "collection", "model", "component",
)


def counter_table(op_log: DataFrame) -> DataFrame:
    """(metric, labels, total) of every counter family from one scan of the log.

    The log shrinks to one row per label combination first; only those few rows are
    fanned out to the families and summed again.
    """
    return counter_families(op_log.groupBy(*ALL_LABELS).agg(F.count("*").alias("n")))


def counter_families(combos: DataFrame) -> DataFrame:
    """Counters from counts per label combination."""
    families = []
    for metric, (labels, condition) in COUNTERS.items():
        text = F.concat_ws(
            ",", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in labels]
        )
        entry = F.struct(F.lit(metric).alias("metric"), text.alias("labels"))
        families.append(entry if condition is None else F.when(F.expr(condition), entry))
    return (
        combos.select("n", F.explode(F.array_compact(F.array(*families))).alias("f"))
        .groupBy("f.metric", "f.labels").agg(F.sum("n").alias("total"))
    )


def histogram(df: DataFrame, value: str, by: list[str], edges=HISTOGRAM_EDGES["pipeline"]) -> DataFrame:
    """Cumulative buckets: (by, le, n, total_count, total_sum), the last with le = +Inf.

    All edges are counted side by side in one aggregate per group; the turn to one row
    per edge happens on the aggregated rows.
    """
    v = F.col(value)
    counts = [F.count_if(v <= e).alias(f"b{i}") for i, e in enumerate(edges)]
    wide = df.groupBy(*by).agg(*counts, F.count(v).alias("total_count"), F.sum(v).alias("total_sum"))
    buckets = [
        F.struct(F.lit(float(e)).alias("le"), F.col(f"b{i}").alias("n")) for i, e in enumerate(edges)
    ]
    buckets.append(F.struct(F.lit(float("inf")).alias("le"), F.col("total_count").alias("n")))
    return wide.select(*by, F.explode(F.array(*buckets)).alias("bucket"), "total_count", "total_sum").select(
        *by, "bucket.le", "bucket.n", "total_count", "total_sum"
    )


NODE_CUTS = 64


def exact_percentiles(
    df: DataFrame,
    value: str,
    by: list[str],
    probabilities: tuple[float, ...] = (0.5, 0.95, 0.99),
    splits: int = 1024,
    most: int = 1 << 20,
) -> DataFrame:
    """Interpolated percentiles (by, p, value) without gathering a group anywhere.

    Equal values collapse to counts first. Values are cut into ranges of about equal
    row count, so even a group with most of the rows is spread over all ranges. Range
    totals say which ranges hold the wanted ranks, and only those are ordered. A range
    that still holds more than ``most`` values is cut again, by quantile sketches of its
    own values, and so on: what one task orders is bounded however many values there are.
    """
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    clean = df.select(group.alias("g"), F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    steps = [i / splits for i in range(1, splits)]
    cuts = sorted(set(clean.approxQuantile("v", steps, 0.25 / splits)))
    # NaN gets the range above all others, as it sorts above all other values.
    ranges_of = Bucketizer(
        splits=[-math.inf, *(c for c in cuts if math.isfinite(c)), math.inf],
        inputCol="v", outputCol="r", handleInvalid="keep",
    )
    counts = ranges_of.transform(clean.groupBy("g", "v").agg(F.count("*").alias("c")))
    rows = counts.select("g", "v", "c", F.lit(0).cast("bigint").alias("node"), F.col("r").cast("bigint").alias("part"))

    totals = counts.groupBy("g").agg(F.sum("c").alias("total"))
    position = F.col("p") * (F.col("total") - 1)
    wanted = totals.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    targets = wanted.select(
        "g", "p", F.lit(0).cast("bigint").alias("node"), position.alias("pos"), F.floor(position).alias("lo"), F.ceil(position).alias("hi"),
        F.lit(0).cast("bigint").alias("before"),
    )
    while True:
        targets = cut_lineage(_narrowed(rows, targets))
        largest = targets.agg(F.max("n_values")).first()[0]
        inner = rows.drop("node").withColumnRenamed("part", "node").join(targets.select("g", "node").distinct(), ["g", "node"], "left_semi")
        if largest is None or largest <= most:
            break
        inner = cut_lineage(inner)
        quantiles = F.percentile_approx("v", [i / NODE_CUTS for i in range(1, NODE_CUTS)], 100 * NODE_CUTS)
        own = inner.groupBy("g", "node").agg(F.array_distinct(quantiles).alias("cuts"))
        part = F.col("node") * NODE_CUTS + F.size(F.filter("cuts", lambda c: c < F.col("v")))
        rows = inner.join(own, ["g", "node"]).select("g", "v", "c", "node", part.alias("part"))

    inside = Window.partitionBy("g", "node", "p").orderBy("v")
    ranked = (
        inner.join(targets, ["g", "node"])
        .withColumn("last", F.col("before") + F.sum("c").over(inside) - 1)
        .withColumn("first", F.col("last") - F.col("c") + 1)
    )
    at = lambda rank: F.max(F.when(F.col(rank).between(F.col("first"), F.col("last")), F.col("v")))
    found = ranked.groupBy("g", "p", "pos", "lo").agg(at("lo").alias("v_lo"), at("hi").alias("v_hi"))
    # Equal ends need no sum: an infinite value has no distance to itself.
    between = F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("pos") - F.col("lo"))
    return found.select(*[F.col(f"g.{name}").alias(name) for name in by], "p", F.when(F.col("v_lo") == F.col("v_hi"), F.col("v_lo")).otherwise(between).alias("value"))


def _narrowed(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """The parts of each target's node that hold its ranks: targets with the part as node,
    what lies before it, and how many values it has."""
    ordered = Window.partitionBy("g", "node").orderBy("part")
    ranges = rows.groupBy("g", "node", "part").agg(F.sum("c").alias("rc"), F.count("*").alias("n_values")).withColumn("upto", F.sum("rc").over(ordered))
    met = targets.select("g", "p", "node", "pos", "lo", "hi", "before").join(ranges, ["g", "node"]).withColumn("upto", F.col("before") + F.col("upto")).withColumn("before", F.col("upto") - F.col("rc"))
    return met.filter((F.col("hi") >= F.col("before")) & (F.col("lo") < F.col("upto"))).select(
        "g", "p", F.col("part").alias("node"), "pos", "lo", "hi", "before", "n_values"
    )


def approx_percentiles(
    df: DataFrame, value: str, by: list[str], probabilities=(0.5, 0.95, 0.99), accuracy: int = 10_000
) -> DataFrame:
    """Percentiles from one sketch per group: one pass, bounded memory, bounded rank error."""
    wanted = [float(p) for p in probabilities]
    sketch = df.groupBy(*by).agg(F.percentile_approx(value, wanted, accuracy).alias("vs"))
    return sketch.select(
        *by, F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in wanted]).alias("p"), F.col("vs").alias("value"))).alias("z")
    ).select(*by, "z.p", "z.value")


def latency_by_class(op_log: DataFrame, class_column: Column) -> DataFrame:
    return op_log.groupBy(class_column.alias("batch_class")).agg(
        F.count("*").alias("n"),
        F.avg("duration_s").alias("avg_s"),
        F.max("duration_s").alias("max_s"),
    )


def with_resource_status(samples: DataFrame) -> DataFrame:
    return samples.withColumn(
        "status", resource_class(F.col("cpu_percent"), F.col("memory_percent"), F.col("disk_percent"))
    )


def health_rollup(samples: DataFrame, by: str = "service") -> DataFrame:
    """Status per service and overall (NULL service): any unhealthy sample wins, then any
    degraded one, then all healthy; otherwise unknown.

    Samples are counted per service first, so the rollup works on one row per service.
    """
    status, names = F.col("status"), ("unhealthy", "degraded", "healthy")
    counted = with_resource_status(samples).groupBy(by).agg(
        F.count("*").alias("n_samples"), *[F.count_if(status == n).alias(f"n_{n}") for n in names]
    )
    total = counted.rollup(by).agg(*[F.sum(c).alias(c) for c in counted.columns if c != by])
    worst = (
        F.when(F.col("n_unhealthy") > 0, F.lit("unhealthy"))
        .when(F.col("n_degraded") > 0, F.lit("degraded"))
        .when(F.col("n_healthy") == F.col("n_samples"), F.lit("healthy"))
        .otherwise(F.lit("unknown"))
    )
    return total.select(by, "n_samples", "n_unhealthy", "n_degraded", worst.alias("status"))


def event_type_summary(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(
        F.count("*").alias("n_events"),
        F.coalesce(F.sum("total_amount"), F.lit(0.0)).alias("total_amount"),
    )


def step_counts(events: DataFrame, time: str, by: list[str]) -> DataFrame:
    """Events per 10-second step and group."""
    counted = events.groupBy(*by, F.window(time, "10 seconds").alias("step")).agg(F.count("*").alias("n"))
    return counted.select(*by, F.col("step.start").alias("step"), "n")


def rates_from_steps(steps: DataFrame, by: list[str]) -> DataFrame:
    """Sliding 60-second windows, one every 10 seconds, put together from step counts."""
    w, step_end = F.col("w"), F.col("step") + F.expr("interval 10 seconds")
    spread = steps.select(*by, "step", "n", F.window("step", "60 seconds", "10 seconds").alias("w"))
    return (
        spread.groupBy(*by, "w").agg(
            F.sum("n").alias("n_60s"),
            F.coalesce(F.sum(F.when(step_end == w.end, F.col("n"))), F.lit(0)).alias("n_10s"),
        )
        .select(
            *by, w.start.alias("window_start"), w.end.alias("window_end"), "n_60s", "n_10s",
            (F.col("n_60s") / 60.0).alias("rate_60s"), (F.col("n_10s") / 10.0).alias("rate_10s"),
        )
        .withColumn("level", throughput_class(F.col("rate_60s")))
        .withColumn("on_target", meets_target(F.col("rate_60s")))
    )


def sliding_rates(events: DataFrame, time: str, by: list[str]) -> DataFrame:
    """Events per second over the trailing 60 s and 10 s, every 10 s, per group.

    Rows are counted per 10-second step first; the six-fold fan-out of the sliding
    window then touches the counts, not the events.
    """
    return rates_from_steps(step_counts(events, time, by), by)


def rates_at(events: DataFrame, time: str, now: Column, retention_seconds: int = 300) -> DataFrame:
    """The rates at one instant: 60 s, 10 s, and since the first event. One row.

    Counts over 60 s and 10 s look at the retained window only; the overall rate at all.
    """
    age = F.timestamp_diff("MICROSECOND", F.col(time), now) / 1e6
    retained = (age >= 0) & (age <= retention_seconds)
    totals = events.agg(
        F.count_if(age >= 0).alias("n_total"),
        F.count_if(retained & (age <= 60)).alias("n_60s"),
        F.count_if(retained & (age <= 10)).alias("n_10s"),
        F.max(age).alias("elapsed_s"),
    )
    return totals.select(
        "n_total", (F.col("n_60s") / 60.0).alias("rate_60s"), (F.col("n_10s") / 10.0).alias("rate_10s"),
        F.coalesce(F.try_divide("n_total", "elapsed_s"), F.lit(0.0)).alias("rate_overall"),
    )


def counter_rates(
    samples: DataFrame, time: str, value: str, by: list[str], window: str = "5 minutes", seconds: int = 300
) -> DataFrame:
    """Per-second increase of a counter per label set and window, resets respected.

    A drop means the counter began again at zero. Growth since the last sample of the
    window before counts where it was seen: in the window of the later sample. So the
    increases of a label set add up to that of its whole series.

    Samples are compared inside a window, so a label set with most of them is spread over
    all windows; each window then hands its last value on, as one row per window.
    """
    placed = samples.select(*by, F.col(time).alias("_t"), F.col(value).alias("_v")).withColumn(
        "window_start", F.window("_t", window).start
    )
    growth = lambda v, before: F.when(before.isNull(), F.lit(0.0)).when(v >= before, v - before).otherwise(v)
    in_window = Window.partitionBy(*by, "window_start").orderBy("_t", "_v")
    inside = placed.withColumn("_grown", growth(F.col("_v"), F.lag("_v").over(in_window)))
    rows = inside.groupBy(*by, "window_start").agg(
        F.count("*").alias("n_samples"), F.sum("_grown").alias("_inside"),
        F.min(F.struct("_t", "_v"))["_v"].alias("_first"), F.max(F.struct("_t", "_v"))["_v"].alias("_last"),
    )
    handed = F.lag("_last").over(Window.partitionBy(*by).orderBy("window_start"))
    return (
        rows.withColumn("increase", F.col("_inside") + growth(F.col("_first"), handed))
        .withColumn("rate", F.col("increase") / float(seconds))
        .select(*by, "window_start", "n_samples", "increase", "rate")
    )
