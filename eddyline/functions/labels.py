"""Classes derived from numbers: batch size, throughput, latency, resource use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eddyline.schemas import SLA_SECONDS

# Fixed values: (lower bound, label), highest first; the last label has no bound.
BATCH_SIZE_BANDS = (
    (5000, "xxlarge_5000+"), (1000, "xlarge_1000-5000"), (500, "large_500-1000"),
    (100, "medium_100-500"), (None, "small_<100"),
)
PIPELINE_BANDS = (
    (5000, "excellent"), (2000, "good"), (1000, "moderate"),
    (100, "moderate_below_target"), (None, "low"),
)
FLUSH_BANDS = ((8000, "excellent"), (5000, "good"), (2000, "normal"), (None, "low"))
PIPELINE_TARGET = 1000
# The store-write averages compare strictly, unlike the bands above.
STORE_WRITE_ABOVE = ((1200, "target_met"), (800, "good"), (None, "below_target"))
RESOURCE_ABOVE = ((95, "unhealthy"), (85, "degraded"), (None, "healthy"))


def band(value: Column, bands, strict: bool = False) -> Column:
    chain = None
    for bound, label in bands:
        if bound is None:
            return F.when(value.isNotNull(), chain.otherwise(F.lit(label)))
        hit = value > bound if strict else value >= bound
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain


def batch_size_class(size: Column) -> Column:
    return band(size, BATCH_SIZE_BANDS)


def throughput_class(rate: Column, bands=PIPELINE_BANDS) -> Column:
    return band(rate, bands)


def store_write_class(rate: Column) -> Column:
    return band(rate, STORE_WRITE_ABOVE, strict=True)


def meets_target(rate: Column, target: float = PIPELINE_TARGET) -> Column:
    return rate >= target


def sla_breach(seconds: Column, limit: float = SLA_SECONDS) -> Column:
    return seconds > limit


def resource_class(*percents: Column) -> Column:
    """The worst reading decides; a sample with a reading missing is unknown."""
    complete = percents[0].isNotNull()
    for p in percents[1:]:
        complete = complete & p.isNotNull()
    graded = band(F.greatest(*percents), RESOURCE_ABOVE, strict=True)
    return F.when(complete, graded).otherwise(F.lit("unknown"))
