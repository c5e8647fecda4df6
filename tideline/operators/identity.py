"""Identity of series and observations, and the set operations that follow from it.

A series is identified by all six dimensions. Equality of series objects looks at the metric
name only, so ``distinct``, intersection and subtraction of series collections go by metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.model import DIMENSIONS, dimension_label
from tideline.operators.joining import series_summary


def series_key(frame: DataFrame) -> DataFrame:
    """Distinct identities with a 64-bit hash of them."""
    return frame.select(*DIMENSIONS).distinct().withColumn("key_hash", F.xxhash64(*DIMENSIONS))


def distinct_observations(observations: DataFrame) -> DataFrame:
    """Observations equal in all dimensions, timestamp and value, once each."""
    return observations.select(*DIMENSIONS, "timestamp", "value").distinct()


def distinct_metrics(chunks: DataFrame) -> DataFrame:
    """One series per metric: the earliest one, then the first by dimensions (nulls first).

    A smallest-of aggregate, so a metric holding most of the series is combined map-side.
    """
    first = F.min(F.struct("series_start", *DIMENSIONS))
    return (
        series_summary(chunks)
        .groupBy(F.col("metric").alias("_metric"))
        .agg(first.alias("_first"))
        .select("_first.*")
        .select(*DIMENSIONS, "series_start")
    )


def share_of(label: Column, share: float, seed: int = 0) -> Column:
    """Whether a label falls into a share of all labels: the first 32 bits of its MD5, with the seed in front. The same on every run
    and in every engine."""
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), label)), 1, 8), 16, 10).cast("bigint")
    return drawn < F.lit(int(share * (1 << 32))).cast("bigint")


def sample_series(series: DataFrame, share: float, seed: int = 0) -> DataFrame:
    """A share of the series, each whole: all rows of a series are taken or none, whichever table they are in. A scan with a
    filter, without a shuffle."""
    if not 0 <= share <= 1:
        raise ValueError("a share is between 0 and 1")
    return series.where(share_of(dimension_label(), share, seed))


def union_series(*collections: DataFrame) -> DataFrame:
    """All rows of all collections; columns one of them lacks are null there."""
    first, *others = collections
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def intersect_series(left: DataFrame, right: DataFrame) -> DataFrame:
    """One series for every metric found in both collections, taken from the left one."""
    metrics = right.select("metric").distinct()
    return distinct_metrics(left).join(metrics, "metric", "left_semi")


def subtract_series(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of the left collection whose metric the right one does not have."""
    return left.join(right.select("metric").distinct(), "metric", "left_anti")
