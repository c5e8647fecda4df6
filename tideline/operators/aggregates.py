"""Aggregates over all values, and the slope of every series.

None of these depends on chunks being joined, so they take chunks, series or observations
alike and never pay for a join. All combine map-side; what is shuffled is one partial row per
task (or per task and series).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tideline.model import DIMENSIONS, MAX_SERIES_ROW_POINTS, dimension_label
from tideline.operators.flatten import values
from tideline.operators.identity import share_of
from tideline.operators.joining import join_chunks
from tideline.operators.keyed import null_safe_join


def mean(frame: DataFrame) -> DataFrame:
    """Mean over all values, every point counting the same; null if there is none."""
    return values(frame).agg(F.avg("value").alias("mean"))


def approx_mean(frame: DataFrame) -> DataFrame:
    """The mean as an approximation that is waited for to the end, hence exact."""
    return values(frame).agg(F.avg("value").alias("approx_mean"))


#: Chunks a sample needs before its error is believed, and standard errors on either side of the mean (95 %).
LEAST_SAMPLE = 30
DEVIATIONS = 1.96


def sampled_mean(chunks: DataFrame, share: float, seed: int = 0, most_error: float | None = None) -> DataFrame:
    """The mean from a sample of chunks: mean, error (half a 95 % interval), share_read (of the points) and n_chunks.

    A chunk is in the sample or not by the hash of its identity and id, and a larger share holds a smaller one. The mean is the ratio
    of sampled sums to sampled sizes, so long chunks count as they should; its error comes from how much the chunks' sums
    stray from it. Where the sample has fewer than LEAST_SAMPLE chunks, or ``most_error`` is given and not kept, the share is quadrupled, up to
    all chunks: then the mean is exact and its error 0. Sums combine map-side; every turn brings one row to the driver.
    Values that are no number make the mean NaN; without points it is null.
    """
    if not 0 < share <= 1:
        raise ValueError("a share is above 0 and at most 1")
    held = chunks.where(F.col("n_points") > 0)
    label = F.concat(dimension_label(), F.lit("|"), F.col("chunk_id"))
    inside = F.aggregate("points.value", F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0)))
    size = F.aggregate("points.value", F.lit(0).cast("bigint"), lambda a, v: a + v.isNotNull().cast("bigint")).cast("double")
    whole = held.agg(F.count(F.lit(1)).alias("chunks"), F.coalesce(F.sum("n_points"), F.lit(0)).alias("points")).first()
    while True:
        sample = held if share >= 1 else held.where(share_of(label, share, seed))
        y, x = F.col("_y"), F.col("_x")
        got = sample.select(inside.alias("_y"), size.alias("_x"), "n_points").agg(
            F.count(F.lit(1)).alias("m"), F.sum("n_points").alias("points"), F.sum(y).alias("y"), F.sum(x).alias("x"),
            F.sum(y * y).alias("yy"), F.sum(x * y).alias("xy"), F.sum(x * x).alias("xx")).first()
        if share >= 1:
            mean_, error = (got["y"] / got["x"] if got["x"] else None), 0.0
            break
        if got["m"] >= LEAST_SAMPLE and got["x"]:
            mean_ = got["y"] / got["x"]
            spread = max(got["yy"] - 2 * mean_ * got["xy"] + mean_ * mean_ * got["xx"], 0.0) / (got["m"] - 1)
            error = DEVIATIONS * math.sqrt((1 - got["m"] / whole["chunks"]) * spread * got["m"]) / got["x"] if math.isfinite(mean_) else math.nan
            if most_error is None or error <= most_error:
                break
        share = min(share * 4, 1.0)
    read = (got["points"] or 0) / whole["points"] if whole["points"] else 1.0
    return chunks.sparkSession.createDataFrame([(mean_, error, read, got["m"])], "mean double, error double, share_read double, n_chunks bigint")


def minimum(frame: DataFrame) -> DataFrame:
    """Smallest value. Chunk rows are reduced inside the row first."""
    value = F.array_min("points.value") if "points" in frame.columns else F.col("value")
    return frame.agg(F.min(value).alias("min"))


def maximum(frame: DataFrame) -> DataFrame:
    """Largest value, NaN counting as the largest of all."""
    value = F.array_max("points.value") if "points" in frame.columns else F.col("value")
    return frame.agg(F.max(value).alias("max"))


def count_observations(frame: DataFrame) -> DataFrame:
    """Number of points. Chunk tables answer it from their headers, chunks without a size from their
    points; only flat frames have a row per point."""
    if "n_points" in frame.columns:
        size = F.sum("n_points")
    elif "points" in frame.columns:
        size = F.sum(F.coalesce(F.array_size("points"), F.lit(0)).cast("bigint"))
    else:
        size = F.count(F.lit(1))
    return frame.agg(F.coalesce(size, F.lit(0)).alias("n_observations"))


def count_series(frame: DataFrame) -> DataFrame:
    """Number of series: distinct identities, however many rows each comes in."""
    return frame.select(*DIMENSIONS).distinct().agg(F.count(F.lit(1)).alias("n_series"))


def count_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count(F.lit(1)).alias("n_chunks"))


def slopes(frame: DataFrame, by: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Least-squares slope of value over timestamp (per millisecond), one row per series.

    NaN where a line is not defined: fewer than two points, or all at one time. With
    ``by=[*DIMENSIONS, "chunk_id"]`` every chunk gets its own slope.
    """
    if "points" in frame.columns:
        frame = frame.select(*by, F.explode("points").alias("_point")).select(
            *by,
            F.col("_point.timestamp").alias("timestamp"),
            F.col("_point.value").alias("value"),
        )
    slope = F.regr_slope(F.col("value"), F.col("timestamp").cast("double"))
    return frame.groupBy(*by).agg(F.coalesce(slope, F.lit(float("nan"))).alias("slope"))


def in_series_order(series: DataFrame) -> DataFrame:
    """Rows by identity, the rows of one series one after another in their order."""
    within = [c for c in ("first_pos", "start", "chunk_id") if c in series.columns]
    return series.orderBy(*DIMENSIONS, *within)


def take_series(series: DataFrame, n: int) -> DataFrame:
    """The first ``n`` series in identity order, with all rows of each, however many those are."""
    chosen = series.select(*DIMENSIONS).distinct().orderBy(*DIMENSIONS).limit(n)
    return in_series_order(null_safe_join(series, chosen, DIMENSIONS, "left_semi"))


def take_joined(chunks: DataFrame, n: int, max_points: int = MAX_SERIES_ROW_POINTS) -> DataFrame:
    """``take_series`` of the joined chunks, of which only those of the series taken are joined: the first ``n`` identities
    come from the headers, each task keeping no more than ``n``."""
    chosen = chunks.select(*DIMENSIONS).distinct().orderBy(*DIMENSIONS).limit(n)
    return in_series_order(join_chunks(null_safe_join(chunks, chosen, DIMENSIONS, "left_semi"), max_points))


def take_chunks(chunks: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows in identity order. Every task keeps no more than ``n`` of its rows."""
    return chunks.orderBy(*DIMENSIONS, "chunk_id").limit(n)


def collect_series(series: DataFrame) -> Iterator[Row]:
    """Iterate over series rows on the driver, one partition at a time, series by series."""
    return in_series_order(series).toLocalIterator(prefetchPartitions=True)
