"""Building chunks from observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.points import point, whole_div
from tideline.model import DIMENSIONS, MAX_CHUNK_POINTS
from tideline.operators.keyed import PERIODS_MS, null_safe_join, running_total


def _with_chunk_of_period(
    rows: DataFrame,
    unit: Sequence[str],
    spread: str,
    too_long: DataFrame,
    max_points: int,
    periods_ms: Sequence[int],
) -> DataFrame:
    """Rows with ``_part`` and ``_way``, which tell the chunks of one period apart.

    The points of the periods in ``too_long`` are counted by slices. A chunk begins with the
    slice that starts past the bound; a slice larger than the bound is dealt out ``_ways``.
    Equal rows become one with its number of ``_copies`` before anything is shuffled, and
    several if they are too many for one chunk. Points of all other periods pass by.
    """
    other_rows = null_safe_join(rows, too_long, unit, "left_anti")
    long_rows = (
        null_safe_join(rows, too_long, unit, "left_semi")
        .groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_all_copies"))
    )
    sizes = long_rows.groupBy(*unit, "_slice").agg(F.sum("_all_copies").alias("_n"))
    cuts = (
        running_total(sizes, unit, "_slice", ["_slice"], "_n", "_earlier", periods_ms)
        .select(
            *unit, "_slice",
            F.call_function("div", F.col("_earlier"), F.lit(max_points)).alias("_part"),
            F.ceil(F.col("_n") / max_points).alias("_ways"),
        )
        .where((F.col("_part") > 0) | (F.col("_ways") > 1))
    )
    portion = F.col("_portion")
    last_portion = F.call_function("div", F.col("_all_copies") - 1, F.lit(max_points))
    placed = (
        null_safe_join(long_rows, cuts, [*unit, "_slice"])
        .withColumn("_portion", F.explode(F.sequence(F.lit(0).cast("bigint"), last_portion)))
        .select(
            *rows.columns,
            F.coalesce("_part", F.lit(0)).alias("_part"),
            F.coalesce(F.pmod(F.col(spread) + portion, F.col("_ways")), F.lit(0)).alias("_way"),
            F.least(F.col("_all_copies") - portion * max_points, F.lit(max_points)).alias("_copies"),
        )
    )
    return placed.unionByName(_whole(other_rows).withColumn("_copies", F.lit(1).cast("bigint")))


def _whole(rows: DataFrame) -> DataFrame:
    """Rows whose periods are one chunk each."""
    nothing = F.lit(0).cast("bigint")
    return rows.withColumns({"_part": nothing, "_way": nothing})


def build_chunks(
    observations: DataFrame,
    period: Column,
    tie_break: Sequence[str],
    max_points: int = MAX_CHUNK_POINTS,
    slice_ms: int = 1000,
    periods_ms: Sequence[int] = PERIODS_MS,
) -> DataFrame:
    """One chunk per series and period, or several where it holds more than ``max_points``.

    ``tie_break`` names integer columns that order points of equal time; the first one also
    spreads points that share one slice of time. Points are counted before they are moved, so
    nothing larger than a chunk is gathered in one place. The count runs at once, as a job of
    its own: where no period is too long, which one narrow scan tells, points are moved once.
    """
    unit = [*DIMENSIONS, "_period"]
    rows = observations.select(
        *DIMENSIONS, "timestamp", *tie_break, "value",
        period.alias("_period"),
        (whole_div("timestamp", slice_ms) * slice_ms).alias("_slice"),
    )
    too_long = (
        rows.groupBy(*unit).agg(F.count(F.lit(1)).alias("_all"))
        .where(F.col("_all") > max_points)
        .select(*unit)
    )
    if too_long.isEmpty():
        placed = _whole(rows)
    else:
        placed = _with_chunk_of_period(
            rows, unit, tie_break[0], too_long, max_points, periods_ms
        )
    copied = "_copies" in placed.columns
    # The hash decides nothing, it leads the grouping keys so that sorting by them is cheap.
    hashed = placed.withColumn("_series", F.xxhash64(*DIMENSIONS))
    entry = F.struct("timestamp", *tie_break, "value", *(["_copies"] if copied else []))
    if copied:
        points = F.flatten(F.transform("_entries", lambda e: F.array_repeat(
            point(e["timestamp"], e["value"]), e["_copies"].cast("int")
        )))
    else:
        points = F.transform("_entries", lambda e: point(e["timestamp"], e["value"]))
    names = [F.coalesce(F.col(d), F.lit("")) for d in DIMENSIONS]
    return (
        hashed.groupBy("_series", "_period", "_part", "_way", *DIMENSIONS)
        .agg(
            F.min("timestamp").alias("start"),
            F.max("timestamp").alias("end"),
            (F.sum("_copies") if copied else F.count(F.lit(1))).alias("n_points"),
            F.sort_array(F.collect_list(entry)).alias("_entries"),
        )
        .select(
            *DIMENSIONS,
            F.concat_ws("|", *names, "_period", "_part", "_way").alias("chunk_id"),
            "start",
            "end",
            "n_points",
            points.alias("points"),
            F.lit(None).cast("double").alias("function_value"),
        )
    )
