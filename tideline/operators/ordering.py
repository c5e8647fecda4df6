"""Order of series by start time, and chunks of one series that overlap in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.model import DIMENSIONS
from tideline.operators.keyed import PERIODS_MS, null_safe_join, running_before


def order_series(frame: DataFrame) -> DataFrame:
    """Global order by start time, missing ones first, ties by chunk id."""
    return frame.orderBy(F.asc_nulls_first("start"), "chunk_id")


def overlap_counts(chunks: DataFrame, periods_ms: Sequence[int] = PERIODS_MS) -> DataFrame:
    """For every chunk the number of earlier-starting chunks of its series that reach it: DIMENSIONS, chunk_id, start,
    end and n_earlier, 0 included.

    Of the chunks that began before a chunk starts those that ended before do not reach it; so the number is a
    difference of two running counts, of starts and of ends, taken in one pass along the series. No
    pair is listed: the work is linear in the chunks, however many overlap.
    """
    ends = F.struct(F.col("end").alias("time"), F.lit(-1).alias("step"))
    starts = F.struct(F.col("start").alias("time"), F.lit(1).alias("step"))
    events = chunks.select(*DIMENSIONS, "chunk_id", "start", "end", F.explode(F.array(starts, ends)).alias("_event")).select(
        *DIMENSIONS, "chunk_id", "start", "end", F.col("_event.time").alias("_time"), F.col("_event.step").cast("bigint").alias("_step"))
    counted = running_before(
        events,
        keys=DIMENSIONS,
        time="_time",
        within=lambda w: w.orderBy("_time").rangeBetween(Window.unboundedPreceding, -1),
        total=F.sum,
        merge=lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
        value="_step",
        name="_open",
        periods_ms=periods_ms,
    )
    return counted.where("_step = 1").select(*DIMENSIONS, "chunk_id", "start", "end", F.col("_open").cast("bigint").alias("n_earlier"))


def sort_series(series: DataFrame, key: Column, ascending: bool = True) -> DataFrame:
    """Rows in the order of a key of their series, ``key`` an aggregate over its rows, ties by identity; the rows of one series
    stay one after another. Adds ``sort_key``. The sort is range-partitioned, nulls come first."""
    keys = series.groupBy(*DIMENSIONS).agg(key.alias("sort_key"))
    within = [c for c in ("first_pos", "start", "chunk_id") if c in series.columns]
    by = F.asc_nulls_first("sort_key") if ascending else F.desc_nulls_first("sort_key")
    return null_safe_join(series, keys, DIMENSIONS, "inner").orderBy(by, *DIMENSIONS, *within)


def chunk_overlaps(chunks: DataFrame, periods_ms: Sequence[int] = PERIODS_MS) -> DataFrame:
    """Chunks that begin before an earlier-starting chunk of their series has ended.

    One row per such chunk, next to the earlier one that reaches furthest: every chunk that
    intersects an earlier one is found, and the result stays linear in the number of chunks
    where listing all pairs would not. Works on chunk headers; points are not read.
    """
    headers = chunks.select(
        *DIMENSIONS, "chunk_id", "start", "end",
        F.struct("end", "start", "chunk_id").alias("_reach"),
    )
    reached = running_before(
        headers,
        keys=DIMENSIONS,
        time="start",
        within=lambda w: w.orderBy("start").rangeBetween(Window.unboundedPreceding, -1),
        total=F.max,
        merge=F.greatest,
        value="_reach",
        name="_earlier",
        periods_ms=periods_ms,
    )
    return reached.where(F.col("_earlier.end") >= F.col("start")).select(
        *DIMENSIONS,
        F.col("_earlier.chunk_id").alias("left_id"),
        F.col("_earlier.start").alias("left_start"),
        F.col("_earlier.end").alias("left_end"),
        F.col("chunk_id").alias("right_id"),
        F.col("start").alias("right_start"),
        F.col("end").alias("right_end"),
    )
