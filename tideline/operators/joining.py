"""Joining chunks into whole series.

Chunks of one identity are ordered by start (then id) and their points put one after the
other, without removing duplicates and without sorting points. What a query needs of that
order is mostly the position of a chunk inside its series, which is a running total over
chunk sizes and moves no points. Only ``join_chunks`` brings points of several chunks
together, in rows of bounded length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.points import series_size
from tideline.model import DIMENSIONS, MAX_SERIES_ROW_POINTS
from tideline.operators.keyed import PERIODS_MS, null_safe_join, running_total


def with_first_position(chunks: DataFrame, periods_ms: Sequence[int] = PERIODS_MS) -> DataFrame:
    """Add ``first_pos``: how many points of the series come before the chunk.

    Positions are worked out on chunk headers alone and joined back by chunk, a key that is
    spread evenly however large a series is. Rows that share identity, start and id share
    their position.
    """
    chunks = chunks.drop("first_pos")
    headers = chunks.groupBy(*DIMENSIONS, "start", "chunk_id").agg(
        F.sum("n_points").alias("_size")
    )
    positions = running_total(
        headers, DIMENSIONS, "start", ["start", "chunk_id"], "_size", "first_pos", periods_ms
    ).drop("_size")
    return null_safe_join(chunks, positions, [*DIMENSIONS, "start", "chunk_id"], "inner")


def join_chunks(
    chunks: DataFrame,
    max_points: int = MAX_SERIES_ROW_POINTS,
    periods_ms: Sequence[int] = PERIODS_MS,
) -> DataFrame:
    """Series rows: chunk columns and ``first_pos``.

    One row per series up to ``max_points`` points. A longer series comes as consecutive rows
    of about that length; ``first_pos`` orders them and no point is lost. The rows are chunks
    again, so joining joined data changes nothing.

    An identity may so have several rows, and what is said of a series must hold for all of them: ``filter_whole_series``,
    ``points_at``, ``sorted_points``, ``take_series`` and the aggregates give the same for any ``max_points``. Expressions
    on one array (``functions.points``) see one row.
    """
    rows = with_first_position(chunks, periods_ms).withColumn(
        "_row", F.call_function("div", F.col("first_pos"), F.lit(max_points))
    )
    parts = F.sort_array(F.collect_list(F.struct("start", "chunk_id", "first_pos", "end", "points")))
    joined = (
        rows.groupBy(*DIMENSIONS, "_row")
        .agg(parts.alias("_parts"))
        .select(
            *DIMENSIONS,
            F.get(F.col("_parts.chunk_id"), F.lit(0)).alias("chunk_id"),
            F.get(F.col("_parts.start"), F.lit(0)).alias("start"),
            F.array_max("_parts.end").alias("end"),
            F.get(F.col("_parts.first_pos"), F.lit(0)).alias("first_pos"),
            F.flatten(F.filter("_parts.points", lambda p: p.isNotNull())).alias("points"),
        )
    )
    return joined.withColumn("n_points", series_size("points"))


def indexed_points(series: DataFrame) -> DataFrame:
    """One row per point with ``pos``, its position in the series (in the row for chunks)."""
    first = F.col("first_pos") if "first_pos" in series.columns else F.lit(0)
    return series.select(
        *DIMENSIONS, first.alias("_first"), F.posexplode("points").alias("_pos", "_point")
    ).select(
        *DIMENSIONS,
        (F.col("_first") + F.col("_pos")).cast("bigint").alias("pos"),
        F.col("_point.timestamp").alias("timestamp"),
        F.col("_point.value").alias("value"),
    )


def joined_points(chunks: DataFrame, periods_ms: Sequence[int] = PERIODS_MS) -> DataFrame:
    """Points of the joined series with their position, without ever forming series rows."""
    return indexed_points(with_first_position(chunks, periods_ms))


def sorted_points(series: DataFrame, periods_ms: Sequence[int] = PERIODS_MS) -> DataFrame:
    """One row per point with ``pos``, its position in the series ordered by timestamp; points of equal
    timestamp keep their order.

    ``series`` are rows of ``join_chunks``, however many a series has, or the chunks themselves ``with_first_position``, which
    spares forming series rows. Positions are a running count over time, so a long series is not sorted in one row or task.
    """
    points = indexed_points(series).withColumn("_one", F.lit(1))
    counted = running_total(
        points, DIMENSIONS, "timestamp", ["timestamp", "pos"], "_one", "_sorted", periods_ms
    )
    return counted.select(*DIMENSIONS, F.col("_sorted").cast("bigint").alias("pos"), "timestamp", "value")


def points_at(chunks: DataFrame, positions: Sequence[int], periods_ms: Sequence[int] = PERIODS_MS) -> DataFrame:
    """The points at some 0-based positions of every joined series: one row per series and position (repeats once), with
    ``pos``, ``timestamp`` and ``value``, null where the series has no such position, as for negative ones.

    ``chunks`` may be joined rows of any length. A position is looked up in the headers, in the range
    ``[first_pos, first_pos + n_points)`` of one chunk; only the points of the chunks found are read and moved.
    """
    asked = F.array(*[F.lit(p).cast("bigint") for p in sorted(set(positions))]) if positions else F.array().cast("array<bigint>")
    key = [*DIMENSIONS, "start", "chunk_id"]
    headers = chunks.drop("first_pos").groupBy(*key).agg(F.sum("n_points").alias("_size"))
    placed = running_total(headers, DIMENSIONS, "start", ["start", "chunk_id"], "_size", "first_pos", periods_ms)
    inside = F.filter(asked, lambda p: (p >= F.col("first_pos")) & (p < F.col("first_pos") + F.col("_size")))
    wanted = placed.withColumn("_inside", inside).where(F.size("_inside") > 0).select(*key, "first_pos", "_inside")
    # Rows that share identity, start and id are one behind the other, as join_chunks puts them.
    held = null_safe_join(chunks.select(*key, "end", "points"), wanted.select(*key), key, "left_semi")
    parts = F.sort_array(F.collect_list(F.struct("end", "points")))
    whole = held.groupBy(*key).agg(F.flatten(F.filter(parts["points"], lambda p: p.isNotNull())).alias("points"))
    found = null_safe_join(wanted, whole, key, "inner").select(
        *DIMENSIONS, F.explode(F.transform("_inside", lambda p: F.struct(
            p.alias("pos"), F.get(F.col("points"), (p - F.col("first_pos")).cast("int")).alias("point")))).alias("_at")
    ).select(*DIMENSIONS, "_at.pos", "_at.point.timestamp", "_at.point.value")
    every = headers.select(*DIMENSIONS).distinct().select(*DIMENSIONS, F.explode(asked).alias("pos"))
    return null_safe_join(every, found, [*DIMENSIONS, "pos"], "left")


def series_summary(chunks: DataFrame) -> DataFrame:
    """One row per series: start, end and size of the joined series, by position.

    The first point of a joined series is the first one of its first chunk that is not empty,
    so this is an aggregate with map-side combine over chunk headers.
    """
    times = F.col("points")["timestamp"]
    order = [F.col("start"), F.col("chunk_id")]
    held = F.col("n_points") > 0
    first = F.struct(*order, F.try_element_at(times, F.lit(1)).alias("time"))
    last = F.struct(*order, F.try_element_at(times, F.lit(-1)).alias("time"))
    return (
        chunks.groupBy(*DIMENSIONS)
        .agg(
            F.count(F.lit(1)).alias("n_chunks"),
            F.min(F.when(held, first)).alias("_first"),
            F.max(F.when(held, last)).alias("_last"),
            F.sum("n_points").alias("n_points"),
        )
        .select(
            *DIMENSIONS,
            "n_chunks",
            F.coalesce("_first.time", F.lit(0)).alias("series_start"),
            F.coalesce("_last.time", F.lit(0)).alias("series_end"),
            "n_points",
        )
    )
