"""Expressions on one ``points`` array: everything here stays inside its row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.model import POINTS


def _column(points: Column | str) -> Column:
    return F.col(points) if isinstance(points, str) else points


def whole_div(number: Column | str, unit: int) -> Column:
    """Integer division rounding down, also below zero and beyond the exact range of doubles."""
    number = _column(number)
    return F.call_function("div", number - F.pmod(number, F.lit(unit)), F.lit(unit))


def empty_points() -> Column:
    return F.array().cast(POINTS)


def point(timestamp: Column, value: Column) -> Column:
    return F.struct(timestamp.cast("bigint").alias("timestamp"), value.cast("double").alias("value"))


def series_size(points: Column | str = "points") -> Column:
    """Number of points; 0 for a missing array. Reads one leaf of the array only."""
    return F.coalesce(F.array_size(_column(points)["timestamp"]), F.lit(0)).cast("bigint")


def series_is_empty(points: Column | str = "points") -> Column:
    return series_size(points) == 0


def series_start(points: Column | str = "points") -> Column:
    """Timestamp of the first point by position (not the smallest one), 0 if there is none."""
    return F.coalesce(F.try_element_at(_column(points)["timestamp"], F.lit(1)), F.lit(0))


def series_end(points: Column | str = "points") -> Column:
    """Timestamp of the last point by position, 0 if there is none."""
    return F.coalesce(F.try_element_at(_column(points)["timestamp"], F.lit(-1)), F.lit(0))


def value_at(index: Column | int, points: Column | str = "points") -> Column:
    """Value at a 0-based position, null outside the series."""
    return F.get(_column(points)["value"], F.lit(index) if isinstance(index, int) else index)


def time_at(index: Column | int, points: Column | str = "points") -> Column:
    """Timestamp at a 0-based position, null outside the series."""
    return F.get(_column(points)["timestamp"], F.lit(index) if isinstance(index, int) else index)


def timestamps_array(points: Column | str = "points") -> Column:
    return _column(points)["timestamp"]


def values_array(points: Column | str = "points") -> Column:
    return _column(points)["value"]


def replace_points(frame: DataFrame, points: Column) -> DataFrame:
    """Give every row other points, and the header that goes with them.

    ``start`` and ``end``, where there are any, become the smallest and largest timestamp, as range
    scans prune by them. A row without points keeps its bounds.
    """
    changed = frame.withColumn("points", points)
    times = F.col("points.timestamp")
    bounds = {"start": F.array_min(times), "end": F.array_max(times)}
    renewed = {c: F.coalesce(b, F.col(c)) for c, b in bounds.items() if c in frame.columns}
    return changed.withColumns({**renewed, "n_points": series_size("points")})


def sort_points(points: Column | str = "points") -> Column:
    """Points ordered by timestamp; points of equal timestamp keep their order."""
    numbered = F.transform(
        _column(points),
        lambda p, i: F.struct(
            p["timestamp"].alias("timestamp"), i.alias("pos"), p["value"].alias("value")
        ),
    )
    return F.transform(F.sort_array(numbered), lambda p: point(p["timestamp"], p["value"]))


def append_points(other: Column, points: Column | str = "points") -> Column:
    """Points followed by the ones of another array."""
    return F.concat(_column(points), other)


def append_point(timestamp: Column, value: Column, points: Column | str = "points") -> Column:
    return append_points(F.array(point(timestamp, value)), points)


def points_between(from_ms: int, to_ms: int, points: Column | str = "points") -> Column:
    """Points with ``from_ms <= timestamp <= to_ms``, in their order."""
    return F.filter(_column(points), lambda p: p["timestamp"].between(from_ms, to_ms))


def mid_time(start: Column | str = "start", end: Column | str = "end") -> Column:
    """Middle of a time span in whole milliseconds, halves cut off towards the start."""
    first, last = _column(start), _column(end)
    half = F.call_function("div", last - first, F.lit(2))
    return first + half


def function_point(
    value: Column | str = "function_value",
    start: Column | str = "start",
    end: Column | str = "end",
) -> Column:
    """The one point that stands for an aggregate over a time span."""
    return point(mid_time(start, end), _column(value))


def millis_to_time(millis: Column | str = "timestamp") -> Column:
    return F.timestamp_millis(_column(millis))


def time_to_millis(time: Column | str = "time") -> Column:
    return F.unix_millis(_column(time))
