"""Filters on series, chunks and observations. All are conditions Spark can push to a scan."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.model import DIMENSIONS
from tideline.operators.flatten import observations
from tideline.operators.keyed import null_safe_join


def filter_series(series: DataFrame, predicate: Column) -> DataFrame:
    """Keep rows for which the predicate holds (null counts as no).

    The predicate sees one row. Where a series may come in several, ``filter_whole_series`` judges it as a whole.
    """
    return series.where(predicate)


def any_point(test: Callable[[Column], Column]) -> Column:
    """Some point of the series passes: an aggregate for ``filter_whole_series``. A null test is a no."""
    return F.coalesce(F.bool_or(F.exists(F.filter("points", lambda p: p.isNotNull()), lambda p: F.coalesce(test(p), F.lit(False)))), F.lit(False))


def every_point(test: Callable[[Column], Column]) -> Column:
    """All points of the series pass, as they do if there is none. A null test is a no."""
    return F.coalesce(F.bool_and(F.forall(F.filter("points", lambda p: p.isNotNull()), lambda p: F.coalesce(test(p), F.lit(False)))), F.lit(True))


def total_points() -> Column:
    """Number of points of the series, from the headers."""
    return F.coalesce(F.sum("n_points"), F.lit(0))


def total_value(part: Callable[[Column], Column]) -> Column:
    """Sum of a number for every value of the series; 0 if there is none."""
    within = F.aggregate("points.value", F.lit(0.0), lambda a, v: a + F.coalesce(part(v).cast("double"), F.lit(0.0)))
    return F.coalesce(F.sum(within), F.lit(0.0))


def filter_whole_series(series: DataFrame, predicate: Column) -> DataFrame:
    """Keep all rows of the series for which ``predicate`` holds, an aggregate over the rows of one identity
    (null counts as no).

    ``any_point``, ``every_point``, ``total_points`` and ``total_value`` are such aggregates, and so is any other of Spark's over
    columns of the rows. The result is the same for chunks and for joined rows of any length. What is shuffled for the verdict is one
    partial row per task and series; the rows themselves meet it in a semi join, whose right side Spark broadcasts if it is small.
    """
    kept = series.groupBy(*DIMENSIONS).agg(predicate.alias("_kept")).where("_kept").select(*DIMENSIONS)
    return null_safe_join(series, kept, DIMENSIONS, "left_semi")


def filter_rows(frame: DataFrame, function: Callable[..., pa.Array], *columns: str) -> DataFrame:
    """Keep the rows for which a function of the caller's holds (null counts as no).

    The function gets ``columns`` as Arrow arrays of one batch and gives an Arrow array of booleans: it is called once a
    batch, not once a row. A list column comes as a list array, whose values and offsets are whole vectors.
    """
    return frame.where(F.coalesce(F.arrow_udf(function, "boolean")(*[F.col(c) for c in columns]), F.lit(False)))


def dimension_predicate(wanted: Mapping[str, str | None], ignore_null: bool = False) -> Column:
    """All ``dimension = value`` pairs hold; an empty mapping holds everywhere.

    A null dimension never matches, nor does a null value asked for. With ``ignore_null`` a
    null dimension matches a null value.
    """
    unknown = [name for name in wanted if name not in DIMENSIONS]
    if unknown:
        raise ValueError(f"not a dimension: {', '.join(unknown)}")
    tests = [
        F.col(name).eqNullSafe(F.lit(value)) if ignore_null else F.col(name) == F.lit(value)
        for name, value in wanted.items()
    ]
    return reduce(Column.__and__, tests, F.lit(True))


def filter_by_dimensions(
    frame: DataFrame, wanted: Mapping[str, str | None], ignore_null: bool = False
) -> DataFrame:
    return frame.where(dimension_predicate(wanted, ignore_null))


def observations_at(frame: DataFrame, timestamp: float, around: float = 0.0) -> DataFrame:
    """Observations with ``timestamp - around <= t <= timestamp + around``.

    Chunks may be given instead: those outside the range are then left out by the scan, which
    a condition on single points cannot do. The bounds are made whole for that, as timestamps
    are; a comparison with fractions would not reach the scan.
    """
    # An infinite bound lies beyond every timestamp.
    least, most = -(1 << 63), (1 << 63) - 1
    first = min(max(timestamp - around, least), most)
    last = min(max(timestamp + around, least), most)
    if math.isnan(first) or math.isnan(last):
        raise ValueError("the range needs numbers")
    first, last = math.ceil(first), math.floor(last)
    if "points" in frame.columns:
        frame = frame.where((F.col("start") <= last) & (F.col("end") >= first))
    return observations(frame).where(F.col("timestamp").between(first, last))
