"""Helpers shared by operators that work along a series: null-safe joins, running totals."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tideline.functions.points import whole_div

# Default periods for running totals, coarse to fine: a day, a minute.
PERIODS_MS = (86_400_000, 60_000)


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join on equal keys where null equals null. Keys are taken from the left side.

    Catalyst turns ``<=>`` into hash-join keys, so this plans like any equi-join. Whether the
    right side is broadcast is left to Spark, which checks its size.
    """
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(
        Column.__and__, (F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys)
    )
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def running_before(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    within: Callable[[WindowSpec], WindowSpec],
    total: Callable[[Column], Column],
    merge: Callable[[Column, Column], Column],
    value: str,
    name: str,
    periods_ms: Sequence[int] = PERIODS_MS,
) -> DataFrame:
    """Add ``name``: ``total`` of ``value`` over the rows of the same group that come earlier.

    A plain window over the group would sort a whole group in one task. The group is cut into
    periods of ``time`` instead: one aggregate per period, the running total over those (found
    the same way from the next coarser period), and a window inside each period. A group
    holding most of the rows is spread over as many tasks as it has periods, and no window
    sorts more than the rows of one fine period or the fine periods of one coarse period.

    ``within`` orders the rows of a period and sets the frame of earlier ones; ``merge`` joins
    the total of earlier periods with the one inside the period (either may be null).
    """
    if not periods_ms:
        earlier_rows = total(F.col(value)).over(within(Window.partitionBy(*keys)))
        return rows.withColumn(name, merge(F.lit(None), earlier_rows))
    *coarser, finest = periods_ms
    period, inside, before, subtotal = (
        f"_{part}_{len(periods_ms)}" for part in ("period", "inside", "before", "subtotal")
    )
    sliced = rows.withColumn(period, whole_div(time, finest) * finest)
    totals = sliced.groupBy(*keys, period).agg(total(F.col(value)).alias(subtotal))
    earlier_periods = running_before(
        totals, keys, period,
        lambda w: w.orderBy(period).rowsBetween(Window.unboundedPreceding, -1),
        total, merge, subtotal, before, coarser,
    ).drop(subtotal)
    earlier_rows = total(F.col(value)).over(within(Window.partitionBy(*keys, period)))
    return (
        null_safe_join(sliced.withColumn(inside, earlier_rows), earlier_periods, [*keys, period])
        .withColumn(name, merge(F.col(before), F.col(inside)))
        .drop(period, before, inside)
    )


def running_total(
    rows: DataFrame,
    keys: Sequence[str],
    time: str,
    order: Sequence[str],
    value: str,
    name: str,
    periods_ms: Sequence[int] = PERIODS_MS,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of the group, 0 for the first.

    ``order`` must begin with ``time`` and leave no ties.
    """
    return running_before(
        rows, keys, time,
        within=lambda w: w.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1),
        total=F.sum,
        merge=lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
        value=value, name=name, periods_ms=periods_ms,
    )
