"""Accessors and point expressions on small hand-made series."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tideline.functions import points as fp
from tideline.model import attribute, dimension_by_id, dimension_by_ordinal, dimension_label


def test_empty_series(make_chunks):
    row = make_chunks(({"metric": "m"}, "c", [])).select(
        fp.series_start().alias("start"), fp.series_end().alias("end"),
        fp.series_size().alias("size"), fp.series_is_empty().alias("empty"),
        fp.value_at(0).alias("value"), fp.time_at(0).alias("time"),
    ).first()
    assert tuple(row) == (0, 0, 0, True, None, None)


def test_bounds_are_positional(make_chunks):
    row = make_chunks(({"metric": "m"}, "c", [(30, 1), (10, 2), (20, 3)])).select(
        fp.series_start(), fp.series_end(), fp.value_at(1), fp.time_at(2), fp.series_is_empty()
    ).first()
    assert tuple(row) == (30, 20, 2.0, 20, False)


def test_sort_is_stable_and_leaves_short_series(make_chunks):
    chunks = make_chunks(
        ({"metric": "m"}, "a", [(5, 3), (1, 9), (5, 1), (5, 2), (1, 8)]),
        ({"metric": "m"}, "b", [(7, 1)]),
        ({"metric": "m"}, "c", []),
    )
    found = {r.chunk_id: [tuple(p) for p in r.points]
             for r in chunks.select("chunk_id", fp.sort_points().alias("points")).collect()}
    assert found == {
        "a": [(1, 9.0), (1, 8.0), (5, 3.0), (5, 1.0), (5, 2.0)], "b": [(7, 1.0)], "c": [],
    }


def test_append(make_chunks):
    chunks = make_chunks(({"metric": "m"}, "a", [(5, 3)]), ({"metric": "m"}, "b", []))
    longer = fp.replace_points(chunks, fp.append_point(F.lit(1), F.lit(2)))
    found = {r.chunk_id: (r.n_points, [tuple(p) for p in r.points]) for r in longer.collect()}
    assert found == {"a": (2, [(5, 3.0), (1, 2.0)]), "b": (1, [(1, 2.0)])}


def test_mid_time_truncates(spark):
    row = spark.range(1).select(
        fp.mid_time(F.lit(10), F.lit(15)), fp.mid_time(F.lit(10), F.lit(10)),
        fp.mid_time(F.lit(15), F.lit(10)),
    ).first()
    assert tuple(row) == (12, 10, 13)


def test_whole_div_rounds_down(spark):
    numbers = [-1001, -1000, -1, 0, 999, 1000, 9_007_199_254_740_993]
    rows = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    found = {r.n: r.d for r in rows.select("n", fp.whole_div("n", 1000).alias("d")).collect()}
    assert found == {n: n // 1000 for n in numbers}


def test_time_conversion(spark):
    row = spark.range(1).select(
        fp.millis_to_time(F.lit(1_704_067_200_123)).alias("time")
    ).select("time", fp.time_to_millis("time").alias("millis")).first()
    assert row.time == datetime.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert row.millis == 1_704_067_200_123


def test_dimension_lookup(make_chunks):
    assert [dimension_by_ordinal(i) for i in range(-1, 7)] == [
        None, "metric", "host", "measurement", "process", "ag", "group", None,
    ]
    assert dimension_by_id("ag") == "ag"
    assert dimension_by_id("rack") is None
    row = make_chunks(({"metric": "m", "host": "h", "group": "g"}, "c", [])).select(
        attribute("host"), attribute(5), attribute("rack"), attribute(9), dimension_label()
    ).first()
    assert tuple(row) == (
        "h", "g", None, None, "metric:mhost:hmeasurement:nullprocess:nullag:nullgroup:g",
    )
