"""The offset codec against its rules applied one point at a time."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.functions.codec import _offsets, _times, _within, delta_decode, delta_decode_range, delta_encode


def encode_by_rule(times, tolerance):
    """Offsets are the steps of the stored points. A point is stored if its step differs from the one before
    it by more than the tolerance, or if counting on from the last stored point overshoots it."""
    steps = [0 if not times[k - 1] else times[k] - times[k - 1] for k in range(1, len(times))]
    steps = [0] * bool(times) + steps
    stored = []
    for k, t in enumerate(times):
        base, passed = (times[stored[-1]], k - stored[-1]) if stored else (0, k + 1)
        jumps = abs(steps[k] - (steps[k - 1] if k else 0)) > tolerance
        if jumps or base + tolerance * passed - t > tolerance // 2:
            stored.append(k)
    return [steps[k] if k in set(stored) else 0 for k in range(len(times))]


def decode_by_rule(start, offsets, tolerance):
    times, step = [], tolerance
    for i, offset in enumerate(offsets):
        if i == 0:
            times.append(start)
            continue
        step = offset or step
        times.append(times[-1] + step)
    return times


STEPS = st.one_of(
    st.integers(0, 30), st.integers(-20, 20), st.integers(59_990, 60_010), st.sampled_from([0, 60_000])
)


def flat(lists):
    bounds = np.cumsum([0, *map(len, lists)])
    return np.array([n for one in lists for n in one], dtype=np.int64), bounds


def split(numbers, bounds):
    return [numbers[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


CHUNKS = st.lists(st.tuples(st.integers(0, 40), st.lists(STEPS, max_size=40)), max_size=6)


@settings(max_examples=500, deadline=None)
@given(CHUNKS, st.integers(0, 3), st.sampled_from([0, 1, 5, 10, 25]))
def test_encode_follows_the_rules(chunks, empty, tolerance):
    times = [np.cumsum([first, *steps]).tolist() for first, steps in chunks] + [[]] * empty
    numbers, bounds = flat(times)
    expected = [encode_by_rule(one, tolerance) for one in times]
    assert split(_offsets(numbers, bounds, tolerance), bounds) == expected


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 10**12), st.lists(st.integers(-5, 5), max_size=30)), max_size=6),
    st.sampled_from([0, 10]),
)
def test_decode_follows_the_rules(chunks, tolerance):
    numbers, bounds = flat([offsets for _, offsets in chunks])
    starts = np.array([start for start, _ in chunks], dtype=np.int64)
    expected = [decode_by_rule(start, offsets, tolerance) for start, offsets in chunks]
    assert split(_times(starts, numbers, bounds, tolerance), bounds) == expected


def test_decode_example(spark):
    encoded = spark.createDataFrame(
        [("a", 1000, [0, 0, 60_000, 0, 5], [1.0, 2.0, 3.0, 4.0, 5.0]), ("b", 7, [], [])],
        "chunk_id string, start bigint, offsets array<bigint>, values array<double>",
    )
    found = {r.chunk_id: [tuple(p) for p in r.points] for r in delta_decode(encoded).collect()}
    assert found == {
        "a": [(1000, 1.0), (1010, 2.0), (61_010, 3.0), (121_010, 4.0), (121_015, 5.0)], "b": [],
    }


def test_round_trip_of_regular_series_is_exact_and_small(make_chunks):
    points = [(1_700_000_000_000 + 60_000 * i, i) for i in range(500)]
    encoded = delta_encode(make_chunks(({"metric": "m"}, "a", points), ({"metric": "m"}, "b", [])))
    kept = encoded.select("chunk_id", F.size(F.filter("offsets", lambda o: o != 0)).alias("n"))
    assert {r.chunk_id: r.n for r in kept.collect()} == {"a": 1, "b": 0}
    decoded = {r.chunk_id: [tuple(p) for p in r.points] for r in delta_decode(encoded).collect()}
    assert decoded == {"a": [(t, float(v)) for t, v in points], "b": []}


def test_encoding_is_lossy_on_jitter(make_chunks):
    """Offsets within the tolerance are dropped, and what they were off by adds up."""
    points = [(1_700_000_000_000 + 60_000 * i + (i * 7) % 10, i) for i in range(60)]
    decoded = delta_decode(delta_encode(make_chunks(({"metric": "m"}, "a", points)))).first()
    errors = [abs(p.timestamp - t) for p, (t, _) in zip(decoded.points, points)]
    assert 10 < max(errors) < 1000
    assert [p.value for p in decoded.points] == [float(v) for _, v in points]


def test_missing_points_are_skipped(spark):
    chunks = spark.sql(
        "SELECT 'a' AS chunk_id, 100L AS start, array(named_struct('timestamp', 100L, 'value', 1D),"
        " NULL, named_struct('timestamp', 200L, 'value', 2D)) AS points"
    )
    row = delta_encode(chunks).first()
    assert (list(row.offsets), list(row["values"])) == ([0, 100], [1.0, 2.0])


def test_negative_tolerance_is_an_error(make_chunks):
    chunks = make_chunks(({"metric": "m"}, "a", []))
    with pytest.raises(ValueError):
        delta_encode(chunks, tolerance=-1)
    with pytest.raises(ValueError):
        delta_decode(chunks, tolerance=-1)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 200), st.lists(st.integers(-5, 40), max_size=30)), max_size=6),
    st.integers(-50, 400), st.integers(-50, 400),
)
def test_range_is_decode_then_filter(chunks, first, last):
    numbers, bounds = flat([offsets for _, offsets in chunks])
    starts = np.array([start for start, _ in chunks], dtype=np.int64)
    times = _times(starts, numbers, bounds, 10)
    kept, cut = _within(times, bounds, first, last)
    expected = [[t for t in decode_by_rule(start, offsets, 10) if first <= t <= last] for start, offsets in chunks]
    assert split(times[kept], cut) == expected


def test_range_decode(spark):
    encoded = spark.createDataFrame(
        [("a", 1000, 121_015, [0, 0, 60_000, 0, 5], [1.0, 2.0, 3.0, 4.0, 5.0]), ("b", 7, 7, [], []), ("c", 5000, 5020, [0, None, 0], [1.0, None]),
         ("d", 900_000, 900_000, [0], [1.0]), ("e", 2000, 2010, None, None)],
        "chunk_id string, start bigint, end bigint, offsets array<bigint>, values array<double>",
    )
    whole = {r.chunk_id: ([tuple(p) for p in r.points or []], r.start, r.end) for r in delta_decode(encoded).collect()}
    for first, last in ((1000, 121_015), (1010, 61_010), (0, 10**12), (5005, 5015), (999, 999), (130_000, 899_999), (7, 7)):
        found = {r.chunk_id: [tuple(p) for p in r.points] for r in delta_decode_range(encoded, first, last).collect()}
        expected = {k: [p for p in points if first <= p[0] <= last] for k, (points, start, end) in whole.items() if start <= last and end >= first}
        assert found == expected
    assert delta_decode_range(encoded, 10, 5).count() == 0
    for first, last in ((-1, 5), (0, -1)):
        with pytest.raises(ValueError):
            delta_decode_range(encoded, first, last)
    with pytest.raises(ValueError):
        delta_decode_range(encoded, 0, 1, tolerance=-1)
    sizes = {r.chunk_id: (r.n_points, len(r.points)) for r in delta_decode_range(encoded, 1010, 61_010).collect()}
    assert sizes["a"] == (2, 2)


def test_range_decode_prunes_chunks(spark, make_chunks, tmp_path):
    from conftest import scan_text

    path = str(tmp_path / "encoded")
    delta_encode(make_chunks(({"metric": "m"}, "a", [(10, 1), (20, 2)]), ({"metric": "m"}, "b", [(500, 1)]))).write.parquet(path)
    plan = scan_text(delta_decode_range(spark.read.parquet(path), 5, 15))
    assert "LessThanOrEqual(start,15)" in plan and "GreaterThanOrEqual(end,5)" in plan
