"""Joining, ordering, filters, aggregates and identity, on hand-made and generated series."""

from __future__ import annotations

import math
import random

import pytest
from conftest import scan_text
from pyspark.sql import functions as F

from tideline.model import DIMENSIONS, FLAT_COLUMNS
from tideline.operators import aggregates, filters, flatten, identity, joining, ordering
from tideline.plans import tables


def by_series(frame):
    """Points per identity in the order of ``pos``."""
    found = {}
    for r in frame.collect():
        found.setdefault(tuple(r[d] for d in DIMENSIONS), []).append((r.pos, r.timestamp, r.value))
    for points in found.values():
        points.sort()
        assert [p[0] for p in points] == list(range(len(points)))
    return {k: [(t, v) for _, t, v in points] for k, points in found.items()}


def join_by_rule(rows):
    """Chunks of one identity by start, then id, points one after the other."""
    found = {}
    ordered = sorted(rows, key=lambda r: (min([t for t, _ in r[2]], default=0), r[1]))
    for dimensions, _, points in ordered:
        found.setdefault(tuple(dimensions.get(d) for d in DIMENSIONS), []).extend(
            (t, float(v)) for t, v in points
        )
    return {k: v for k, v in found.items() if v}


@pytest.fixture(scope="module")
def skewed_rows():
    """One series with most of the chunks, some of equal start, some empty, some unsorted."""
    rng = random.Random(7)
    rows = []
    for i in range(300):
        hot = rng.random() < 0.7
        dimensions = {"metric": "hot"} if hot else {
            "metric": rng.choice(["a", "b"]), "process": rng.choice([None, "p"]),
        }
        start = rng.randrange(0, 40) * 43_200_000
        points = [(start, i)] + [
            (start + rng.randrange(0, 5000), rng.random()) for _ in range(rng.randrange(0, 30))
        ]
        rows.append((dimensions, f"c{i:03d}", points if rng.random() < 0.95 else []))
    return rows


@pytest.mark.parametrize(
    "max_points, periods_ms",
    [(1, (86_400_000, 60_000)), (50, (10**12, 10**9, 10**6)), (50, (10**15,)),
     (100_000, (86_400_000, 60_000)), (100_000, ())],
)
def test_join_is_whole_whatever_the_bounds(make_chunks, skewed_rows, max_points, periods_ms):
    series = joining.join_chunks(make_chunks(*skewed_rows), max_points, periods_ms)
    assert by_series(joining.indexed_points(series)) == join_by_rule(skewed_rows)


def test_join_bounds_its_rows(make_chunks, skewed_rows):
    series = joining.join_chunks(make_chunks(*skewed_rows), max_points=100)
    longest = max(len(points) for *_, points in skewed_rows)
    sizes = [r.n_points for r in series.select("n_points").collect()]
    assert max(sizes) < 100 + longest
    assert sum(sizes) == sum(len(points) for *_, points in skewed_rows)


def test_join_gives_one_row_per_series_within_the_bound(make_chunks, skewed_rows):
    chunks = make_chunks(*skewed_rows)
    series = joining.join_chunks(chunks)
    identities = [tuple(r) for r in series.select(*DIMENSIONS).collect()]
    assert len(identities) == len(set(identities))
    assert len(identities) == aggregates.count_series(chunks).first().n_series
    assert chunks.count() >= len(identities)


def test_joins_hold_without_broadcasts(spark, make_chunks, skewed_rows):
    """The plan of a large cluster: every join sorts and merges."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for name in names:
            spark.conf.set(name, "-1")
        series = joining.join_chunks(make_chunks(*skewed_rows), 50)
        assert by_series(joining.indexed_points(series)) == join_by_rule(skewed_rows)
    finally:
        for name in names:
            spark.conf.unset(name)


@pytest.mark.parametrize("max_points", [60, 100_000])
def test_joining_joined_data_changes_nothing(make_chunks, skewed_rows, max_points):
    once = joining.join_chunks(make_chunks(*skewed_rows), max_points)
    twice = joining.join_chunks(once, max_points)
    assert twice.count() == once.count()
    assert by_series(joining.indexed_points(twice)) == join_by_rule(skewed_rows)


def test_positions_without_joining(make_chunks, skewed_rows):
    assert by_series(joining.joined_points(make_chunks(*skewed_rows))) == join_by_rule(skewed_rows)


def test_rows_of_one_id_are_all_kept(make_chunks):
    row = ({"metric": "m"}, "same", [(10, 1), (20, 2)])
    series = joining.join_chunks(make_chunks(row, row, ({"metric": "m"}, "z", [(30, 3)])))
    points = series.first().points
    assert sorted(tuple(p) for p in points) == [
        (10, 1.0), (10, 1.0), (20, 2.0), (20, 2.0), (30, 3.0),
    ]


def test_equal_starts_go_by_id(make_chunks):
    chunks = make_chunks(({"metric": "m"}, "b", [(10, 2)]), ({"metric": "m"}, "a", [(10, 1), (5, 0)]))
    moved = chunks.withColumn("start", F.lit(5).cast("bigint"))
    assert [p.value for p in joining.join_chunks(moved).first().points] == [1.0, 0.0, 2.0]


def test_summary_is_positional(make_chunks, skewed_rows):
    expected = {
        k: (points[0][0], points[-1][0], len(points)) for k, points in join_by_rule(skewed_rows).items()
    }
    found = {
        tuple(r[d] for d in DIMENSIONS): (r.series_start, r.series_end, r.n_points)
        for r in joining.series_summary(make_chunks(*skewed_rows)).collect()
    }
    assert found == expected


def test_summary_of_an_empty_series(make_chunks):
    row = joining.series_summary(make_chunks(({"metric": "m"}, "a", []))).first()
    assert (row.n_chunks, row.series_start, row.series_end, row.n_points) == (1, 0, 0, 0)


def test_stored_chunks_hold_their_invariants(spark, sf_dir):
    """Points of a chunk lie within its bounds in strictly rising order."""
    chunks = tables.event_chunks(spark, sf_dir)
    times = F.col("points.timestamp")
    inside = F.forall(times, lambda t: t.between(F.col("start"), F.col("end")))
    rising = F.forall(F.sequence(F.lit(0), F.size(times) - 2), lambda i: (
        F.get(times, i + 1) > F.get(times, i)
    ))
    assert chunks.where(~inside).count() == 0
    assert chunks.where((F.size(times) > 1) & ~rising).count() == 0
    assert chunks.where(F.col("n_points") != F.size("points")).count() == 0


def test_order_puts_missing_first(make_chunks):
    chunks = make_chunks(
        ({"metric": "m"}, "b", [(20, 1)]), ({"metric": "m"}, "c", [(10, 1)]),
        ({"metric": "m"}, "a", [(20, 1)]), ({"metric": "m"}, "e", []),
    ).withColumn("start", F.when(F.col("chunk_id") == "b", None).otherwise(F.col("start")))
    assert [r.chunk_id for r in ordering.order_series(chunks).collect()] == ["b", "e", "c", "a"]


@pytest.mark.parametrize("periods_ms", [(500, 50), (1000,), (86_400_000, 60_000), ()])
def test_overlaps_against_all_pairs(make_chunks, periods_ms):
    rng = random.Random(3)
    rows = []
    for i in range(120):
        start = rng.randrange(0, 2000)
        dimensions = {"metric": "hot"} if i % 4 else {"metric": "cold", "host": None}
        rows.append((dimensions, f"c{i:03d}", [(start, 0), (start + rng.randrange(0, 120), 0)]))
    expected = {}
    for dims_b, right, points_b in rows:
        earlier = [
            (points_a[1][0], points_a[0][0], left)
            for dims_a, left, points_a in rows
            if dims_a == dims_b and points_a[0][0] < points_b[0][0] <= points_a[1][0]
        ]
        if earlier:
            expected[right] = max(earlier)
    found = ordering.chunk_overlaps(make_chunks(*rows), periods_ms).collect()
    assert {r.right_id: (r.left_end, r.left_start, r.left_id) for r in found} == expected
    assert len(found) == len(expected)


def test_touching_chunks_overlap_and_equal_starts_do_not(make_chunks):
    chunks = make_chunks(
        ({"metric": "m"}, "a", [(0, 0), (10, 0)]), ({"metric": "m"}, "b", [(10, 0), (20, 0)]),
        ({"metric": "m"}, "c", [(21, 0)]), ({"metric": "m"}, "d", [(21, 0)]),
        ({"metric": "n"}, "e", [(5, 0)]),
    )
    found = [(r.left_id, r.right_id) for r in ordering.chunk_overlaps(chunks).collect()]
    assert found == [("a", "b")]


@pytest.mark.parametrize(
    "dimension, wanted, strict, null_safe",
    [("p", "p", True, True), ("p", "q", False, False), ("p", None, False, False),
     (None, "p", False, False), (None, None, False, True)],
)
def test_dimension_filter_truth_table(make_chunks, dimension, wanted, strict, null_safe):
    chunks = make_chunks(({"metric": "m", "process": dimension}, "a", []))
    passes = filters.filter_by_dimensions(chunks, {"process": wanted}).count() == 1
    passes_null_safe = filters.filter_by_dimensions(chunks, {"process": wanted}, True).count() == 1
    assert (passes, passes_null_safe) == (strict, null_safe)


def test_dimension_filter_edges(make_chunks):
    chunks = make_chunks(({"metric": "m", "group": "g"}, "a", []))
    assert filters.filter_by_dimensions(chunks, {}).count() == 1
    assert filters.filter_by_dimensions(chunks, {"metric": "m", "group": "g"}).count() == 1
    assert filters.filter_by_dimensions(chunks, {"metric": "m", "group": "x"}).count() == 0
    with pytest.raises(ValueError):
        filters.filter_by_dimensions(chunks, {"rack": "r"})


@pytest.mark.parametrize(
    "at, around, expected",
    [(20, 0, [20]), (20, 10, [10, 20, 30]), (20.5, 0, []), (15, 5.9, [10, 20]), (99, 1, [])],
)
def test_observations_at(make_chunks, at, around, expected):
    chunks = make_chunks(({"metric": "m"}, "a", [(10, 1), (20, 2)]), ({"metric": "m"}, "b", [(30, 3)]))
    for frame in (chunks, flatten.observations(chunks)):
        found = filters.observations_at(frame, at, around).collect()
        assert sorted(r.timestamp for r in found) == expected


def test_flat_frames(make_chunks):
    chunks = make_chunks(
        ({"metric": "m", "host": "h"}, "a", [(1000, 1), (2000, 2)]), ({"metric": "m"}, "b", [])
    )
    frame = flatten.to_dataframe(chunks)
    assert tuple(frame.columns) == FLAT_COLUMNS
    assert frame.count() == 2
    assert flatten.observations_dataset(chunks).count() == 2
    assert sorted(r.value for r in flatten.values(chunks).collect()) == [1.0, 2.0]
    assert frame.select("value", "process").where("host = 'h'").count() == 2


def test_aggregates_agree_on_chunks_series_and_observations(make_chunks, skewed_rows):
    chunks = make_chunks(*skewed_rows)
    everything = [v for *_, points in skewed_rows for _, v in points]
    for frame in (chunks, joining.join_chunks(chunks), flatten.observations(chunks)):
        assert math.isclose(aggregates.mean(frame).first().mean, sum(everything) / len(everything))
        assert math.isclose(
            aggregates.approx_mean(frame).first().approx_mean, sum(everything) / len(everything)
        )
        assert aggregates.minimum(frame).first()["min"] == min(everything)
        assert aggregates.maximum(frame).first()["max"] == max(everything)
        assert aggregates.count_observations(frame).first().n_observations == len(everything)


def test_aggregates_of_nothing(make_chunks):
    chunks = make_chunks(({"metric": "m"}, "a", []))
    assert aggregates.mean(chunks).first().mean is None
    assert aggregates.minimum(chunks).first()["min"] is None
    assert aggregates.count_observations(chunks).first().n_observations == 0
    assert aggregates.count_observations(chunks.where("false")).first().n_observations == 0
    assert aggregates.count_series(chunks).first().n_series == 1


def test_nan_is_the_largest_value(make_chunks):
    chunks = make_chunks(({"metric": "m"}, "a", [(1, 1), (2, float("nan")), (3, -4)]))
    for frame in (chunks, flatten.observations(chunks)):
        assert math.isnan(aggregates.maximum(frame).first()["max"])
        assert aggregates.minimum(frame).first()["min"] == -4.0


def test_slopes(make_chunks):
    start = 1_700_000_000_000
    chunks = make_chunks(
        ({"metric": "up"}, "a", [(start + i * 1000, 5 + 2 * i) for i in range(50)]),
        ({"metric": "up"}, "b", [(start + i * 1000, 5 + 2 * i) for i in range(50, 80)]),
        ({"metric": "one"}, "c", [(start, 1)]),
        ({"metric": "still"}, "d", [(start, 1), (start, 2)]),
    )
    found = {r.metric: r.slope for r in aggregates.slopes(chunks).collect()}
    assert math.isclose(found["up"], 0.002, rel_tol=1e-9)
    assert math.isnan(found["one"]) and math.isnan(found["still"])
    per_chunk = aggregates.slopes(chunks, by=[*DIMENSIONS, "chunk_id"])
    assert per_chunk.count() == 4


def test_take_and_collect(make_chunks):
    chunks = make_chunks(*[({"metric": f"m{i}"}, f"c{i}", [(i, i)]) for i in (3, 1, 2)])
    assert [r.metric for r in aggregates.take_series(chunks, 2).collect()] == ["m1", "m2"]
    assert [r.metric for r in aggregates.collect_series(chunks)] == ["m1", "m2", "m3"]
    assert [r.chunk_id for r in aggregates.take_chunks(chunks, 2).collect()] == ["c1", "c2"]


@pytest.mark.parametrize("bound", [1, 7, 60, 100_000])
def test_taking_whole_series_under_any_row_bound(make_chunks, bound):
    chunks = make_chunks(*[
        ({"metric": m, "host": h}, f"{m}{h}{k}", [(10 * k + i, i) for i in range(10)])
        for m in ("a", "b", "c") for h in ("x", None) for k in range(3)
    ])
    series = joining.join_chunks(chunks, bound)
    taken = aggregates.take_series(series, 3)
    assert {(r.metric, r.host) for r in taken.collect()} == {("a", None), ("a", "x"), ("b", None)}
    found = [(r.metric, r.host, p.timestamp) for r in aggregates.collect_series(taken) for p in r.points]
    assert found == [(m, h, t) for m, h in (("a", None), ("a", "x"), ("b", None)) for t in range(30)]


def test_identity(make_chunks):
    chunks = make_chunks(
        ({"metric": "m", "host": None}, "a", [(10, 1)]), ({"metric": "m", "host": None}, "b", [(5, 1)]),
        ({"metric": "m", "host": "h"}, "c", [(5, 1)]), ({"metric": "n"}, "d", [(1, 1)]),
    )
    other = make_chunks(({"metric": "n", "host": "elsewhere"}, "e", [(1, 1)]))
    assert identity.series_key(chunks).count() == 3
    metrics = {r.metric: (r.host, r.series_start) for r in identity.distinct_metrics(chunks).collect()}
    assert metrics == {"m": (None, 5), "n": (None, 1)}
    assert [r.metric for r in identity.intersect_series(chunks, other).collect()] == ["n"]
    assert sorted(r.chunk_id for r in identity.subtract_series(chunks, other).collect()) == ["a", "b", "c"]
    assert identity.union_series(chunks, other, chunks).count() == 9


def test_distinct_observations(make_chunks):
    chunks = make_chunks(
        ({"metric": "m"}, "a", [(1, float("nan")), (2, 2)]), ({"metric": "m"}, "b", [(1, float("nan")), (2, 3)]),
        ({"metric": "m", "host": "h"}, "c", [(2, 2)]),
    )
    assert identity.distinct_observations(flatten.observations(chunks)).count() == 4


@pytest.mark.parametrize("bound", [3, 50, 100_000])
def test_sorted_points_across_rows(make_chunks, skewed_rows, bound):
    """Points are in time order along the series, however many rows it is cut into."""
    got = by_series(joining.sorted_points(joining.join_chunks(make_chunks(*skewed_rows), bound)))
    expected = {k: sorted(v, key=lambda p: p[0]) for k, v in join_by_rule(skewed_rows).items()}
    assert got == expected


# Whole series, whatever the bound on their rows

BOUNDS = [1, 3, 50, 100_000]


@pytest.mark.parametrize("bound", BOUNDS)
def test_filter_whole_series_under_any_row_bound(make_chunks, skewed_rows, bound):
    whole = join_by_rule(skewed_rows)
    identities = {tuple(d.get(k) for k in DIMENSIONS) for d, *_ in skewed_rows}
    series = joining.join_chunks(make_chunks(*skewed_rows), bound)
    cases = [
        (filters.any_point(lambda p: p["value"] > 270), lambda v: any(x > 270 for _, x in v)),
        (filters.every_point(lambda p: p["value"] < 299), lambda v: all(x < 299 for _, x in v)),
        (filters.total_points() > 700, lambda v: len(v) > 700),
        (filters.total_value(lambda v: v) > 10_000, lambda v: sum(x for _, x in v) > 10_000),
        (filters.any_point(lambda p: p["value"] > 270) & (filters.total_points() < 700), lambda v: any(x > 270 for _, x in v) and len(v) < 700),
    ]
    for predicate, rule in cases:
        kept = filters.filter_whole_series(series, predicate)
        assert kept.columns == series.columns
        expected = {k: v for k in identities if rule(v := whole.get(k, [])) and v}
        assert 0 < len(expected) and by_series(joining.indexed_points(kept)) == expected


def test_filter_whole_series_takes_nulls_for_no(make_chunks):
    chunks = make_chunks(({"metric": "a"}, "a", [(1, 1)]), ({"metric": "a"}, "b", []), ({"metric": "b", "host": "h"}, "c", []))
    found = lambda p: sorted(r.chunk_id for r in filters.filter_whole_series(chunks, p).collect())
    assert found(F.lit(None).cast("boolean")) == []
    assert found(filters.every_point(lambda p: p["value"] > 5)) == ["c"]
    assert found(filters.any_point(lambda p: p["value"] > 0)) == ["a", "b"]
    assert found(filters.any_point(lambda p: F.lit(None).cast("boolean"))) == []
    assert found(filters.total_points() == 0) == ["c"]
    missing = chunks.withColumn("points", F.when(F.col("chunk_id") == "b", None).otherwise(F.col("points")))
    assert sorted(r.chunk_id for r in filters.filter_whole_series(missing, filters.any_point(lambda p: p["value"] > 0)).collect()) == ["a", "b"]


@pytest.mark.parametrize("bound", [None, *BOUNDS])
def test_points_at_under_any_row_bound(make_chunks, skewed_rows, bound):
    chunks = make_chunks(*skewed_rows)
    whole = join_by_rule(skewed_rows)
    longest = max(map(len, whole.values()))
    asked = [-1, 0, 1, 17, 40, longest - 1, longest, 10**12, 17]
    found = joining.points_at(chunks if bound is None else joining.join_chunks(chunks, bound), asked)
    identities = {tuple(d.get(k) for k in DIMENSIONS) for d, *_ in skewed_rows}
    expected = {(k, p): whole.get(k, [])[p] if 0 <= p < len(whole.get(k, [])) else (None, None) for k in identities for p in asked}
    rows = found.collect()
    assert {(tuple(r[d] for d in DIMENSIONS), r.pos): (r.timestamp, r.value) for r in rows} == expected
    assert len(rows) == len(expected) and joining.points_at(chunks, []).count() == 0


def test_points_at_rows_of_one_id(make_chunks):
    row = ({"metric": "m"}, "same", [(10, 1), (20, 2)])
    chunks = make_chunks(row, row, ({"metric": "m"}, "z", [(30, 3)]))
    joined = [tuple(p) for p in joining.join_chunks(chunks).first().points]
    found = {r.pos: (r.timestamp, r.value) for r in joining.points_at(chunks, range(6)).collect()}
    assert found == {**dict(enumerate(joined)), 5: (None, None)}


def test_points_at_reads_points_only_where_they_are(spark, sf_small):
    """The positions come from headers; points are scanned once, without indexing any."""
    plan = scan_text(joining.points_at(tables.event_chunks(spark, sf_small), [0, 5]))
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert len(schemas) >= 2 and sum("points:array" in line for line in schemas) == 1


@pytest.mark.parametrize("periods_ms", [(500, 50), (1000,), (86_400_000, 60_000), ()])
def test_overlap_counts_against_all_pairs(make_chunks, periods_ms):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        start = rng.randrange(0, 900)
        dimensions = {"metric": "hot"} if i % 4 else {"metric": "cold", "host": None}
        rows.append((dimensions, f"c{i:03d}", [(start, 0), (start + rng.randrange(0, 200), 0)]))
    expected = {
        b: sum(1 for d, _, p in rows if d == dims and p[0][0] < points[0][0] <= p[1][0]) for dims, b, points in rows
    }
    found = ordering.overlap_counts(make_chunks(*rows), periods_ms).collect()
    assert {r.chunk_id: r.n_earlier for r in found} == expected and len(found) == len(rows)
    listed = {r.right_id for r in ordering.chunk_overlaps(make_chunks(*rows), periods_ms).collect()}
    assert listed == {k for k, n in expected.items() if n}


def test_sampled_series_are_whole_and_repeat(make_chunks, skewed_rows):
    rows = [({"metric": f"m{k % 60}", "host": None if k % 2 else "h"}, f"c{k}", [(k, k)]) for k in range(240)]
    chunks = make_chunks(*rows)
    taken = {r.chunk_id for r in identity.sample_series(chunks, 0.4, 3).collect()}
    assert taken == {r.chunk_id for r in identity.sample_series(chunks.repartition(7), 0.4, 3).collect()}
    by_identity = {}
    for d, c, _ in rows:
        by_identity.setdefault((d["metric"], d["host"]), set()).add(c in taken)
    assert all(len(v) == 1 for v in by_identity.values())
    assert 0.2 < sum(v == {True} for v in by_identity.values()) / len(by_identity) < 0.6
    assert taken != {r.chunk_id for r in identity.sample_series(chunks, 0.4, 4).collect()}
    assert identity.sample_series(chunks, 0.0).count() == 0 and identity.sample_series(chunks, 1.0).count() == 240
    with pytest.raises(ValueError):
        identity.sample_series(chunks, 1.5)


@pytest.mark.parametrize("bound", [3, 100_000])
@pytest.mark.parametrize("ascending", [True, False])
def test_sort_series(make_chunks, skewed_rows, bound, ascending):
    series = joining.join_chunks(make_chunks(*skewed_rows), bound)
    rows = ordering.sort_series(series, F.sum("n_points"), ascending).collect()
    assert len(rows) == series.count()
    sizes = [(r.sort_key, tuple(r[d] or "" for d in DIMENSIONS), r.first_pos) for r in rows]
    assert sizes == sorted(sizes, key=lambda r: (r[0] if ascending else -r[0], *r[1:]))
    whole = join_by_rule(skewed_rows)
    assert all(r.sort_key == len(whole.get(tuple(r[d] for d in DIMENSIONS), [])) for r in rows)


def test_take_joined(make_chunks, skewed_rows):
    chunks = make_chunks(*skewed_rows)
    for bound in (3, 100_000):
        rows = lambda f: [(*[r[d] for d in DIMENSIONS], r.first_pos, r.points) for r in f.collect()]
        assert rows(aggregates.take_joined(chunks, 3, bound)) == rows(aggregates.take_series(joining.join_chunks(chunks, bound), 3))


def test_sampled_mean_holds_its_interval(make_chunks):
    """Over many seeds the exact mean lies within the error about as often as 95 in 100 times."""
    rng = random.Random(9)
    rows = [({"metric": f"m{k % 7}"}, f"c{k}", [(i, rng.gauss(k % 13, 5)) for i in range(rng.randrange(0, 25))]) for k in range(500)]
    everything = [v for *_, points in rows for _, v in points]
    exact = sum(everything) / len(everything)
    chunks = make_chunks(*rows).cache()
    inside, shares = 0, []
    for seed in range(40):
        r = aggregates.sampled_mean(chunks, 0.3, seed).first()
        inside += abs(r["mean"] - exact) <= r.error
        shares.append(r.share_read)
        assert 0 < r.error < 2 and r.n_chunks < 250
    assert inside >= 34 and 0.2 < sum(shares) / 40 < 0.4
    full = aggregates.sampled_mean(chunks, 1.0).first()
    assert math.isclose(full["mean"], exact) and (full.error, full.share_read) == (0.0, 1.0)
    tight = aggregates.sampled_mean(chunks, 0.1, 1, most_error=0.0).first()
    assert math.isclose(tight["mean"], exact) and tight.error == 0.0


def test_sampled_mean_falls_back(make_chunks):
    few = aggregates.sampled_mean(make_chunks(({"metric": "m"}, "a", [(1, 1), (2, 5)]), ({"metric": "m"}, "b", [])), 0.01).first()
    assert (few["mean"], few.error, few.share_read, few.n_chunks) == (3.0, 0.0, 1.0, 1)
    none = aggregates.sampled_mean(make_chunks(({"metric": "m"}, "b", [])), 0.5).first()
    assert (none["mean"], none.error, none.n_chunks) == (None, 0.0, 0)
    with pytest.raises(ValueError):
        aggregates.sampled_mean(make_chunks(), 0.0)


def test_functions_on_batches(make_chunks):
    import pyarrow as pa
    import pyarrow.compute as pc

    from tideline.functions.points import values_array
    from tideline.plans.queries import SPREAD_LIMIT, _spread

    rows = [({"metric": "m"}, "a", [(1, 0), (2, SPREAD_LIMIT + 1)]), ({"metric": "m"}, "b", []), ({"metric": "m"}, "c", [(1, 5)]),
            ({"metric": "n"}, "d", [(1, 0), (2, SPREAD_LIMIT)]), ({"metric": "n"}, "e", [(3, -SPREAD_LIMIT), (1, 1)])]
    chunks = make_chunks(*rows)
    found = filters.filter_rows(chunks.withColumn("_values", values_array()), _spread, "_values")
    assert sorted(r.chunk_id for r in found.collect()) == ["a", "e"]
    lists = pa.array([[0.0, 1.0], None, [0.0, None, 99.0], [], [None], [7.0, 90.0], [1.0]], pa.list_(pa.float64()))
    assert _spread(lists).to_pylist() == [False, False, True, False, False, True, False]
    assert _spread(lists.slice(2, 3)).to_pylist() == [True, False, False]
    flat = filters.filter_rows(flatten.observations(chunks), lambda t, v: pc.and_(pc.greater(t, 1), pc.greater(v, 0)), "timestamp", "value")
    assert sorted((r.timestamp, r.value) for r in flat.collect()) == [(2, SPREAD_LIMIT), (2, SPREAD_LIMIT + 1)]
    plan = scan_text(flat)
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan
