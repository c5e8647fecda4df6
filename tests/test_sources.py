"""Chunk tables, collections, range scans, records, extracts and the building of chunks."""

from __future__ import annotations

import math
import os
import random
import subprocess
import sys
import tempfile
from types import SimpleNamespace

import pytest
from conftest import scan_text
from pyspark.sql import functions as F

from tideline.functions.points import whole_div
from tideline.model import CHUNKS, DIMENSIONS, RECORDS
from tideline.operators import aggregates, filters, flatten, joining
from tideline.plans import tables
from tideline.sources import chunks as sources
from tideline.sources.build import build_chunks
from tideline.sources.extract import new_path, read_extract, shared_folder, write_extract


@pytest.fixture
def stored(spark, sf_dir):
    return tables.event_chunks(spark, sf_dir)


def test_predicates_reach_the_scan(stored):
    plan = scan_text(sources.query_chunks(stored, F.col("metric") == "error"))
    assert "EqualTo(metric,error)" in plan
    plan = scan_text(sources.query_chunks(stored, "metric = 'error'"))
    assert "EqualTo(metric,error)" in plan
    plan = scan_text(sources.query_series(stored, F.col("metric") == "error"))
    scans = [line for line in plan.splitlines() if line.startswith("PushedFilters")]
    assert scans and all("EqualTo(metric,error)" in line for line in scans)
    plan = scan_text(filters.filter_by_dimensions(stored, {"process": None}, ignore_null=True))
    assert "IsNull(process)" in plan or "EqualNullSafe(process" in plan


def test_ranges_reach_the_scan(stored):
    plan = scan_text(sources.scan_time_range(stored, 100, 200))
    assert "LessThanOrEqual(start,200)" in plan and "GreaterThanOrEqual(end,100)" in plan
    plan = scan_text(filters.observations_at(stored, 150.5, 10))
    assert "LessThanOrEqual(start,160)" in plan and "GreaterThanOrEqual(end,141)" in plan


def test_scans_read_what_they_need(stored):
    read = "ReadSchema: struct<{}>"
    assert read.format("points:array<struct<value:double>>") in scan_text(aggregates.mean(stored))
    assert read.format("points:array<struct<value:double>>") in scan_text(aggregates.minimum(stored))
    assert read.format("n_points:bigint") in scan_text(aggregates.count_observations(stored))
    assert "points" not in scan_text(aggregates.count_series(stored)).split("ReadSchema")[1].split("\n")[0]


def test_joining_moves_points_only_once_positions_are_known(stored):
    """Positions come from headers: only one of the scans reads points."""
    plan = scan_text(joining.join_chunks(stored))
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert sum("points:array" in s for s in schemas) == 1 < len(schemas)


def test_no_python_and_no_cross_join_in_plain_operators(stored):
    for frame in (
        joining.join_chunks(stored), joining.joined_points(stored), aggregates.slopes(stored),
        joining.series_summary(stored), flatten.to_dataframe(stored),
    ):
        plan = scan_text(frame)
        for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan


@pytest.fixture
def three(make_chunks):
    return make_chunks(
        ({"metric": "m"}, "a", [(10, 1), (20, 2)]),
        ({"metric": "m"}, "b", [(30, 3), (40, 4)]),
        ({"metric": "n"}, "c", [(35, 5)]),
    )


@pytest.mark.parametrize(
    "first, last, expected",
    [(0, 9, []), (41, 99, []), (30, 20, []), (20, 30, [20, 30]), (10, 40, [10, 20, 30, 35, 40]),
     (15, 35, [20, 30, 35]), (21, 29, [])],
)
def test_time_range(three, first, last, expected):
    found = sources.scan_time_range(three, first, last)
    assert sorted(r.timestamp for r in flatten.observations(found).collect()) == expected
    assert aggregates.count_observations(found).first().n_observations == len(expected)


def test_time_range_refuses_minus_one(three):
    for bounds in ((-1, 10), (10, -1)):
        with pytest.raises(ValueError):
            sources.scan_time_range(three, *bounds)


def _record(chunk_id, points=None, function_value=None, json=None, metric="m"):
    return (metric, "h", None, None, None, "g", chunk_id, 100, 205, points, function_value, json)


def test_records(spark):
    records = spark.createDataFrame([
        _record("points", [(100, 1.0), (205, 2.0)], 9.0),
        _record("points first", [(100, 1.0)], None, "[]"),
        _record("function", [], 7.5),
        _record("function, no array", None, 7.5),
        _record("nothing", []),
    ], RECORDS).withColumn("agent", F.lit("x"))
    series = sources.record_to_series(records)
    assert tuple(series.columns) == sources.CHUNK_COLUMNS
    found = {r.chunk_id: (r.n_points, [tuple(p) for p in r.points]) for r in series.collect()}
    assert found == {
        "points": (2, [(100, 1.0), (205, 2.0)]), "points first": (1, [(100, 1.0)]),
        "function": (1, [(152, 7.5)]), "function, no array": (1, [(152, 7.5)]), "nothing": (0, []),
    }


def test_records_lacking_columns(spark):
    records = spark.createDataFrame([_record("a", [(100, 1.0)])], RECORDS).drop(
        "host", "process", "function_value", "data_as_json"
    )
    row = sources.record_to_series(records).first()
    assert (row.host, row.process, row.n_points) == (None, None, 1)


@pytest.mark.parametrize("record", [_record("json", [], 7.5, "[]"), _record("bare", [(1, 1.0)], metric=None)])
def test_records_that_fail(spark, record):
    schema = RECORDS.simpleString()
    frame = spark.createDataFrame([record], schema)
    with pytest.raises(Exception, match="JSON|without metric"):
        sources.record_to_series(frame).collect()


def test_collections(three):
    collections = {"one": three.where("metric = 'm'"), "two": three.where("metric = 'n'")}
    aliases = {"both": "one, two", "broken": "one,three"}
    assert sources.scan_collections("one", collections, aliases).count() == 2
    assert sources.scan_collections("both", collections, aliases).count() == 3
    for name in ("three", "broken"):
        with pytest.raises(ValueError, match="three not found"):
            sources.scan_collections(name, collections, aliases)


def test_stored_collections_are_one_scan(spark, three):
    paths = {name: new_path(spark, name) for name in ("one", "two")}
    sources.write_chunks(three.where("metric = 'm'"), paths["one"])
    sources.write_chunks(three.where("metric = 'n'"), paths["two"])
    found = sources.read_collections(spark, "both", paths, {"both": "one,two"})
    assert sorted(r.chunk_id for r in found.collect()) == ["a", "b", "c"]
    assert scan_text(found).count("Scan parquet") == 2  # tree and detail of a single scan


def test_chunk_table_round_trip(spark, three):
    path = new_path(spark, "chunks")
    sources.write_chunks(three, path)
    found = sources.read_chunks(spark, path)
    assert [f.name for f in found.schema] == [f.name for f in CHUNKS]
    assert sorted(map(str, found.collect())) == sorted(map(str, three.collect()))
    with pytest.raises(Exception, match="already exists"):
        sources.write_chunks(three, path)


def test_chunk_tables_of_other_origin(spark, three):
    path = new_path(spark, "other")
    three.drop("n_points", "function_value", "ag", "process").withColumn("extra", F.lit(1)).write.parquet(path)
    found = sources.read_chunks(spark, path)
    assert found.columns == CHUNKS.names
    assert sorted(map(str, found.collect())) == sorted(map(str, three.collect()))


def test_tasks_need_no_installed_package(tmp_path):
    """Started elsewhere, with the package known to the driver only."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "elsewhere.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {root!r})\n"
        "from pyspark.sql import SparkSession\n"
        "import __spark_entry__ as entries\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "for name in ('delta_round_trip', 'udf_filter', 'convert_with'):\n"
        "    assert entries.queries()[name](spark, '/root/testdata/sf0.001').count() > 0\n"
        "print('all ran')\n"
    )
    environment = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_CONF_DIR")}
    environment["SPARK_CONF_DIR"] = str(tmp_path)  # no defaults, hence no shared folder either
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=environment, capture_output=True,
        text=True, timeout=300,
    )
    assert "all ran" in done.stdout, done.stderr[-3000:]


def test_extract_round_trip(spark, three):
    path = write_extract(three, new_path(spark, "extract"))
    found = read_extract(spark, path)
    assert sorted(map(str, found.collect())) == sorted(map(str, three.select(*found.columns).collect()))


def test_shared_folder_is_the_one_the_session_names(spark):
    def session(**settings):
        named = {f"spark.{k.replace('_', '.')}": v for k, v in settings.items()}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named.get(key, default)))

    named = session(checkpoint_dir="hdfs://shared/x/", master="spark://host:7077")
    assert shared_folder(named) == "hdfs://shared/x"
    assert new_path(named, "y").startswith("hdfs://shared/x/tideline-y-")
    assert shared_folder(session(master="spark://host:7077")) is None
    assert new_path(session(master="yarn"), "y") is None
    assert shared_folder(session(master="local[8]")).startswith(tempfile.gettempdir())
    assert shared_folder(spark) is not None


def test_converters(three):
    assert sources.convert_with(three, lambda df: df.select("chunk_id")).columns == ["chunk_id"]
    same = sources.convert_with(three.select("chunk_id"), lambda batches: batches, "chunk_id string")
    assert sorted(r.chunk_id for r in same.collect()) == ["a", "b", "c"]


def build_by_rule(rows, period_ms, max_points, slice_ms):
    """Chunks as {(metric, host, period, part, way): sorted points}."""
    periods = {}
    for metric, host, t, number, value in rows:
        periods.setdefault((metric, host, t // period_ms), []).append((t, number, value))
    chunks, copies = {}, {}
    for key, points in periods.items():
        sizes = {}
        for t, *_ in points:
            sizes[t // slice_ms] = sizes.get(t // slice_ms, 0) + 1
        for t, number, value in points:
            before = sum(n for s, n in sizes.items() if s < t // slice_ms)
            ways = math.ceil(sizes[t // slice_ms] / max_points)
            copy = copies[key, t, number, value] = copies.get((key, t, number, value), -1) + 1
            way = (number + copy // max_points) % ways
            chunks.setdefault((*key, before // max_points, way), []).append((t, number, value))
    return {k: [(t, v) for t, _, v in sorted(points)] for k, points in chunks.items()}


@pytest.mark.parametrize("max_points, slice_ms", [(10_000, 1000), (40, 1000), (7, 100), (1, 10)])
def test_building_splits_long_periods(spark, max_points, slice_ms):
    rng = random.Random(11)
    rows = []
    for i in range(2000):
        metric = "hot" if rng.random() < 0.6 else rng.choice(["a", "b"])
        host = None if metric == "hot" else rng.choice([None, "h"])
        burst = 50_000 if metric == "hot" and rng.random() < 0.3 else rng.randrange(-100_000, 100_000)
        rows.append((metric, host, burst, i, float(i)))
    # Copies of a single row, many more than a chunk may hold, and some of a few others.
    rows += [("hot", None, 50_000, 1, 1.0)] * 900 + rows[:40] * 2
    frame = spark.createDataFrame(
        rows, "metric string, host string, timestamp bigint, number bigint, value double"
    ).select("*", *[F.lit(None).cast("string").alias(d) for d in DIMENSIONS[2:]])
    chunks = build_chunks(frame, whole_div("timestamp", 60_000), ["number"], max_points, slice_ms)
    found = {}
    for r in chunks.collect():
        period, part, way = map(int, r.chunk_id.split("|")[-3:])
        points = [tuple(p) for p in r.points]
        found[(r.metric, r.host, period, part, way)] = points
        assert (r.start, r.end, r.n_points) == (points[0][0], points[-1][0], len(points))
    assert found == build_by_rule(rows, 60_000, max_points, slice_ms)
    assert chunks.select("chunk_id").distinct().count() >= len({k[0] for k in found})


def test_time_does_not_depend_on_the_session_zone(spark, sf_small):
    expected = tables.event_observations(spark, sf_small).agg(F.sum("timestamp")).first()[0]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        found = tables.event_observations(spark, sf_small).agg(F.sum("timestamp")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == expected


def test_without_a_shared_folder_chunks_are_derived(spark, sf_small, monkeypatch):
    stored = tables.event_chunks(spark, sf_small)
    monkeypatch.setattr(tables, "_written", {})
    monkeypatch.setattr(tables, "new_path", lambda spark, name: None)
    derived = tables.event_chunks(spark, sf_small)
    assert "events.parquet" in scan_text(derived)
    assert sorted(map(str, derived.collect())) == sorted(map(str, stored.collect()))


def test_stateless_operators_run_on_a_stream(spark, sf_small):
    """Filters, projections and explodes are the same expressions on a stream of chunk files."""
    stored = tables.event_chunks(spark, sf_small)
    path = stored.inputFiles()[0].rsplit("/", 1)[0]

    def work(chunks):
        some = filters.filter_by_dimensions(chunks, {"metric": "click"})
        return flatten.to_dataframe(sources.scan_time_range(some, 0, 1_705_000_000_000))

    stream = work(spark.readStream.schema(CHUNKS).parquet(path))
    query = stream.writeStream.format("memory").queryName("flat").trigger(availableNow=True).start()
    query.awaitTermination(60)
    found = spark.table("flat")
    assert found.count() > 0
    assert sorted(map(str, found.collect())) == sorted(map(str, work(stored).collect()))


def test_headers_follow_their_points(make_chunks):
    from tideline.functions.points import append_point, replace_points
    from tideline.operators.aggregates import count_observations
    from tideline.operators.filters import observations_at
    from tideline.sources.chunks import scan_time_range

    chunks = make_chunks(({"metric": "m"}, "a", [(10, 1.0), (20, 2.0), (30, 3.0)]))
    longer = replace_points(chunks, append_point(F.lit(1000).cast("bigint"), F.lit(4.0)))
    assert longer.select("start", "end", "n_points").first() == (10, 1000, 4)
    assert observations_at(longer, 1000).count() == 1
    assert scan_time_range(longer, 900, 2000).select("start", "end", "n_points").first() == (1000, 1000, 1)
    assert observations_at(longer, 0, float("inf")).count() == 4
    assert count_observations(longer.drop("n_points")).first()[0] == 4


def test_read_chunks_of_unequal_schema(spark, make_chunks, tmp_path):
    from tideline.operators.aggregates import count_observations
    from tideline.sources.chunks import read_chunks

    make_chunks(({"metric": "m"}, "a", [(1, 1.0), (2, 2.0)])).write.parquet(str(tmp_path / "full"))
    make_chunks(({"metric": "n"}, "b", [(1, 1.0), (2, 2.0), (3, 3.0)])).drop("n_points", "host").write.parquet(str(tmp_path / "bare"))
    for order in (("full", "bare"), ("bare", "full")):
        assert count_observations(read_chunks(spark, *[str(tmp_path / p) for p in order])).first()[0] == 5


def test_codec_nulls(spark):
    from pyspark.errors import PythonException

    from tideline.functions.codec import delta_decode, delta_encode

    rows = spark.createDataFrame([(1000, [0, None, 60000, None, 5], [1.0] * 5)], "start bigint, offsets array<bigint>, values array<double>")
    assert delta_decode(rows).select("points.timestamp").first()[0] == [1000, 1010, 61010, 121010, 121015]
    bad = spark.createDataFrame([([(None, 1.0)],)], "points array<struct<timestamp:bigint,value:double>>")
    with pytest.raises(PythonException, match="missing"):
        delta_encode(bad).collect()


def test_records_are_read_as_points(spark, make_chunks, tmp_path):
    """Points, aggregates and empty records of one stored table: none is lost, whether chunks or series are asked for, and the
    predicate still reaches the scan."""
    chunks = make_chunks(
        ({"metric": "m"}, "a", [(10, 1), (20, 2)]), ({"metric": "m"}, "b", []), ({"metric": "m"}, "c", []), ({"metric": "m"}, "d", [(90, 9)]),
        ({"metric": "n", "host": "h"}, "e", []))
    bounds = {"b": (30, 51), "c": (60, 70), "e": (5, 5)}
    chunks = chunks.withColumns({
        column: F.coalesce(*[F.when(F.col("chunk_id") == k, F.lit(v[i]).cast("bigint")) for k, v in bounds.items()], F.col(column))
        for i, column in enumerate(("start", "end"))})
    # A value next to points is not read: the points say more.
    chunks = chunks.withColumn("function_value", F.when(F.col("chunk_id").isin("a", "b", "e"), 7.5))
    path = str(tmp_path / "records")
    sources.write_chunks(chunks, path)
    stored = sources.read_chunks(spark, path)
    found = {r.chunk_id: ([tuple(p) for p in r.points], r.start, r.end, r.n_points) for r in sources.query_chunks(stored).collect()}
    assert found == {"a": ([(10, 1.0), (20, 2.0)], 10, 20, 2), "b": ([(40, 7.5)], 40, 40, 1), "c": ([], 60, 70, 0),
                     "d": ([(90, 9.0)], 90, 90, 1), "e": ([(5, 7.5)], 5, 5, 1)}
    series = {r.metric: [tuple(p) for p in r.points] for r in sources.query_series(stored).collect()}
    assert series == {"m": [(10, 1.0), (20, 2.0), (40, 7.5), (90, 9.0)], "n": [(5, 7.5)]}
    asked = sources.query_series(stored, (F.col("metric") == "m") & (F.col("start") >= 30))
    assert [tuple(p) for p in asked.first().points] == [(40, 7.5), (90, 9.0)]
    plan = scan_text(asked)
    assert "EqualTo(metric,m)" in plan and "GreaterThanOrEqual(start,30)" in plan
    again = {r.chunk_id: r.n_points for r in sources.query_chunks(sources.query_chunks(stored)).collect()}
    assert again == {"a": 2, "b": 1, "c": 0, "d": 1, "e": 1}


def test_scan_is_sorted_within_partitions(spark, make_chunks):
    chunks = make_chunks(*[({"metric": f"m{k % 3}"}, f"c{(k * 37) % 101:03d}", [(k, k)]) for k in range(101)]).repartition(4)
    found = sources.scan_sorted_by_id(chunks).select("chunk_id", F.spark_partition_id().alias("part")).collect()
    parts = {}
    for r in found:
        parts.setdefault(r.part, []).append(r.chunk_id)
    assert len(found) == 101 and len(parts) > 1 and all(p == sorted(p) for p in parts.values())
    assert any(p != sorted(p) for p in ([r.chunk_id for r in chunks.collect()],))


def test_local_masters(spark):
    from tideline.sources.extract import is_local

    class Session:
        def __init__(self, master):
            self.conf = {"spark.master": master}

    assert is_local(spark) and is_local(Session("local")) and is_local(Session("local[3]"))
    assert not any(map(is_local, map(Session, ("local-cluster[3,2,1024]", "yarn", "spark://h:7077", ""))))
