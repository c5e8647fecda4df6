"""The registered queries as SQL on the same tables, for checking results with DuckDB.

Each statement starts from the given tables and states the result directly; none follows the
Spark plan. ``group``, ``end``, ``time`` and ``timestamp`` are SQL words and always quoted.
"""

from __future__ import annotations

from tideline.model import DIMENSIONS, MAX_CHUNK_POINTS
from tideline.plans import queries as q

_QUOTED = {"group": '"group"', "end": '"end"', "timestamp": '"timestamp"'}
DIMS = ", ".join(_QUOTED.get(d, d) for d in DIMENSIONS)
HEADER = f'{DIMS}, chunk_id, start, "end", n_points, hundredths, phase_ms'
_NAMES = ", ".join(f"coalesce({_QUOTED.get(d, d)}, '')" for d in DIMENSIONS)

_EVENT_OBSERVATIONS = """
SELECT event_id,
       event_type AS metric,
       'h' || (user_id % 10) AS host,
       'm' || (user_id % 10 % 2) AS measurement,
       CASE WHEN user_id % 10 % 3 <> 0 THEN 'p' || (user_id % 10 % 4) END AS process,
       CAST(NULL AS VARCHAR) AS ag,
       CASE WHEN event_type = 'error' THEN 'alert' ELSE 'usage' END AS "group",
       epoch_us(ts) // 1000 AS "timestamp",
       value
FROM events
"""

_LINEITEM_OBSERVATIONS = """
SELECT l_orderkey, l_linenumber, year(l_shipdate) AS ship_year,
       l_returnflag || l_linestatus AS metric,
       's' || l_suppkey AS host,
       CAST(NULL AS VARCHAR) AS measurement,
       CAST(NULL AS VARCHAR) AS process,
       CAST(NULL AS VARCHAR) AS ag,
       CAST(NULL AS VARCHAR) AS "group",
       epoch_us(l_shipdate) // 1000 AS "timestamp",
       l_extendedprice AS value
FROM lineitem
"""


def _chunked(name: str, period: str, tie: str, spread: str) -> str:
    """CTEs ``{name}_points`` (with chunk and position) and ``{name}_chunks`` (headers).

    A period holding more points than a chunk may is cut where a whole slice of a second
    starts past the bound; a slice that is itself too large is dealt out by ``spread``, and so
    are equal rows that are too many for one chunk.
    """
    way = f"({spread} + copy // {MAX_CHUNK_POINTS}) % ways"
    return f"""
{name}_cut AS (
  SELECT *, {period} AS period,
         coalesce(count(*) OVER (PARTITION BY {DIMS}, {period} ORDER BY "timestamp" // 1000
                  RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {MAX_CHUNK_POINTS} AS part,
         CAST(ceil(count(*) OVER (PARTITION BY {DIMS}, {period}, "timestamp" // 1000)
              / {MAX_CHUNK_POINTS}.0) AS BIGINT) AS ways,
         row_number() OVER (PARTITION BY {DIMS}, "timestamp", {tie}, value) - 1 AS copy
  FROM {name}_obs),
{name}_points AS (
  SELECT {DIMS}, concat_ws('|', {_NAMES}, period, part, {way}) AS chunk_id,
         row_number() OVER (PARTITION BY {DIMS}, period, part, {way}
                            ORDER BY "timestamp", {tie}, value) - 1 AS pos,
         "timestamp", value
  FROM {name}_cut),
{name}_chunks AS (
  SELECT {DIMS}, chunk_id, min("timestamp") AS start, max("timestamp") AS "end",
         count(*) AS n_points, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS mean_value,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS hundredths,
         CAST(sum("timestamp" % {q.MINUTE_MS}) AS BIGINT) AS phase_ms,
         max(value) AS max_value,
         min(value) AS min_value
  FROM {name}_points GROUP BY {DIMS}, chunk_id)"""


_EVENTS = (
    f"WITH obs AS ({_EVENT_OBSERVATIONS}), events_obs AS (FROM obs),"
    + _chunked("events", '"timestamp" // 86400000', "event_id", "event_id")
    + ", points AS (FROM events_points), chunks AS (FROM events_chunks)"
)
_LINEITEM = (
    f"WITH lineitem_obs AS ({_LINEITEM_OBSERVATIONS}),"
    + _chunked("lineitem", "ship_year", "l_orderkey, l_linenumber", "l_orderkey")
    + ", points AS (FROM lineitem_points), chunks AS (FROM lineitem_chunks)"
)
_BOTH = (
    f"WITH events_obs AS ({_EVENT_OBSERVATIONS}), lineitem_obs AS ({_LINEITEM_OBSERVATIONS}),"
    + _chunked("events", '"timestamp" // 86400000', "event_id", "event_id") + ","
    + _chunked("lineitem", "ship_year", "l_orderkey, l_linenumber", "l_orderkey")
    + ", chunks AS (FROM events_chunks UNION ALL FROM lineitem_chunks)"
    + ", points AS (FROM events_points UNION ALL FROM lineitem_points)"
)
_INTERLEAVED = _EVENTS + f""",
halves AS (
  SELECT {DIMS}, concat_ws('|', chunk_id, "timestamp" % 2) AS chunk_id, pos AS day_pos,
         "timestamp", value FROM points),
half_points AS (
  SELECT {DIMS}, chunk_id, "timestamp", value,
         row_number() OVER (PARTITION BY {DIMS}, chunk_id ORDER BY day_pos) - 1 AS pos
  FROM halves),
half_chunks AS (
  SELECT {DIMS}, chunk_id, min("timestamp") AS start, max("timestamp") AS "end",
         count(*) AS n_points FROM half_points GROUP BY {DIMS}, chunk_id)"""

_CHUNK_ORDER = "c.start, c.chunk_id, p.pos"
_PREFIXED = ", ".join(f"p.{_QUOTED.get(d, d)}" for d in DIMENSIONS)


def _joined(points: str, chunks: str) -> str:
    """Points of the joined series: chunks in order of start and id, points as they come."""
    return f"""
SELECT {_PREFIXED},
       row_number() OVER (PARTITION BY {_PREFIXED} ORDER BY {_CHUNK_ORDER}) - 1 AS pos,
       p."timestamp", p.value
FROM {points} p JOIN {chunks} c USING (chunk_id)"""


_MIXED = _EVENTS + f""",
records AS (
  SELECT * REPLACE (chunk_id || ['', '|mean', '|none'][kind + 1] AS chunk_id), kind FROM chunks, range(3) AS t(kind)),
series_points AS (
  SELECT chunk_id, pos, "timestamp", value FROM points
  UNION ALL
  SELECT chunk_id, 0, start + ("end" - start) // 2, mean_value FROM records WHERE kind = 1),
series AS (
  SELECT r.*, CASE kind WHEN 0 THEN n_points WHEN 1 THEN 1 ELSE 0 END AS size FROM records r)"""

_MIXED_READ = _MIXED + """,
read_chunks AS (
  SELECT * REPLACE (CASE kind WHEN 0 THEN start ELSE start + ("end" - start) // 2 END AS start,
                    CASE kind WHEN 0 THEN "end" ELSE start + ("end" - start) // 2 END AS "end")
  FROM series WHERE kind < 2),
read_points AS (SELECT p.*, {dims} FROM series_points p JOIN records r USING (chunk_id))""".format(dims=", ".join(f"r.{_QUOTED.get(d, d)}" for d in DIMENSIONS))

_HALF_BOUNDS = f"""
SELECT {DIMS}, arg_min("timestamp", pos) AS series_start, arg_max("timestamp", pos) AS series_end
FROM ({_joined("half_points", "half_chunks")}) GROUP BY {DIMS}"""

_SAMPLE_OBSERVATIONS = """
SELECT event_id,
       'sampled' AS metric,
       CAST(NULL AS VARCHAR) AS host,
       CAST(NULL AS VARCHAR) AS measurement,
       CAST(NULL AS VARCHAR) AS process,
       CAST(NULL AS VARCHAR) AS ag,
       CAST(NULL AS VARCHAR) AS "group",
       1700000000000 + event_id * 60000 + user_id % 16 AS "timestamp",
       value
FROM events
"""
_SAMPLES = (
    f"WITH RECURSIVE sample_obs AS ({_SAMPLE_OBSERVATIONS}),"
    + _chunked("sample", "event_id // 500", "event_id", "event_id")
    + """, samples AS MATERIALIZED (
  SELECT chunk_id, pos, "timestamp" AS t, value FROM sample_points)"""
)


def _encode(points: str) -> str:
    """Offsets by their rules, one point after the other along every chunk.

    ``points`` names a relation (chunk_id, pos, t). ``stored_t`` is the last point stored and
    ``n`` the points since; an offset is left out while it changes by no more than 10 ms and
    ``stored_t + 10 n`` is not more than 5 ms ahead of the point.
    """
    keep = "abs(s.step - s.last_step) > 10 OR s.stored_t + 10 * s.n - s.t > 5"
    return f""",
walk(chunk_id, pos, t, step, last_step, stored_t, n) AS (
  SELECT chunk_id, pos, t, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS BIGINT)
  FROM {points} WHERE pos = 0
  UNION ALL
  SELECT p.chunk_id, p.pos, p.t, p.t - s.t, s.step,
         CASE WHEN {keep} THEN s.t ELSE s.stored_t END,
         CASE WHEN {keep} THEN 1 ELSE s.n + 1 END
  FROM walk s JOIN {points} p ON p.chunk_id = s.chunk_id AND p.pos = s.pos + 1),
encoded AS (SELECT chunk_id, pos, t, CASE WHEN {keep} THEN s.step ELSE 0 END AS "offset" FROM walk s)"""


def _recursive(ctes: str, cap: str) -> str:
    return ctes.replace("WITH ", "WITH RECURSIVE ", 1) + f", {cap}"


_DECODE = """,
filled AS (
  SELECT *, last_value(nullif("offset", 0) IGNORE NULLS) OVER (
            PARTITION BY chunk_id ORDER BY pos) AS known
  FROM offsets),
decoded AS (
  SELECT chunk_id, pos, value,
         start + sum(CASE WHEN pos = 0 THEN 0 ELSE coalesce(known, 10) END) OVER (
                 PARTITION BY chunk_id ORDER BY pos) AS t
  FROM filled)
SELECT chunk_id, pos, CAST(t AS BIGINT) AS "timestamp", value FROM decoded"""

_AT = f"BETWEEN {q.AT_MS - q.AROUND_MS} AND {q.AT_MS + q.AROUND_MS}"
_FLAT = 'ag, "group", host, measurement, metric, process, make_timestamp("timestamp" * 1000) AS "time", "timestamp", value'
_ORDERED_DIMS = ", ".join(f"{_QUOTED.get(d, d)} NULLS FIRST" for d in DIMENSIONS)
_SUMMARY = f"""
SELECT {DIMS}, n_chunks, series_start, series_end, CAST(n AS BIGINT) AS n_points FROM (
  SELECT {_PREFIXED}, count(DISTINCT p.chunk_id) AS n_chunks, count(*) AS n,
         arg_min(p."timestamp", (c.start, c.chunk_id, p.pos)) AS series_start,
         arg_max(p."timestamp", (c.start, c.chunk_id, p.pos)) AS series_end
  FROM points p JOIN chunks c USING (chunk_id) GROUP BY {_PREFIXED})"""


def _first_per_metric(source: str) -> str:
    return f"""
SELECT {DIMS}, series_start FROM (
  SELECT *, row_number() OVER (PARTITION BY metric ORDER BY series_start, {_ORDERED_DIMS}) AS rn
  FROM (SELECT {DIMS}, min("timestamp") AS series_start FROM {source} GROUP BY {DIMS}))
WHERE rn = 1"""


_SLOPE = 'round(regr_slope(value, CAST("timestamp" AS DOUBLE)) * 86400000, 6)'

_LABEL = " || ".join(f"'{d}:' || coalesce({_QUOTED.get(d, d)}, 'null')" for d in DIMENSIONS)


def _drawn(label: str) -> str:
    return f"CAST('0x' || substr(md5('{q.SEED}|' || {label}), 1, 8) AS BIGINT)"


def _at_positions(column: str) -> str:
    same = " AND ".join(f"s.{_QUOTED.get(d, d)} IS NOT DISTINCT FROM j.{_QUOTED.get(d, d)}" for d in DIMENSIONS)
    return f""",
joined AS ({_joined("half_points", "half_chunks")}),
asked AS (SELECT DISTINCT {DIMS}, CAST(unnest({list(q.POSITIONS)}) AS BIGINT) AS pos FROM half_chunks)
SELECT s.*, j.{column} FROM asked s LEFT JOIN joined j ON {same} AND s.pos = j.pos"""


ORACLES: dict[str, str] = {
    # Sources and sinks
    "query_chunks": _EVENTS + f"""
SELECT {DIMS}, chunk_id, pos, "timestamp", value FROM points WHERE metric = '{q.METRIC}'""",
    "query_chunks_all": _EVENTS + f" SELECT {HEADER} FROM chunks",
    "query_series": _EVENTS + f"""
SELECT * FROM ({_joined("points", "chunks")}) WHERE metric = '{q.METRIC}'""",
    "scan_projection": _EVENTS + f"""
SELECT {_PREFIXED}, p.chunk_id, c.start, c."end", c.n_points, p.pos, p."timestamp", p.value
FROM points p JOIN chunks c USING (chunk_id)""",
    "scan_sorted_by_id": _EVENTS + f" SELECT {HEADER} FROM chunks",
    "scan_collections": _BOTH + f" SELECT {HEADER} FROM chunks",
    "scan_time_range": _EVENTS + f"""
SELECT {DIMS}, chunk_id,
       row_number() OVER (PARTITION BY chunk_id ORDER BY pos) - 1 AS pos, "timestamp", value
FROM points WHERE "timestamp" BETWEEN {q.RANGE_FROM_MS} AND {q.RANGE_TO_MS}""",
    "record_to_series": _MIXED + f"""
SELECT {DIMS}, chunk_id, CAST(size AS BIGINT) AS n_points, "timestamp", value
FROM series LEFT JOIN series_points USING (chunk_id)""",
    "function_point": _EVENTS + f"""
SELECT {DIMS}, chunk_id, start + ("end" - start) // 2 AS "timestamp", mean_value AS value
FROM chunks""",
    "delta_decode": _EVENTS + """,
steps AS (
  SELECT p.chunk_id, p.pos, p.value, c.start,
         coalesce(p."timestamp" - lag(p."timestamp") OVER (PARTITION BY p.chunk_id ORDER BY p.pos), 0) AS step
  FROM points p JOIN chunks c USING (chunk_id)),
offsets AS (
  SELECT chunk_id, pos, value, start, CASE WHEN step % 4 = 0 THEN 0 ELSE step END AS "offset" FROM steps)"""
    + _DECODE,
    "delta_encode": _SAMPLES + _encode("samples") + ' SELECT chunk_id, pos, "offset" FROM encoded',
    "delta_encode_irregular": _recursive(
        _EVENTS, 'timed AS MATERIALIZED (SELECT chunk_id, pos, "timestamp" AS t FROM points)'
    ) + _encode("timed") + ' SELECT chunk_id, pos, "offset" FROM encoded',
    "delta_encode_ties": _recursive(
        _LINEITEM, 'timed AS MATERIALIZED (SELECT chunk_id, pos, "timestamp" AS t FROM points)'
    ) + _encode("timed") + ' SELECT chunk_id, pos, "offset" FROM encoded',
    "delta_round_trip": _SAMPLES + _encode("samples") + """,
offsets AS (
  SELECT e.chunk_id, e.pos, e."offset", s.value, first_value(e.t) OVER (
         PARTITION BY e.chunk_id ORDER BY e.pos) AS start
  FROM encoded e JOIN samples s ON s.chunk_id = e.chunk_id AND s.pos = e.pos)""" + _DECODE,
    "write_extract": _EVENTS + f" SELECT {HEADER} FROM chunks",
    "read_extract": _EVENTS + f"""
SELECT {DIMS}, chunk_id, pos, "timestamp", value FROM points WHERE metric = '{q.METRIC}'""",
    # Series transformations
    "filter_series": _EVENTS + f" SELECT {HEADER} FROM chunks WHERE max_value > {q.VALUE_LIMIT}",
    "join_chunks": _INTERLEAVED + _joined("half_points", "half_chunks"),
    "join_chunks_ties": _LINEITEM + _joined("points", "chunks"),
    "filter_by_dimensions": _EVENTS + f"""
SELECT {HEADER} FROM chunks WHERE measurement = 'm1' AND "group" = 'usage'""",
    "filter_by_dimensions_null_value": _EVENTS + f"""
SELECT {HEADER} FROM chunks WHERE process = NULL AND "group" = 'usage'""",
    "filter_by_dimensions_nullsafe": _EVENTS + f"""
SELECT {HEADER} FROM chunks WHERE process IS NULL AND "group" = 'usage'""",
    "series_key": _EVENTS + f" SELECT DISTINCT {DIMS} FROM obs",
    "order_series": _EVENTS + f" SELECT {HEADER} FROM chunks ORDER BY start, chunk_id",
    "chunk_overlaps": _INTERLEAVED + f""",
reach AS (
  SELECT *, max((("end", start, chunk_id))) OVER (PARTITION BY {DIMS} ORDER BY start
            RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
  FROM half_chunks)
SELECT {DIMS}, earlier[3] AS left_id, earlier[2] AS left_start, earlier[1] AS left_end,
       chunk_id AS right_id, start AS right_start, "end" AS right_end
FROM reach WHERE earlier[1] >= start""",
    "values": "SELECT value FROM events",
    "observations": _EVENTS + f' SELECT {DIMS}, "timestamp", value FROM obs',
    "to_dataframe": _EVENTS + f" SELECT {_FLAT} FROM obs",
    "observations_dataset": _EVENTS + f" SELECT {_FLAT} FROM obs",
    "observations_at": _EVENTS + f"""
SELECT {DIMS}, "timestamp", value FROM obs WHERE "timestamp" {_AT}""",
    "sql_select_where": _EVENTS + " SELECT value, process FROM obs WHERE process = 'p1'",
    "sort_points": _INTERLEAVED + f"""
SELECT {DIMS}, row_number() OVER (PARTITION BY {DIMS} ORDER BY "timestamp", pos) - 1 AS pos,
       "timestamp", value
FROM ({_joined("half_points", "half_chunks")})""",
    "append_points": _EVENTS + """,
longer AS (
  SELECT chunk_id, pos, "timestamp", value FROM points
  UNION ALL SELECT chunk_id, n_points, "end", 0.0 FROM chunks
  UNION ALL SELECT chunk_id, n_points + 1, "end" + 1, -1.0 FROM chunks)
SELECT chunk_id, c.n_points + 2 AS n_points, pos, "timestamp", value
FROM longer JOIN chunks c USING (chunk_id)""",
    "append_point": _EVENTS + """,
longer AS (
  SELECT chunk_id, pos, "timestamp", value FROM points
  UNION ALL SELECT chunk_id, n_points, "end" + 1000, CAST(n_points AS DOUBLE) FROM chunks)
SELECT chunk_id, c.n_points + 1 AS n_points, pos, "timestamp", value
FROM longer JOIN chunks c USING (chunk_id)""",
    "indexed_points": _EVENTS + _joined("points", "chunks"),
    # Aggregates and actions
    "mean": "SELECT round(avg(value), 9) AS mean FROM events",
    "approx_mean": "SELECT round(avg(value), 9) AS approx_mean FROM events",
    "min": "SELECT min(value) AS min FROM events",
    "max": "SELECT max(value) AS max FROM events",
    "slopes": _EVENTS + f" SELECT {DIMS}, {_SLOPE} AS slope_per_day FROM obs GROUP BY {DIMS}",
    "slopes_bulk": _LINEITEM + f"""
SELECT {DIMS}, {_SLOPE} AS slope_per_day FROM lineitem_obs GROUP BY {DIMS}""",
    "slopes_chunked": _EVENTS + """
SELECT chunk_id, CASE WHEN count(DISTINCT "timestamp") > 1 THEN
  round(regr_slope(value, CAST("timestamp" AS DOUBLE)) * 86400000, 4) END AS slope_per_day
FROM points GROUP BY chunk_id""",
    "count_observations": "SELECT count(*) AS n_observations FROM events",
    "count_observations_bulk": "SELECT count(*) AS n_observations FROM lineitem",
    "count_series": _EVENTS + f" SELECT count(*) AS n_series FROM (SELECT DISTINCT {DIMS} FROM obs)",
    "count_chunks": _EVENTS + " SELECT count(*) AS n_chunks FROM chunks",
    "collect_series": _EVENTS + f""",
placed AS (
  SELECT *, coalesce(sum(n_points) OVER (PARTITION BY {DIMS} ORDER BY start, chunk_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {q.ROW_POINTS} AS series_row
  FROM chunks)
SELECT {DIMS}, arg_min(chunk_id, (start, chunk_id)) AS chunk_id, min(start) AS start,
       max("end") AS "end", CAST(sum(n_points) AS BIGINT) AS n_points,
       CAST(sum(hundredths) AS BIGINT) AS hundredths, CAST(sum(phase_ms) AS BIGINT) AS phase_ms
FROM placed GROUP BY {DIMS}, series_row""",
    "take_series": _EVENTS + f"""
SELECT * FROM ({_joined("points", "chunks")}) QUALIFY dense_rank() OVER (ORDER BY {_ORDERED_DIMS}) <= {q.TAKE}""",
    "take_chunks": _EVENTS + f"""
SELECT {HEADER} FROM chunks ORDER BY {_ORDERED_DIMS}, chunk_id LIMIT {q.TAKE}""",
    # Accessors
    "series_start": _INTERLEAVED + f" SELECT {DIMS}, series_start FROM ({_HALF_BOUNDS})",
    "series_end": _INTERLEAVED + f" SELECT {DIMS}, series_end FROM ({_HALF_BOUNDS})",
    "chunk_bounds": _MIXED + """
SELECT chunk_id, coalesce(min("timestamp"), 0) AS series_start,
       coalesce(max("timestamp"), 0) AS series_end
FROM series LEFT JOIN series_points USING (chunk_id) GROUP BY chunk_id""",
    "series_size": _EVENTS + f"""
SELECT {DIMS}, count(*) AS n_chunks, CAST(sum(n_points) AS BIGINT) AS n_points
FROM chunks GROUP BY {DIMS}""",
    "series_is_empty": _MIXED + """
SELECT chunk_id, CAST(size AS BIGINT) AS n_points, size = 0 AS is_empty FROM series""",
    "value_at": _EVENTS + """
SELECT chunk_id, max(value) FILTER (pos = 0) AS value_0, max(value) FILTER (pos = 2) AS value_2
FROM points GROUP BY chunk_id""",
    "time_at": _EVENTS + """
SELECT chunk_id, max("timestamp") FILTER (pos = 0) AS time_0,
       max("timestamp") FILTER (pos = 2) AS time_2
FROM points GROUP BY chunk_id""",
    "timestamps_array": _EVENTS + ' SELECT chunk_id, pos, "timestamp" FROM points',
    "values_array": _EVENTS + " SELECT chunk_id, pos, value FROM points",
    "attribute": _EVENTS + """
SELECT chunk_id, process AS by_id, host AS by_ordinal, CAST(NULL AS VARCHAR) AS unknown_id,
       CAST(NULL AS VARCHAR) AS unknown_ordinal
FROM chunks""",
    "dimension_label": _EVENTS + """
SELECT chunk_id, 'metric:' || coalesce(metric, 'null') || 'host:' || coalesce(host, 'null')
       || 'measurement:' || coalesce(measurement, 'null') || 'process:' || coalesce(process, 'null')
       || 'ag:' || coalesce(ag, 'null') || 'group:' || coalesce("group", 'null') AS label
FROM chunks""",
    "millis_to_time": _EVENTS + " SELECT chunk_id, make_timestamp(start * 1000) AS start_time FROM chunks",
    "time_to_millis": _EVENTS + ' SELECT metric, host, "timestamp" AS millis FROM obs',
    # Identity and sets
    "distinct_observations": _EVENTS + f' SELECT DISTINCT {DIMS}, "timestamp", value FROM obs',
    "distinct_metrics": _EVENTS + _first_per_metric("obs"),
    "union_series": _BOTH + _SUMMARY,
    "intersect_series": _EVENTS + ", alert AS (SELECT * FROM obs WHERE metric = 'error')"
    + _first_per_metric("alert"),
    "subtract_series": _EVENTS + f" SELECT {HEADER} FROM chunks WHERE metric <> 'error'",
    # User code
    "udf_filter": _EVENTS + f"""
SELECT {HEADER} FROM chunks WHERE max_value - min_value > {q.SPREAD_LIMIT}""",
    "udf_filter_rows": _EVENTS + f"""
SELECT {DIMS}, "timestamp", value FROM obs WHERE "timestamp" % 3600000 >= 1800000""",
    # Whole series
    "query_chunks_records": _MIXED_READ + f"""
SELECT chunk_id, c.start, c."end", CAST(c.size AS BIGINT) AS n_points, p.pos, p."timestamp", p.value
FROM read_points p JOIN read_chunks c USING (chunk_id) WHERE c.metric = '{q.METRIC}'""",
    "query_series_records": _MIXED_READ + f"""
SELECT * FROM ({_joined("read_points", "read_chunks")}) WHERE metric = '{q.METRIC}'""",
    "filter_whole_series": _EVENTS + f"""
SELECT * FROM ({_joined("points", "chunks")})
QUALIFY max(value) OVER (PARTITION BY {DIMS}) > {q.WHOLE_LIMIT} AND count(*) OVER (PARTITION BY {DIMS}) > {q.WHOLE_SIZE}""",
    "filter_whole_series_every": _EVENTS + f"""
SELECT {DIMS}, count(*) AS n_points FROM obs GROUP BY {DIMS} HAVING max(value) <= {q.WHOLE_LIMIT}""",
    "value_at_series": _INTERLEAVED + _at_positions("value"),
    "time_at_series": _INTERLEAVED + _at_positions('"timestamp"'),
    "delta_decode_range": _EVENTS + """,
steps AS (
  SELECT p.chunk_id, p.pos, p.value, c.start,
         coalesce(p."timestamp" - lag(p."timestamp") OVER (PARTITION BY p.chunk_id ORDER BY p.pos), 0) AS step
  FROM points p JOIN chunks c USING (chunk_id)),
offsets AS (
  SELECT chunk_id, pos, value, start, CASE WHEN step % 4 = 0 THEN 0 ELSE step END AS "offset" FROM steps)"""
    + _DECODE.replace("SELECT chunk_id, pos, CAST(t AS BIGINT)", """,
cut AS (
  SELECT chunk_id, d.value, d.t, row_number() OVER (PARTITION BY chunk_id ORDER BY d.pos) - 1 AS pos, count(*) OVER (PARTITION BY chunk_id) AS n_points
  FROM decoded d JOIN chunks c USING (chunk_id)
  WHERE d.t BETWEEN {a} AND {b} AND c.start <= {b} AND c."end" >= {a})
SELECT chunk_id, n_points, pos, CAST(t AS BIGINT)""".format(a=q.RANGE_FROM_MS, b=q.RANGE_TO_MS)).replace("value FROM decoded", "value FROM cut"),
    "approx_mean_sampled": _EVENTS + f""",
sums AS (
  SELECT chunk_id, sum(value) AS y, count(*)::DOUBLE AS x, any_value(metric) AS metric, any_value(host) AS host, any_value(measurement) AS measurement,
         any_value(process) AS process, any_value(ag) AS ag, any_value("group") AS "group" FROM points GROUP BY chunk_id),
drawn AS (SELECT * FROM sums WHERE {_drawn(f"{_LABEL} || '|' || chunk_id")} < {int(q.SHARE * 2**32)}),
r AS (SELECT sum(y) / sum(x) AS mean, count(*) AS m, sum(x) AS n FROM drawn)
SELECT round(any_value(mean), 6) AS mean,
       round(1.96 * sqrt((1 - any_value(m) / (SELECT count(*) FROM sums)) * sum((y - mean * x) ** 2) / (any_value(m) - 1) * any_value(m)) / any_value(n), 6) AS error,
       round(any_value(n) / (SELECT sum(x) FROM sums), 9) AS share_read, any_value(m) AS n_chunks
FROM drawn, r""",
    "chunk_overlap_counts": _INTERLEAVED + f"""
SELECT {", ".join(f"b.{_QUOTED.get(d, d)}" for d in DIMENSIONS)}, b.chunk_id, b.start, b."end", count(a.chunk_id) AS n_earlier
FROM half_chunks b LEFT JOIN half_chunks a
  ON {" AND ".join(f"a.{_QUOTED.get(d, d)} IS NOT DISTINCT FROM b.{_QUOTED.get(d, d)}" for d in DIMENSIONS)} AND a.start < b.start AND a."end" >= b.start
GROUP BY ALL""",
    "sample_series": _EVENTS + f"""
SELECT {HEADER} FROM chunks WHERE {_drawn(_LABEL)} < {int(q.SERIES_SHARE * 2**32)}""",
    "sort_series": _EVENTS + f"""
SELECT {DIMS}, chunk_id, max(max_value) OVER (PARTITION BY {DIMS}) AS sort_key FROM chunks""",
    "convert_with": _EVENTS + ' SELECT chunk_id, "end" - start AS span FROM chunks',
}
