"""The registered queries: every operator on the whole test tables.

Names and column names match ``plans.oracles``. Points are put out as rows (with their
position where order matters), never as arrays, so that results compare value by value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import points as fp
from tideline.functions.codec import delta_decode, delta_decode_range, delta_encode
from tideline.model import DIMENSIONS, attribute, dimension_label
from tideline.operators import aggregates, filters, flatten, identity, joining, ordering
from tideline.plans import tables
from tideline.sources import chunks as sources
from tideline.sources.extract import new_path, read_extract, write_extract

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries, shared with the SQL.
METRIC = "error"
RANGE_FROM_MS = 1_704_844_800_000  # 2024-01-10 00:00
RANGE_TO_MS = 1_705_060_800_000  # 2024-01-12 12:00
AT_MS = 1_705_276_800_000  # 2024-01-15 00:00
AROUND_MS = 3_600_000
VALUE_LIMIT = 100.0
SPREAD_LIMIT = 50.0
TAKE = 5
DIMENSION_FILTER = {"measurement": "m1", "group": "usage"}
NULL_FILTER = {"process": None, "group": "usage"}
ALIASES = {"all": "events,lineitem"}
DAY_MS = tables.DAY_MS

HEADER = (*DIMENSIONS, "chunk_id", "start", "end", "n_points")
MINUTE_MS = 60_000
WHOLE_LIMIT = 230.0
WHOLE_SIZE = 100
POSITIONS = (-1, 0, 3, 77, 10_000_000)
SHARE = 0.2         # of the chunks
SERIES_SHARE = 0.3
SEED = 7
ROW_POINTS = 50     # a bound on series rows that many series exceed


def _header(chunks: DataFrame) -> DataFrame:
    """Chunks in one line each: header, and sums over the points in whole numbers, so that results
    depend on every point."""
    def total(leaf: str, whole: Callable[[Column], Column]) -> Column:
        return F.aggregate(leaf, F.lit(0).cast("bigint"), lambda a, x: a + whole(x))

    return chunks.select(
        *HEADER,
        total("points.value", lambda v: F.round(v * 100).cast("bigint")).alias("hundredths"),
        total("points.timestamp", lambda t: F.pmod(t, F.lit(MINUTE_MS))).alias("phase_ms"),
    )


def _chunk_points(chunks: DataFrame, *columns: str) -> DataFrame:
    """Points of every chunk with their position in it."""
    kept = columns or (*DIMENSIONS, "chunk_id")
    return chunks.select(*kept, F.posexplode("points").alias("pos", "_point")).select(
        *kept,
        F.col("pos").cast("bigint").alias("pos"),
        F.col("_point.timestamp").alias("timestamp"),
        F.col("_point.value").alias("value"),
    )


# Sources and sinks


def query_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sources.query_chunks(tables.event_chunks(spark, sf_dir), F.col("metric") == METRIC)
    return _chunk_points(found)


def query_chunks_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _header(sources.query_chunks(tables.event_chunks(spark, sf_dir)))


def query_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sources.query_series(tables.event_chunks(spark, sf_dir), F.col("metric") == METRIC)
    return joining.indexed_points(found)


def scan_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = sources.scan_projection(tables.event_chunks(spark, sf_dir))
    return _chunk_points(chunks, *HEADER)


def scan_sorted_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _header(sources.scan_sorted_by_id(tables.event_chunks(spark, sf_dir)))


def scan_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    collections = {
        "events": tables.event_chunks(spark, sf_dir),
        "lineitem": tables.lineitem_chunks(spark, sf_dir),
    }
    return _header(sources.scan_collections("all", collections, ALIASES))


def scan_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = tables.event_chunks(spark, sf_dir)
    found = sources.scan_time_range(chunks, RANGE_FROM_MS, RANGE_TO_MS)
    return _chunk_points(found)


def record_to_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = sources.record_to_series(tables.mixed_records(spark, sf_dir))
    point = F.explode_outer(F.transform("points", lambda p: p)).alias("_point")
    return series.select(*DIMENSIONS, "chunk_id", "n_points", point).select(
        *DIMENSIONS, "chunk_id", "n_points",
        F.col("_point.timestamp").alias("timestamp"),
        F.col("_point.value").alias("value"),
    )


def function_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.function_points(tables.function_records(spark, sf_dir))


def delta_decode_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunk_points(delta_decode(tables.offset_chunks(spark, sf_dir)), "chunk_id")


def _encoded(chunks: DataFrame) -> DataFrame:
    return delta_encode(chunks).select(
        "chunk_id", F.posexplode("offsets").alias("_pos", "offset")
    ).select("chunk_id", F.col("_pos").cast("bigint").alias("pos"), "offset")


def delta_encode_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On near-regular samples, most of whose offsets are left out."""
    return _encoded(tables.sampled_chunks(spark, sf_dir))


def delta_encode_irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On day chunks of irregular times, most of whose offsets are kept."""
    return _encoded(tables.event_chunks(spark, sf_dir))


def delta_encode_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On chunks in which many points share a time."""
    return _encoded(tables.lineitem_chunks(spark, sf_dir))


def delta_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = delta_decode(delta_encode(tables.sampled_chunks(spark, sf_dir)))
    return _chunk_points(decoded, "chunk_id")


def _extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = tables.event_chunks(spark, sf_dir)
    path = new_path(spark, "extract")
    if path is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return read_extract(spark, write_extract(chunks, path))


def write_extract_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _header(_extract(spark, sf_dir))


def read_extract_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunk_points(_extract(spark, sf_dir).where(F.col("metric") == METRIC))


# Series transformations


def filter_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = F.exists("points.value", lambda v: v > VALUE_LIMIT)
    return _header(filters.filter_series(tables.event_chunks(spark, sf_dir), large))


def join_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = joining.join_chunks(tables.interleaved_chunks(spark, sf_dir))
    return joining.indexed_points(series)


def join_chunks_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = joining.join_chunks(tables.lineitem_chunks(spark, sf_dir))
    return joining.indexed_points(series)


def filter_by_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = tables.event_chunks(spark, sf_dir)
    return _header(filters.filter_by_dimensions(chunks, DIMENSION_FILTER))


def filter_by_dimensions_null_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = tables.event_chunks(spark, sf_dir)
    return _header(filters.filter_by_dimensions(chunks, NULL_FILTER))


def filter_by_dimensions_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = tables.event_chunks(spark, sf_dir)
    return _header(filters.filter_by_dimensions(chunks, NULL_FILTER, ignore_null=True))


def series_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.series_key(tables.event_chunks(spark, sf_dir)).select(*DIMENSIONS)


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _header(ordering.order_series(tables.event_chunks(spark, sf_dir)))


def chunk_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.chunk_overlaps(tables.interleaved_chunks(spark, sf_dir))


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.values(tables.event_chunks(spark, sf_dir))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.observations(tables.event_chunks(spark, sf_dir))


def to_dataframe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.to_dataframe(tables.event_chunks(spark, sf_dir))


def observations_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.observations_dataset(tables.event_chunks(spark, sf_dir))


def observations_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.observations_at(tables.event_chunks(spark, sf_dir), AT_MS, AROUND_MS)


def sql_select_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = flatten.to_dataframe(tables.event_chunks(spark, sf_dir))
    return spark.sql("SELECT value, process FROM {frame} WHERE process = 'p1'", frame=frame)


def sort_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On series of interleaved chunks, whose points are out of order once joined."""
    return joining.sorted_points(joining.with_first_position(tables.interleaved_chunks(spark, sf_dir)))


def append_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk followed by the points of a list: its end and a millisecond after it."""
    more = F.array(
        fp.point(F.col("end"), F.lit(0.0)), fp.point(F.col("end") + 1, F.lit(-1.0))
    )
    chunks = tables.event_chunks(spark, sf_dir)
    return _chunk_points(fp.replace_points(chunks, fp.append_points(more)), "chunk_id", "n_points")


def append_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = tables.event_chunks(spark, sf_dir)
    longer = fp.append_point(F.col("end") + 1000, F.col("n_points").cast("double"))
    return _chunk_points(fp.replace_points(chunks, longer), "chunk_id", "n_points")


def indexed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions in the whole series, worked out without joining points."""
    return joining.joined_points(tables.event_chunks(spark, sf_dir))


# Aggregates and actions


def mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = aggregates.mean(tables.event_chunks(spark, sf_dir))
    return frame.select(F.round("mean", 9).alias("mean"))


def approx_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = aggregates.approx_mean(tables.event_chunks(spark, sf_dir))
    return frame.select(F.round("approx_mean", 9).alias("approx_mean"))


def minimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.minimum(tables.event_chunks(spark, sf_dir))


def maximum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.maximum(tables.event_chunks(spark, sf_dir))


def slopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = aggregates.slopes(tables.event_chunks(spark, sf_dir))
    return frame.select(*DIMENSIONS, F.round(F.col("slope") * DAY_MS, 6).alias("slope_per_day"))


def slopes_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On raw observations of the largest table, without chunks."""
    frame = aggregates.slopes(tables.lineitem_observations(spark, sf_dir))
    return frame.select(*DIMENSIONS, F.round(F.col("slope") * DAY_MS, 6).alias("slope_per_day"))


def slopes_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One slope per chunk, as asked of chunks that were not joined. NaN shows as null."""
    frame = aggregates.slopes(tables.event_chunks(spark, sf_dir), by=[*DIMENSIONS, "chunk_id"])
    per_day = F.round(F.col("slope") * DAY_MS, 4)
    return frame.select("chunk_id", F.when(~F.isnan("slope"), per_day).alias("slope_per_day"))


def count_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_observations(tables.event_chunks(spark, sf_dir))


def count_observations_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_observations(tables.lineitem_observations(spark, sf_dir))


def count_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_series(tables.event_chunks(spark, sf_dir))


def count_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_chunks(tables.event_chunks(spark, sf_dir))


def collect_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``collect_series`` iterates over: the rows of every joined series, several for each."""
    series = joining.join_chunks(tables.event_chunks(spark, sf_dir), ROW_POINTS)
    return _header(aggregates.in_series_order(series))


def take_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five series of a joined collection, several rows each, point by point."""
    return joining.indexed_points(aggregates.take_joined(tables.event_chunks(spark, sf_dir), TAKE, ROW_POINTS))


def take_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _header(aggregates.take_chunks(tables.event_chunks(spark, sf_dir), TAKE))


# Accessors


def series_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By position, on interleaved series: start and end are not the extremes there."""
    summary = joining.series_summary(tables.interleaved_chunks(spark, sf_dir))
    return summary.select(*DIMENSIONS, "series_start")


def series_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = joining.series_summary(tables.interleaved_chunks(spark, sf_dir))
    return summary.select(*DIMENSIONS, "series_end")


def chunk_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end by position of every record's points, 0 where it has none."""
    series = sources.record_to_series(tables.mixed_records(spark, sf_dir))
    return series.select(
        "chunk_id", fp.series_start().alias("series_start"), fp.series_end().alias("series_end")
    )


def series_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = joining.series_summary(tables.event_chunks(spark, sf_dir))
    return summary.select(*DIMENSIONS, "n_chunks", "n_points")


def series_is_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = sources.record_to_series(tables.mixed_records(spark, sf_dir))
    return series.select(
        "chunk_id", fp.series_size().alias("n_points"), fp.series_is_empty().alias("is_empty")
    )


def value_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.event_chunks(spark, sf_dir).select(
        "chunk_id", fp.value_at(0).alias("value_0"), fp.value_at(2).alias("value_2")
    )


def time_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.event_chunks(spark, sf_dir).select(
        "chunk_id", fp.time_at(0).alias("time_0"), fp.time_at(2).alias("time_2")
    )


def timestamps_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.event_chunks(spark, sf_dir).select(
        "chunk_id", F.posexplode(fp.timestamps_array()).alias("_pos", "timestamp")
    ).select("chunk_id", F.col("_pos").cast("bigint").alias("pos"), "timestamp")


def values_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.event_chunks(spark, sf_dir).select(
        "chunk_id", F.posexplode(fp.values_array()).alias("_pos", "value")
    ).select("chunk_id", F.col("_pos").cast("bigint").alias("pos"), "value")


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.event_chunks(spark, sf_dir).select(
        "chunk_id",
        attribute("process").alias("by_id"),
        attribute(1).alias("by_ordinal"),
        attribute("rack").alias("unknown_id"),
        attribute(6).alias("unknown_ordinal"),
    )


def dimension_label_(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = tables.event_chunks(spark, sf_dir)
    return chunks.select("chunk_id", dimension_label().alias("label"))


def millis_to_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.event_chunks(spark, sf_dir).select(
        "chunk_id", fp.millis_to_time("start").alias("start_time")
    )


def time_to_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = flatten.to_dataframe(tables.event_chunks(spark, sf_dir))
    return frame.select("metric", "host", fp.time_to_millis("time").alias("millis"))


# Identity and sets


def distinct_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two chunkings of the same points, put together and reduced again."""
    both = identity.union_series(
        flatten.observations(tables.event_chunks(spark, sf_dir)),
        flatten.observations(tables.interleaved_chunks(spark, sf_dir)),
    )
    return identity.distinct_observations(both)


def distinct_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.distinct_metrics(tables.event_chunks(spark, sf_dir))


def union_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = identity.union_series(
        tables.event_chunks(spark, sf_dir), tables.lineitem_chunks(spark, sf_dir)
    )
    return joining.series_summary(chunks)


def _alert_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.event_chunks(spark, sf_dir)
    return filters.filter_by_dimensions(events, {"group": "alert"})


def intersect_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.event_chunks(spark, sf_dir)
    return identity.intersect_series(events, _alert_chunks(spark, sf_dir)).select(
        *DIMENSIONS, "series_start"
    )


def subtract_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.event_chunks(spark, sf_dir)
    return _header(identity.subtract_series(events, _alert_chunks(spark, sf_dir)))


# User code


def udf_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predicate in Python on the values of a chunk: they spread by more than a limit."""

    chunks = tables.event_chunks(spark, sf_dir).withColumn("_values", fp.values_array())
    return _header(filters.filter_rows(chunks, _spread, "_values"))


def _spread(lists: pa.Array) -> pa.Array:
    """Whether the numbers of a list spread by more than the limit; a list without numbers does not."""
    bounds = lists.offsets.to_numpy().astype(np.int64)
    numbers = lists.values.fill_null(np.nan).to_numpy()
    full = np.flatnonzero((np.diff(bounds) > 0) & lists.is_valid().to_numpy(zero_copy_only=False))
    wide = np.zeros(len(lists), bool)
    if len(full):
        # Between the lists taken there may be others, whose numbers then end the list before: cut there as well.
        cuts = np.unique(np.concatenate((bounds[full], bounds[full + 1])))
        cuts = cuts[cuts < len(numbers)]
        at = np.searchsorted(cuts, bounds[full])
        spread = np.fmax.reduceat(numbers, cuts)[at] - np.fmin.reduceat(numbers, cuts)[at]
        wide[full] = spread > SPREAD_LIMIT
    return pa.array(wide)


def _off_hour(times: pa.Array) -> pa.Array:
    """Whether a time lies in the second half of its hour."""
    return pc.greater_equal(pa.array(np.mod(times.to_numpy(zero_copy_only=False), 60 * MINUTE_MS)), 30 * MINUTE_MS)


def udf_filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predicate in Python on single observations, a batch of them at a time."""
    return filters.filter_rows(flatten.observations(tables.event_chunks(spark, sf_dir)), _off_hour, "timestamp")


# Whole series, however many rows each has


def query_chunks_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with points, with an aggregate and with neither, as a store hands them over."""
    return _chunk_points(sources.query_chunks(_stored_records(spark, sf_dir), F.col("metric") == METRIC), "chunk_id", "start", "end", "n_points")


def query_series_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records joined into whole series, in rows of few points."""
    found = sources.query_chunks(_stored_records(spark, sf_dir), F.col("metric") == METRIC)
    return joining.indexed_points(joining.join_chunks(found, ROW_POINTS))


def _stored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.mixed_records(spark, sf_dir).withColumn("n_points", fp.series_size("points"))


def filter_whole_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined series, several rows each, in which some value is large and the values add up to enough."""
    series = joining.join_chunks(tables.event_chunks(spark, sf_dir), ROW_POINTS)
    large = filters.any_point(lambda p: p["value"] > WHOLE_LIMIT)
    many = filters.total_points() > WHOLE_SIZE
    return joining.indexed_points(filters.filter_whole_series(series, large & many))


def filter_whole_series_every(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series none of whose values is larger than a bound, by identity."""
    series = joining.join_chunks(tables.event_chunks(spark, sf_dir), ROW_POINTS)
    small = filters.every_point(lambda p: p["value"] <= WHOLE_LIMIT)
    return filters.filter_whole_series(series, small).groupBy(*DIMENSIONS).agg(F.sum("n_points").alias("n_points"))


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = joining.join_chunks(tables.interleaved_chunks(spark, sf_dir), ROW_POINTS)
    return joining.points_at(series, POSITIONS)


def value_at_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values at positions of whole joined series, several rows each, some positions outside."""
    return _positions(spark, sf_dir).select(*DIMENSIONS, "pos", "value")


def time_at_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions(spark, sf_dir).select(*DIMENSIONS, "pos", "timestamp")


def delta_decode_range_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets decoded within a range of time that cuts chunks."""
    found = delta_decode_range(tables.offset_chunks(spark, sf_dir), RANGE_FROM_MS, RANGE_TO_MS)
    return _chunk_points(found, "chunk_id", "n_points")


def approx_mean_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean of a sample of chunks, with the error to expect and the share of the points read."""
    found = aggregates.sampled_mean(tables.event_chunks(spark, sf_dir), SHARE, SEED)
    return found.select(F.round("mean", 6).alias("mean"), F.round("error", 6).alias("error"), F.round("share_read", 9).alias("share_read"), "n_chunks")


def chunk_overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.overlap_counts(tables.interleaved_chunks(spark, sf_dir))


def sample_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A share of the series, each whole."""
    return _header(identity.sample_series(tables.event_chunks(spark, sf_dir), SERIES_SHARE, SEED))


def sort_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks by the largest value of their series, the largest first."""
    chunks = ordering.sort_series(tables.event_chunks(spark, sf_dir), F.max(F.array_max("points.value")), ascending=False)
    return chunks.select(*DIMENSIONS, "chunk_id", "sort_key")


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        span = pc.subtract(batch.column("end"), batch.column("start"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("chunk_id"), span], names=["chunk_id", "span"]
        )


def convert_with(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A converter of records to another type, as code on Arrow batches."""
    records = tables.event_chunks(spark, sf_dir).select("chunk_id", "start", "end")
    return sources.convert_with(records, _spans, "chunk_id string, span bigint")


QUERIES: dict[str, Query] = {
    "query_chunks": query_chunks,
    "query_chunks_all": query_chunks_all,
    "query_series": query_series,
    "scan_projection": scan_projection,
    "scan_sorted_by_id": scan_sorted_by_id,
    "scan_collections": scan_collections,
    "scan_time_range": scan_time_range,
    "record_to_series": record_to_series,
    "function_point": function_point,
    "delta_decode": delta_decode_,
    "delta_encode": delta_encode_,
    "delta_encode_irregular": delta_encode_irregular,
    "delta_encode_ties": delta_encode_ties,
    "delta_round_trip": delta_round_trip,
    "write_extract": write_extract_,
    "read_extract": read_extract_,
    "filter_series": filter_series,
    "join_chunks": join_chunks,
    "join_chunks_ties": join_chunks_ties,
    "filter_by_dimensions": filter_by_dimensions,
    "filter_by_dimensions_null_value": filter_by_dimensions_null_value,
    "filter_by_dimensions_nullsafe": filter_by_dimensions_nullsafe,
    "series_key": series_key,
    "order_series": order_series,
    "chunk_overlaps": chunk_overlaps,
    "values": values,
    "observations": observations,
    "to_dataframe": to_dataframe,
    "observations_dataset": observations_dataset,
    "observations_at": observations_at,
    "sql_select_where": sql_select_where,
    "sort_points": sort_points,
    "append_points": append_points,
    "append_point": append_point,
    "indexed_points": indexed_points,
    "mean": mean,
    "approx_mean": approx_mean,
    "min": minimum,
    "max": maximum,
    "slopes": slopes,
    "slopes_bulk": slopes_bulk,
    "slopes_chunked": slopes_chunked,
    "count_observations": count_observations,
    "count_observations_bulk": count_observations_bulk,
    "count_series": count_series,
    "count_chunks": count_chunks,
    "collect_series": collect_series,
    "take_series": take_series,
    "take_chunks": take_chunks,
    "series_start": series_start,
    "series_end": series_end,
    "chunk_bounds": chunk_bounds,
    "series_size": series_size,
    "series_is_empty": series_is_empty,
    "value_at": value_at,
    "time_at": time_at,
    "timestamps_array": timestamps_array,
    "values_array": values_array,
    "attribute": attributes,
    "dimension_label": dimension_label_,
    "millis_to_time": millis_to_time,
    "time_to_millis": time_to_millis,
    "distinct_observations": distinct_observations,
    "distinct_metrics": distinct_metrics,
    "union_series": union_series,
    "intersect_series": intersect_series,
    "subtract_series": subtract_series,
    "udf_filter": udf_filter,
    "udf_filter_rows": udf_filter_rows,
    "convert_with": convert_with,
    # Whole series
    "query_chunks_records": query_chunks_records,
    "query_series_records": query_series_records,
    "filter_whole_series": filter_whole_series,
    "filter_whole_series_every": filter_whole_series_every,
    "value_at_series": value_at_series,
    "time_at_series": time_at_series,
    "delta_decode_range": delta_decode_range_,
    "approx_mean_sampled": approx_mean_sampled,
    "chunk_overlap_counts": chunk_overlap_counts,
    "sample_series": sample_series,
    "sort_series": sort_series,
}
