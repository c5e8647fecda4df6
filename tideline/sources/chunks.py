"""Chunk tables: writing, reading with predicates, turning stored records into series."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.points import (
    empty_points,
    function_point,
    mid_time,
    points_between,
    replace_points,
    series_size,
)
from tideline.model import CHUNKS, DIMENSIONS
from tideline.operators.joining import join_chunks

CHUNK_COLUMNS = (*DIMENSIONS, "chunk_id", "start", "end", "n_points", "points")


def write_chunks(chunks: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a chunk table laid out for predicates on metric and time.

    Range partitioning by metric and start gives every file a narrow range of both, so the
    footer statistics prune files and row groups. A metric holding most of the chunks is
    split over many files by its start times.
    """
    order = ["metric", "start", "chunk_id"]
    laid_out = chunks.repartitionByRange(*order).sortWithinPartitions(*order)
    laid_out.write.mode(mode).parquet(path)


def read_chunks(spark: SparkSession, *paths: str) -> DataFrame:
    """Chunk tables as one frame.

    Tables of other origin may lack dimensions or ``function_value``, which are null then, and
    ``n_points``, which is taken from the arrays at the price of reading their timestamps.
    """
    alike: dict[str, list[str]] = {}
    for path in paths:
        alike.setdefault(spark.read.parquet(path).schema.simpleString(), []).append(path)
    # Tables of one schema are one scan; those of another are completed by themselves.
    return reduce(DataFrame.unionByName, [_completed(spark.read.parquet(*group)) for group in alike.values()])


def _completed(stored: DataFrame) -> DataFrame:
    """One table with all columns of chunks, whatever it lacks."""
    missing = [f for f in CHUNKS.fields if f.name not in stored.columns]
    supplied = {
        f.name: series_size("points") if f.name == "n_points" else F.lit(None).cast(f.dataType)
        for f in missing
    }
    return stored.withColumns(supplied).select(*CHUNKS.names)


def query_chunks(chunks: DataFrame, predicate: Column | str | None = None) -> DataFrame:
    """Chunks that match a predicate on dimensions or time, not joined. None matches all.

    A record that holds an aggregate and no points is read as its one point. The predicate is on what
    is stored and reaches the scan.
    """
    return with_function_points(chunks if predicate is None else chunks.where(predicate))


def with_function_points(chunks: DataFrame) -> DataFrame:
    """Chunks in which a record with a function value and no points holds that value as one point in the middle of its time
    span. Chunks without ``function_value`` stay as they are."""
    if not {"function_value", "n_points"} <= set(chunks.columns):
        return chunks
    stands = (F.coalesce("n_points", F.lit(0)) == 0) & F.col("function_value").isNotNull()

    def instead(column: str, other: Column) -> Column:
        return F.when(stands, other.cast(chunks.schema[column].dataType)).otherwise(F.col(column))

    replaced = {"points": F.array(function_point()), "n_points": F.lit(1), "start": mid_time(), "end": mid_time()}
    return chunks.withColumns({column: instead(column, other) for column, other in replaced.items()})


def query_series(chunks: DataFrame, predicate: Column | str | None = None) -> DataFrame:
    """Matching chunks joined into whole series. The predicate is applied before the join."""
    return join_chunks(query_chunks(chunks, predicate))


def scan_projection(chunks: DataFrame) -> DataFrame:
    """Only data, id, start, end and the six dimensions."""
    return chunks.select(*CHUNK_COLUMNS)


def scan_sorted_by_id(chunks: DataFrame) -> DataFrame:
    """Chunks of every partition in the order of their ids; no shuffle."""
    return chunks.sortWithinPartitions("chunk_id")


def scan_time_range(chunks: DataFrame, from_ms: int, to_ms: int) -> DataFrame:
    """Chunks that touch ``[from_ms, to_ms]``, cut to the points inside it (ends included).

    The condition on ``start`` and ``end`` is what reaches the scan: chunks outside the range
    are skipped by their statistics, only the ones at its edges are filtered point by point.
    """
    if from_ms == -1 or to_ms == -1:
        raise ValueError("from_ms and to_ms must not be -1")
    if from_ms > to_ms:
        return chunks.where(F.lit(False))
    touched = chunks.where((F.col("start") <= to_ms) & (F.col("end") >= from_ms))
    inside = F.col("start").between(from_ms, to_ms) & F.col("end").between(from_ms, to_ms)
    return replace_points(
        touched, F.when(inside, F.col("points")).otherwise(points_between(from_ms, to_ms))
    )


def record_to_series(records: DataFrame) -> DataFrame:
    """Series from stored records.

    Known dimensions are kept, a dimension column the source lacks is null, other columns are
    dropped. Points come from the data; failing that from the function value, as one point in
    the middle of the time span; failing that the series is empty. A record that has neither
    data nor anything but JSON text, or no metric, fails the query.
    """
    has = set(records.columns)
    metric = F.coalesce("metric", F.raise_error(F.lit("record without metric")).cast("string"))
    dimensions = [
        metric.alias("metric"),
        *[
            (F.col(d) if d in has else F.lit(None)).cast("string").alias(d)
            for d in DIMENSIONS if d != "metric"
        ],
    ]
    points = F.when(series_size("points") > 0, F.col("points"))
    if "data_as_json" in has:
        refused = F.raise_error(F.lit("points as JSON are not supported"))
        points = points.when(
            F.col("data_as_json").isNotNull(), refused.cast(records.schema["points"].dataType)
        )
    if "function_value" in has:
        points = points.when(F.col("function_value").isNotNull(), F.array(function_point()))
    series = records.select(*dimensions, "chunk_id", "start", "end", *[
        c for c in ("points", "function_value", "data_as_json") if c in has
    ])
    return replace_points(series, points.otherwise(empty_points())).select(*CHUNK_COLUMNS)


def function_points(records: DataFrame) -> DataFrame:
    """The point that stands for the aggregate of every record holding one."""
    return (
        records.where(F.col("function_value").isNotNull())
        .select(*DIMENSIONS, "chunk_id", function_point().alias("_point"))
        .select(*DIMENSIONS, "chunk_id", "_point.timestamp", "_point.value")
    )


def convert_with(
    records: DataFrame,
    converter: Callable,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Run a converter of the caller's choice over stored records.

    Without a schema the converter is a DataFrame function. With one it is code that gets and
    yields Arrow record batches, run inside the tasks.
    """
    if schema is None:
        return records.transform(converter)
    return records.mapInArrow(converter, schema)


def resolve_collections(
    name: str, collections: Mapping[str, object], aliases: Mapping[str, str] | None = None
) -> list[str]:
    """Collection names behind a name: itself, or the comma-separated list of an alias."""
    if name in collections:
        return [name]
    members = (aliases or {}).get(name)
    if members is None:
        raise ValueError(f"collection {name} not found")
    found = [member.strip() for member in members.split(",")]
    missing = [member for member in found if member not in collections]
    if missing:
        raise ValueError(f"collection {', '.join(missing)} not found")
    return found


def scan_collections(
    name: str,
    collections: Mapping[str, DataFrame],
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """Chunks of a collection, or of all collections behind an alias, as one frame."""
    first, *others = [collections[m] for m in resolve_collections(name, collections, aliases)]
    for other in others:
        first = first.unionByName(other)
    return first


def read_collections(
    spark: SparkSession,
    name: str,
    paths: Mapping[str, str],
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """The same for collections kept as chunk tables: one scan over all their paths."""
    return read_chunks(spark, *[paths[m] for m in resolve_collections(name, paths, aliases)])
