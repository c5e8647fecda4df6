"""The test tables seen as observations and chunks (FIXTURES.md says how they map)."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.points import series_end, series_start, whole_div
from tideline.model import DIMENSIONS
from tideline.sources.build import build_chunks
from tideline.sources.chunks import read_chunks, write_chunks
from tideline.sources.extract import new_path

DAY_MS = 86_400_000

_written: dict[tuple[str | None, str, str], str] = {}
_lock = threading.Lock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz_millis(column: str) -> Column:
    """Epoch milliseconds of a zone-less timestamp, whatever the session time zone is."""
    return F.expr(
        f"({column} - timestamp_ntz'1970-01-01 00:00:00') div interval '0.001' second"
    )


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("user_id") % 10
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("metric"),
        F.concat(F.lit("h"), b).alias("host"),
        F.concat(F.lit("m"), b % 2).alias("measurement"),
        F.when(b % 3 != 0, F.concat(F.lit("p"), b % 4)).alias("process"),
        F.lit(None).cast("string").alias("ag"),
        F.when(F.col("event_type") == "error", "alert").otherwise("usage").alias("group"),
        ntz_millis("ts").alias("timestamp"),
        "value",
        "event_id",
    )


def lineitem_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("metric"),
        F.concat(F.lit("s"), F.col("l_suppkey")).alias("host"),
        *[nothing.alias(d) for d in DIMENSIONS[2:]],
        ntz_millis("l_shipdate").alias("timestamp"),
        F.col("l_extendedprice").alias("value"),
        "l_orderkey",
        "l_linenumber",
        F.year("l_shipdate").alias("year"),
    )


def derive_event_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chunk per series and UTC day."""
    rows = event_observations(spark, sf_dir)
    return build_chunks(rows, period=whole_div("timestamp", DAY_MS), tie_break=["event_id"])


def derive_lineitem_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chunk per series and calendar year."""
    rows = lineitem_observations(spark, sf_dir)
    return build_chunks(rows, period=F.col("year"), tie_break=["l_orderkey", "l_linenumber"])


def derive_sampled_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as near-regular samples: one a minute by event number, off by up to 15 ms.

    Chunks of 500 samples. This is the kind of series the offset codec is made for.
    """
    number = F.col("event_id")
    nothing = F.lit(None).cast("string")
    rows = table(spark, sf_dir, "events").select(
        F.lit("sampled").alias("metric"),
        *[nothing.alias(d) for d in DIMENSIONS[1:]],
        (F.lit(1_700_000_000_000) + number * 60_000 + F.pmod("user_id", F.lit(16))).alias("timestamp"),
        "value",
        "event_id",
    )
    return build_chunks(rows, period=whole_div("event_id", 500), tie_break=["event_id"])


def _stored(
    spark: SparkSession, sf_dir: str, name: str, derive: Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    """The derived chunks as a chunk table in the shared folder, written once per application.

    Queries then start where they would in practice, at chunks at rest that every executor can
    read again after a loss. Without a shared folder the chunks are derived in the query.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _lock:
        if key not in _written:
            path = new_path(spark, name)
            if path is None:
                return derive(spark, sf_dir)
            write_chunks(derive(spark, sf_dir), path)
            _written[key] = path
    return read_chunks(spark, _written[key])


def event_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "events", derive_event_chunks)


def lineitem_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "lineitem", derive_lineitem_chunks)


def sampled_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "sampled", derive_sampled_chunks)


def interleaved_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day chunk dealt out into two by odd and even timestamps; both halves are kept."""
    halves = F.array(*[
        F.struct(
            F.lit(half).alias("half"),
            F.filter("points", lambda p: F.pmod(p["timestamp"], F.lit(2)) == half).alias("points"),
        )
        for half in (0, 1)
    ])
    split = event_chunks(spark, sf_dir).select(
        *DIMENSIONS, "chunk_id", F.explode(halves).alias("_half")
    )
    return (
        split.where(F.array_size("_half.points") > 0)
        .select(
            *DIMENSIONS,
            F.concat_ws("|", "chunk_id", "_half.half").alias("chunk_id"),
            series_start("_half.points").alias("start"),
            series_end("_half.points").alias("end"),
            F.array_size("_half.points").cast("bigint").alias("n_points"),
            F.col("_half.points").alias("points"),
        )
    )


def mean_value() -> Column:
    """Mean of a chunk's values, summed in whole hundredths: the same in any order."""
    hundredths = F.aggregate(
        "points.value",
        F.lit(0).cast("bigint"),
        lambda total, v: total + F.round(v * 100).cast("bigint"),
    )
    return hundredths.cast("double") / 100 / F.array_size("points.value")


def function_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day chunk a record without points that holds the mean of its values."""
    return event_chunks(spark, sf_dir).select(
        *DIMENSIONS, "chunk_id", "start", "end",
        F.filter("points", lambda p: F.lit(False)).alias("points"),
        mean_value().alias("function_value"),
    )


def mixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored records of all three kinds: every day chunk with its points, and for each one record that holds its mean and
    one that holds nothing.

    They carry a field that is no dimension, and no JSON text.
    """
    kind = F.col("_kind")
    nothing = F.filter("points", lambda p: F.lit(False))
    records = event_chunks(spark, sf_dir).withColumn("_kind", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
    return records.select(
        *DIMENSIONS,
        F.when(kind == 0, F.col("chunk_id")).when(kind == 1, F.concat("chunk_id", F.lit("|mean"))).otherwise(F.concat("chunk_id", F.lit("|none"))).alias("chunk_id"),
        "start", "end",
        F.when(kind == 0, F.col("points")).otherwise(nothing).alias("points"),
        F.when(kind == 1, mean_value()).alias("function_value"),
        F.lit(None).cast("string").alias("data_as_json"),
        F.lit("collector").alias("agent"),
    )


def offset_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day chunks as offsets; offsets divisible by four are left out as a repeat of the last."""
    times = F.col("points.timestamp")
    before = F.concat(F.slice(times, 1, 1), times)      # one longer than the times: its last one is cut off again
    steps = F.slice(F.zip_with(times, before, lambda t, b: t - b), F.lit(1), F.array_size(times))
    return event_chunks(spark, sf_dir).select(
        *DIMENSIONS, "chunk_id", "start", "end",
        F.transform(steps, lambda s: F.when(s % 4 == 0, F.lit(0)).otherwise(s)).alias("offsets"),
        F.col("points.value").alias("values"),
    )
