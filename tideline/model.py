"""Data model: six dimensions, timestamped points and the table shapes built from them.

Three table shapes run through the whole package, all plain DataFrames:

* observations - one row per point, dimensions flattened. Splittable at row level.
* chunks - one row per stored slice of a series, points in an array of bounded length.
  ``n_points`` repeats that length, so that work on chunk headers need not read the arrays.
* series - chunks of one identity joined in order. A series longer than the row bound
  comes as several consecutive rows (see ``operators.joining``), never as one huge row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The dimension ids in ordinal order.
DIMENSIONS = ("metric", "host", "measurement", "process", "ag", "group")

# Column order of the flat observation frame.
FLAT_COLUMNS = (
    "ag", "group", "host", "measurement", "metric", "process", "time", "timestamp", "value",
)

# Most points one chunk row is meant to hold, and most points one series row is meant to hold.
# A point takes about 32 bytes in an array of structs, so these are rows of 0.3 MB and 3 MB.
MAX_CHUNK_POINTS = 10_000
MAX_SERIES_ROW_POINTS = 100_000

_DIMENSION_FIELDS = [
    T.StructField(name, T.StringType(), name != "metric") for name in DIMENSIONS
]

POINT = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("value", T.DoubleType()),
])
POINTS = T.ArrayType(POINT)

OBSERVATIONS = T.StructType([
    *_DIMENSION_FIELDS,
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("value", T.DoubleType(), False),
])

CHUNKS = T.StructType([
    *_DIMENSION_FIELDS,
    T.StructField("chunk_id", T.StringType(), False),
    T.StructField("start", T.LongType(), False),
    T.StructField("end", T.LongType(), False),
    T.StructField("n_points", T.LongType(), False),
    T.StructField("points", POINTS),
    T.StructField("function_value", T.DoubleType()),
])

# A stored record as a source may hand it over: like a chunk, but it may carry its data as JSON
# text instead. Further columns are allowed and ignored.
RECORDS = T.StructType([
    *[field for field in CHUNKS.fields if field.name != "n_points"],
    T.StructField("data_as_json", T.StringType()),
])

FLAT_OBSERVATIONS = T.StructType([
    T.StructField("ag", T.StringType()),
    T.StructField("group", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("measurement", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("process", T.StringType()),
    T.StructField("time", T.TimestampType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("value", T.DoubleType()),
])


def dimension_by_id(name: str) -> str | None:
    """The dimension with this id, or None if there is none."""
    return name if name in DIMENSIONS else None


def dimension_by_ordinal(ordinal: int) -> str | None:
    """The dimension at this position of ``DIMENSIONS``, or None if there is none."""
    return DIMENSIONS[ordinal] if 0 <= ordinal < len(DIMENSIONS) else None


def attribute(dimension: str | int) -> Column:
    """Value of one dimension, asked for by id or ordinal. An unknown one gives null."""
    known = (
        dimension_by_ordinal(dimension) if isinstance(dimension, int)
        else dimension_by_id(dimension)
    )
    return F.lit(None).cast("string") if known is None else F.col(known)


def dimension_label(dimensions: Iterable[str] = DIMENSIONS) -> Column:
    """Dimensions as text: ``id:value`` pairs one after the other, null spelled ``null``."""
    return F.concat(*[
        F.concat(F.lit(f"{name}:"), F.coalesce(F.col(name), F.lit("null"))) for name in dimensions
    ])
