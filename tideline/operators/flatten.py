"""From series or chunks to flat rows, one per point. Each is a projection with an explode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.points import millis_to_time
from tideline.model import DIMENSIONS, FLAT_COLUMNS, FLAT_OBSERVATIONS


def values(frame: DataFrame) -> DataFrame:
    """All values as one column. Reads no timestamps. Takes observations as well."""
    if "points" not in frame.columns:
        return frame.select("value")
    return frame.select(F.explode("points.value").alias("value"))


def observations(frame: DataFrame) -> DataFrame:
    """Dimensions, timestamp and value of every point; empty series give no row."""
    if "points" not in frame.columns:
        return frame.select(*DIMENSIONS, "timestamp", "value")
    return frame.select(*DIMENSIONS, F.explode("points").alias("_point")).select(
        *DIMENSIONS,
        F.col("_point.timestamp").alias("timestamp"),
        F.col("_point.value").alias("value"),
    )


def to_dataframe(frame: DataFrame) -> DataFrame:
    """Observations with the SQL timestamp ``time``, nine columns by name."""
    return observations(frame).withColumn("time", millis_to_time("timestamp")).select(*FLAT_COLUMNS)


def observations_dataset(frame: DataFrame) -> DataFrame:
    """``to_dataframe`` held to the declared schema: a column that does not fit is an error."""
    return to_dataframe(frame).to(FLAT_OBSERVATIONS)
