"""The eight-step timing workload: load and join, then seven actions on the same data."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame

from tideline.operators import aggregates, flatten, joining


def run(frame: DataFrame) -> None:
    """Compute every row and column of a result without keeping it."""
    frame.write.format("noop").mode("overwrite").save()


def drain(series: DataFrame) -> None:
    """Bring every series to the driver, one partition at a time, holding none of them."""
    deque(aggregates.collect_series(series), maxlen=0)


# Step names and what they do with chunks. Only the steps that need whole series join them.
STEPS: dict[str, Callable[[DataFrame], None]] = {
    "load_and_join": lambda chunks: run(joining.join_chunks(chunks)),
    "mean": lambda chunks: run(aggregates.mean(chunks)),
    "approx_mean": lambda chunks: run(aggregates.approx_mean(chunks)),
    "count_observations": lambda chunks: run(aggregates.count_observations(chunks)),
    "max": lambda chunks: run(aggregates.maximum(chunks)),
    "min": lambda chunks: run(aggregates.minimum(chunks)),
    "collect_series": lambda chunks: drain(joining.join_chunks(chunks)),
    "dataset_count": lambda chunks: flatten.observations_dataset(chunks).count(),
}
