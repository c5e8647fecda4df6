"""Time the registered queries and the eight-step workload, print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores of the local master.
Every query writes its whole result to the noop sink. Building the chunk tables is timed on its
own; what follows reads them back from disk, step by step, and once more from the cache.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tideline.plans import tables  # noqa: E402
from tideline.plans.queries import QUERIES  # noqa: E402
from tideline.plans.workload import STEPS, run  # noqa: E402


def timed(work: Callable[[], None]) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tideline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds: dict[str, float] = {}
    # One small job first, so that starting the engine is not charged to the first query.
    run(tables.table(spark, sf_dir, "events").groupBy("event_type").count())
    seconds["build_event_chunks"] = timed(lambda: tables.event_chunks(spark, sf_dir))
    seconds["build_lineitem_chunks"] = timed(lambda: tables.lineitem_chunks(spark, sf_dir))
    seconds["build_sampled_chunks"] = timed(lambda: tables.sampled_chunks(spark, sf_dir))

    for name, query in QUERIES.items():
        seconds[name] = timed(lambda: run(query(spark, sf_dir)))

    sources = {
        "events": tables.event_chunks(spark, sf_dir),
        "lineitem": tables.lineitem_chunks(spark, sf_dir),
    }
    for source, chunks in sources.items():
        for name, step in STEPS.items():
            seconds[f"workload_{source}_{name}"] = timed(lambda: step(chunks))
        cached = chunks.cache()
        seconds[f"cached_{source}_fill"] = timed(cached.count)
        for name, step in STEPS.items():
            seconds[f"cached_{source}_{name}"] = timed(lambda: step(cached))
        cached.unpersist()

    print(json.dumps({
        "metric": "total seconds of all registered queries and the eight-step workload",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("/sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
