"""Small helpers: input tables, tables kept in the shared folder, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.sources.extract import is_local


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one only where that is unset,
    and then only on a local master, where driver and executors are one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def small_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """From now on Arrow batches that the session hands to Python hold at most ``size`` bytes, or one row: whole texts of ten thousand
    rows would take many times their size in every worker and beside it. A smaller bound that is set already stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = re.match(r"\d+$", spark.conf.get(name).removesuffix("b"))
    if not held or not 0 < int(held[0]) <= size:
        spark.conf.set(name, str(size))


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that hands back to the system what Arrow's pool holds unused, before and after its
    task: a reused worker keeps the memory that earlier tasks and stages freed."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()
        yield from run(batches)
        pa.default_memory_pool().release_unused()
    return wrapped


def stored(frame: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder and read back: lineage ends there, and a lost
    executor loses nothing of it."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/tideline-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def mixed(*columns: Column) -> Column:
    """A 64-bit key of several columns."""
    return F.xxhash64(*columns)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b: bigint, any order, repeats allowed).

    Returns (id, component_id), one row per vertex that has an edge, component_id the smallest
    vertex reachable. Every round takes the smallest label among a vertex and its neighbours and
    then the label of that label, so paths halve; a round is two joins whose sums combine before
    they are shuffled, and nothing but one number per round comes to the driver.
    """
    pairs = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a <> b")
    both = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near"))
                    .select("id", F.least("id", "near").alias("label")))
    total = None
    while True:
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now is None or now == total:
            return labels.select("id", F.col("label").alias("component_id"))
        total = now
        near = (both.join(labels, both.b == labels.id)
                .groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near")))
        step = labels.join(near, "id").select("id", F.least("label", "near").alias("label"))
        target = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        labels = stored(step.join(target, "label", "left")
                        .select("id", F.least("label", F.coalesce("further", "label")).alias("label")))
