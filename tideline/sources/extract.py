"""Extracts: the chunks of one query saved for offline use, and the folder shared by a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tideline.sources.chunks import CHUNK_COLUMNS, read_chunks


def write_extract(chunks: DataFrame, path: str) -> str:
    """Save chunks to ``path`` as they come. Every task writes its own file."""
    chunks.select(*CHUNK_COLUMNS).write.mode("errorifexists").parquet(path)
    return path


def read_extract(spark: SparkSession, path: str) -> DataFrame:
    return read_chunks(spark, path).select(*CHUNK_COLUMNS)


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process: ``local-cluster[...]`` starts several."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Unset on a local master a temporary folder does; unset on a cluster there is none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if is_local(spark):
        return tempfile.mkdtemp(prefix="tideline-")
    return None


def new_path(spark: SparkSession, name: str) -> str | None:
    """A path below the shared folder that no other run uses, None without such a folder."""
    folder = shared_folder(spark)
    return None if folder is None else f"{folder}/tideline-{name}-{uuid.uuid4().hex}"
