"""The corpus pipeline: documents go through the stages in order.

Each stage is a function of (spark, docs, sf_dir) and works on all documents that its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.decontaminate import decontaminated
from tideline.llm.minhash import near_duplicates
from tideline.llm.pieces import encoded
from tideline.llm.quality import resample
from tideline.llm.shared import stored, table
from tideline.llm.suffix import without_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier draws."""
    return resample(docs, table(spark, sf_dir, "labels"))[0]


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every group of near-duplicates: five words, similarity 0.8."""
    dropped = stored(near_duplicates(docs, size=5, percent=80).where("not kept").select("doc_id").distinct())
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 bytes and more that documents of smaller id hold too."""
    cut = without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    back = encoded(docs, exact=True)
    return back.select(*docs.columns, "ids", F.size("ids").cast("bigint").alias("n_tokens"), "exact")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("repeat_dedup", repeat_dedup),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]

#: Fitting, connected components and Viterbi have no SQL; the tests hold the operators of the stages against brute force, but not ``run`` as a whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
