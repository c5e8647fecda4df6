"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm.decontaminate import overlaps
from tideline.llm.embeddings import near_vectors
from tideline.llm.html import main_texts
from tideline.llm.licenses import license_labels, license_notices
from tideline.llm.minhash import near_duplicates
from tideline.llm.periods import periodic_runs, run_digests, with_periodic_tails
from tideline.llm.phrases import collocations
from tideline.llm.pieces import op3_sentencepiece as encode_documents
from tideline.llm.quality import resample
from tideline.llm.scoring import backoff_scores
from tideline.llm.shared import table
from tideline.llm.suffix import removal_digests
from tideline.llm.urls import op5_url_filters
from tideline.llm.warc import op10_warc


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(table(spark, sf_dir, "documents"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(spark, table(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[1]


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), 0.98)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents"))))


def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(license_notices(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_suffix_array": op1_suffix_array,
    "op2_html": op2_html,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_minhash": op4_minhash,
    "op5_url_filters": op5_url_filters,
    "op6_decontamination": op6_decontamination,
    "op7_embeddings": op7_embeddings,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_quality": op9_quality,
    "op10_warc": op10_warc,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_license_scans": op12_license_scans,
    "op13_collocations": op13_collocations,
}
