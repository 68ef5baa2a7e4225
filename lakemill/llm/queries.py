"""Registered queries of the training-data operators, one opN_<name> for each, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import chat_template, decontaminate, exact_dedup, html_extract, language_id, license_scan, line_dedup, near_dedup, piece_sampling, quality_classifier, quality_rules, vector_codes, whitening
from lakemill.llm.common import table
from lakemill.llm.oracles import ORACLES  # noqa: F401  (the entry reads it here)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_recurring(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, sample_no, ids, n_pieces, log_prob, inclusion, round_trip: two segmentations of every document."""
    return piece_sampling.encode(table(spark, sf_dir, "documents")).withColumn("n_pieces", F.size("ids"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return chat_template.read_back(chat_template.format_conversations(rows.unionByName(probe)), ordered=True)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dedup, op2_line_dedup, op3_quality_rules, op4_piece_sampling, op5_decontamination,
        op6_license_scan, op7_html_extraction, op8_language_id, op9_quality_classifier, op10_chat_formatting,
        op11_embedding_whitening, op12_exact_dedup, op13_vector_codes,
    )
}
