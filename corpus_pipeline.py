"""The corpus pipeline: quality classifier, line dedup, near-dedup, decontamination, segmentation sampling.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as the next one's
docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import decontaminate, line_dedup, near_dedup, piece_sampling, quality_classifier
from lakemill.llm.common import table, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go, but for the first; so do documents left without words."""
    return line_dedup.drop_recurring(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_dedup.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document as piece ids, decoded and compared."""
    return piece_sampling.encode(docs).withColumn("n_pieces", F.size("ids"))


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_recurring_lines),
    ("near-dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("piece sampling", encoded),
]

#: hashing, sketches and sampling have no SQL form; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
