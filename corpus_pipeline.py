"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyphrase.llm import byte_bpe, decontaminate, near_dup, pii, site_quality
from skyphrase.llm.common import table
from skyphrase.scratch import Scratch, owned, remove


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects."""
    return site_quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: the one with the least doc_id (repeated rows of it: one)."""
    return near_dup.distinct_documents(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data; n_chars follows."""
    return pii.masked(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids, of the decoded bytes and of the offsets of every document left."""
    return byte_bpe.round_trip(docs, offsets=True)


STAGES = [
    ("quality_classifier", keep_good),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("personal_data", mask_personal_data),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``.  What a stage wrote lies in the shared folder until the next one has read it,
    and so do the operators' intermediates; only the last stage's rows stay, as the result reads them."""
    docs = table(spark, sf_dir, "documents")
    top = Scratch(spark, "pipeline").top
    for k, (name, stage) in enumerate(STAGES):
        path = f"{top}/{k}-{name}"
        with owned():  # what the stage's operators write goes once its rows are stored
            stage(spark, docs, sf_dir).write.parquet(path)
        if k:
            remove(spark, f"{top}/{k - 1}-{STAGES[k - 1][0]}")
        docs = spark.read.parquet(path)
    return docs


#: The classifier's training can't be written as SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None
