"""Queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality

    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality(table(spark, sf_dir, "documents"), trusted)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .byte_bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), offsets=True)


def op3_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_lists import filter_urls, page_captures, page_list

    pages = table(spark, sf_dir, "pages")
    out = filter_urls(page_captures(pages), page_list(pages))
    return out.withColumn("fetched", out["fetched"].cast("string"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import personal_data

    return personal_data(table(spark, sf_dir, "documents"))


def op6_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chunk_dedup import repeated_spans

    return repeated_spans(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


def op10_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .site_quality import site_quality

    return site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import clusters

    return clusters(table(spark, sf_dir, "embeddings"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .main_text import extract, trained

    pages = table(spark, sf_dir, "pages")
    return extract(pages, trained(pages))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic_runs import digests, periodic_runs, planted

    docs = table(spark, sf_dir, "documents")
    return digests(periodic_runs(docs.select("doc_id", planted(docs["doc_id"], docs["text"]).alias("text"))))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op")}
