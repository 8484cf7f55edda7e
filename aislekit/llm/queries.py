"""Queries of this subpackage: name -> function(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aislekit.llm import decontamination, license_scan, url_filters
from aislekit.llm._common import table


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aislekit.llm import warc

    return warc.op4_warc(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op5_decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.op6_url_filters(table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aislekit.llm import toxicity

    return toxicity.op7_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aislekit.llm import lm_scoring

    return lm_scoring.op1_lm_scoring(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aislekit.llm import near_dup

    return near_dup.op2_near_dup(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aislekit.llm import packing

    return packing.op3_best_fit_packing(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aislekit.llm import sharding

    return sharding.op8_sharding(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aislekit.llm import fingerprints

    return fingerprints.op9_fingerprints(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aislekit.llm import token_counts

    return token_counts.op10_token_counts(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.op11_license_scan(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aislekit.llm import alignment

    return alignment.op12_alignment(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aislekit.llm import spelling

    return spelling.op13_spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_lm_scoring, op2_near_dup, op3_best_fit_packing, op4_warc, op5_decontamination, op6_url_filters, op7_toxicity, op8_sharding, op9_fingerprints, op10_token_counts, op11_license_scan, op12_alignment, op13_spelling_variants)
}

ORACLE_SQL: dict[str, str] = {"op5_decontamination": decontamination.ORACLE_SQL, "op6_url_filters": url_filters.ORACLE_SQL,
                              "op11_license_scan": license_scan.oracle_sql()}
