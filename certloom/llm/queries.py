"""Registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontamination, filter_audit, language_id, lexical_search, license_scan, packing, quality_classifier,
    quality_rules, simhash_dedup, sql, substring_dedup, suffix_dedup, toxicity, url_filter)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scans(spark, sf_dir):
    return license_scan.digest(_table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark, sf_dir):
    return quality_classifier.digest(_table(spark, sf_dir, "documents"))


def op3_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark, sf_dir):
    return quality_rules.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_substring_dedup(spark, sf_dir):
    return substring_dedup.digest(_table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark, sf_dir):
    return simhash_dedup.digest(_table(spark, sf_dir, "documents"))


def op7_language_id(spark, sf_dir):
    return language_id.digest(_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark, sf_dir):
    return packing.digest(_table(spark, sf_dir, "documents"))


def op9_url_filters(spark, sf_dir):
    return url_filter.digest(_table(spark, sf_dir, "pages"))


def op10_benchmark_decontamination(spark, sf_dir):
    return decontamination.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_ranked_lexical_search(spark, sf_dir):
    return lexical_search.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_toxicity(spark, sf_dir):
    return toxicity.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_filter_interaction_audit(spark, sf_dir):
    return filter_audit.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


REGISTRY = {f.__name__: f for f in (
    op1_license_scans, op2_quality_classifier, op3_suffix_array_dedup, op4_quality_rules, op5_substring_dedup,
    op6_simhash_near_dedup, op7_language_id, op8_best_fit_packing, op9_url_filters, op10_benchmark_decontamination,
    op11_ranked_lexical_search, op12_toxicity, op13_filter_interaction_audit)}
ORACLE_SQL = sql.ORACLE_SQL
