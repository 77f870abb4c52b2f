"""The corpus pipeline: five operators of ``certloom.llm`` in a row.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet to
the shared checkpoint folder and read again as the next one's documents.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certloom.llm import decontamination, packing, quality_rules, simhash_dedup, substring_dedup
from certloom.llm.textops import materialize


def _free(docs: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forest reject go."""
    return quality_rules.filter_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component stays."""
    return simhash_dedup.deduplicate(docs, shingle=3, distance=3)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has go; ``n_chars`` follows the text."""
    out = substring_dedup.remove_repeats(docs, out_col=_free(docs, "repeats")).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    found = _free(docs, "contamination")
    out = decontamination.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out_col=found)
    return out.where(~F.col(f"{found}.contaminated")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed piece."""
    return packing.digest(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL cannot express the isolation forest, SimHash or the tokenizer; tests hold the stages against
#: brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
