"""The corpus pipeline: documents through quality rules, near-duplicate removal, benchmark
decontamination, secret redaction and mixing. Each stage is written as Parquet and read
again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadshift.llm import common as C
from loadshift.llm import op2_mixing, op3_quality, op5_decontam, op6_secrets, op7_jaccard


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines are removed; documents that the rules reject go."""
    return op3_quality.clean(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates stays: the one with the smallest id."""
    return op7_jaccard.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return op5_decontam.clean(docs, C.table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live secrets are masked in the text; widely copied examples and all documents stay."""
    return op6_secrets.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every scheduled occurrence of every document, with epoch, block and position."""
    return op2_mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
]

# Connected components and code-point spans of the middle stages are not expressible in
# SQL; tests/llm checks every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = C.materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
