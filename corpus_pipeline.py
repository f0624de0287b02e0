"""A training corpus from raw documents: filter, deduplicate, decontaminate,
mask secrets, mix sources.

``STAGES`` lists the steps in order; each takes the documents its predecessor
kept and returns those it keeps, with the columns of ``documents`` - the last
one returns the mix.  Between stages the documents are written and read again,
so every stage has its own lineage and no stage is computed twice.

Empty tables, null and empty texts, repeated rows and null ids pass through
each stage as its operator says; extra columns of the documents are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spacetime.llm import decontamination, mixing, quality_rules, secret_scan, simhash
from spacetime.llm.common import documents, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a learned cutoff rejects go."""
    return quality_rules.accepted(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the first by id."""
    return simhash.one_per_group(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a test item go."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return secret_scan.redact(docs, secret_scan.train(docs), length_col="n_chars")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken so that sources meet their targets."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("secret scans", secrets),
    ("source mix", source_mix),
]

#: Trained tagging, SimHash groups and the iterated mix have no SQL form; the
#: tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the mix."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
