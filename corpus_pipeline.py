"""From documents to training sequences: the stages, and a run of all of them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import mixing, packing, pii, quality_rules, simhash
from newsloom.session import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs, quality_rules.PIPELINE_RULES)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without personal data and the terms that disclose it."""
    return pii.sanitise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: their length, the documents in them and the text."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("PII", personal_data),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]
# Patterns, fingerprints and packing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of `sf_dir`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
