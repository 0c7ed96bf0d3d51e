"""The corpus pipeline: documents to shards in five stages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from isobar.llm import classifier, decontam, mixing, neardup, sharding
from isobar.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; without a model all stay."""
    return classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (5-word shingles, 80 %)."""
    return neardup.keep_one(docs, neardup.near_duplicates(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go, and documents that consist of them for more than a half.

    Items shorter than a window count by that share alone.
    """
    return decontam.cleaned(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its place in it."""
    return sharding.shard(docs, keep=docs.columns)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: A trained classifier and hashed draws have no SQL form; the tests hold the
#: pipeline against a brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
