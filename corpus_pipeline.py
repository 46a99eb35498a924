"""The corpus pipeline: STAGES in order, each written as Parquet and reread as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattlane.llm.common import read_table, stage
from wattlane.llm.decontam import drop_contaminated
from wattlane.llm.langid import keep_identified
from wattlane.llm.line_dedup import LineDedupConfig, drop_boilerplate
from wattlane.llm.minhash import drop_near_duplicates
from wattlane.llm.mixing import mix_sources

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: a tenth of op3's ratio, which its SQL fixes: the lowest round share that empties no document at any size (see README)
LINES = LineDedupConfig(max_ratio=0.01)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters or between two languages go."""

    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source."""

    return drop_boilerplate(docs, cfg=LINES)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""

    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""

    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words taken of each document that is left, by the sources' target weights."""

    return mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: SQL can't express the learned stage and the near-duplicate groups together; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every stage's result is staged in the shared folder."""

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    for _name, step in STAGES[-1:]:
        docs = step(spark, docs, sf_dir)
    return docs
