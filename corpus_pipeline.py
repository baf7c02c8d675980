"""Corpus pipeline over ``documents``: drop low quality, drop repeated lines, keep one document of
each near-duplicate group, remove benchmark passages, mix the sources to target weights.

Each stage takes (spark, docs, sf_dir), calls one operator of ``laborstar.llm`` and returns a
DataFrame; ``run`` writes each stage's rows to the shared folder and gives them to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laborstar.llm import decontam, linededup, mixing, quality, simhash
from laborstar.llm._store import stored
from laborstar.llm.queries import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts."""
    return linededup.dedup(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the mix to the shared folder and tells how many words of each document it took."""
    return mixing.report(docs, "pipeline-mix")


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage)]
ORACLE_SQL = None      # the classifier is not SQL; tests compare every stage with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
