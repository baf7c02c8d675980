"""One registered query per operator, over whole tables, with the operators' own parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laborstar.llm import chat, decontam, fingerprint, langid, linededup, lm, mixing, quality, repair, simhash, substring, toxicity, whitening

# Records of an Arrow batch: texts may be long, so batches have few rows.
ARROW_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(chat.with_probe(table(spark, sf_dir, "conversations")))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(table(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_benchmark_decontamination, op3_simhash_near_dedup, op4_chat_formatting, op5_document_fingerprints,
    op6_substring_dedup, op7_source_mixing, op8_quality_classifier, op9_lm_scoring, op10_line_dedup, op11_embedding_whitening,
    op12_conversation_repair, op13_toxicity)}


def queries() -> dict:
    def with_batches(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        return run

    return {name: with_batches(fn) for name, fn in QUERIES.items()}
