"""The registered queries: each applies one operator with its production parameters to
its whole table and returns the contract's columns."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroscope.llm import (
    chat, decontaminate, epsilon_grid, interpolation, licenses, pieces, quality_cnn, redirects, resampling, runs, simhash,
    surrogates, thresholds,
)
from metroscope.llm.common import crc_mod, documents


TABLES_KEY = "synthetic tables"  # a user's key is a secret of their own


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return surrogates.settled_private(docs, TABLES_KEY, count_col="n_replaced").select("doc_id", "n_replaced", "text")


def op2_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.judge_urls(documents(spark, sf_dir, "pages")).drop("component")


def op3_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thresholds.adaptive_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(documents(spark, sf_dir), pieces.read_model(), with_ids=False)


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark")).drop("text_hash")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op8_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    return chat.digests(turns.unionByName(extra))


def op9_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score_documents(documents(spark, sf_dir))


def op10_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_cnn.train(docs, documents(spark, sf_dir, "labels"))
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    return quality_cnn.score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark")).drop("n_words")


def op12_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epsilon_grid.near_duplicates(documents(spark, sf_dir, "embeddings"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(documents(spark, sf_dir), prepare=runs.planted).drop("n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_surrogates": op1_surrogates,
    "op2_redirects": op2_redirects,
    "op3_adaptive_rules": op3_adaptive_rules,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_winnowing": op5_winnowing,
    "op6_licenses": op6_licenses,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_chat_template": op8_chat_template,
    "op9_interpolation": op9_interpolation,
    "op10_quality_cnn": op10_quality_cnn,
    "op11_resampling": op11_resampling,
    "op12_epsilon_grid": op12_epsilon_grid,
    "op13_runs": op13_runs,
}
