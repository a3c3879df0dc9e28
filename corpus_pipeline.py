"""The corpus pipeline: five stages over ``documents``, each one operator of
``metroscope.llm`` applied to everything its predecessor kept.

1. quality: documents that the byte-level network rejects go (none, where ``labels`` teaches it nothing);
2. near_dedup: one document of each SimHash component stays;
3. decontaminate: documents contaminated by ``benchmark`` go;
4. surrogates: personal data are replaced in the text;
5. encode: SentencePiece token ids.

All but the last return the columns of ``documents``; each result is written as Parquet
and read again as the next stage's input.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroscope.llm import decontaminate, pieces, quality_cnn, simhash, surrogates
from metroscope.llm.common import documents, drop_written, written

TABLES_KEY = "synthetic tables"  # a user's key is a secret of their own


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_cnn.keep_good(docs, quality_cnn.train(docs, documents(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def private_replaced(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = surrogates.settled_private(docs, TABLES_KEY)
    if "n_chars" in docs.columns:  # the text's own length, which a replacement can change
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text")).cast("long"))
    return out.select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(docs, pieces.read_model())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("surrogates", private_replaced),
    ("encode", encoded),
]

# The trained network, keyed hashes and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, given = documents(spark, sf_dir), True
    for name, stage in STAGES:
        result = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if not given:
            drop_written(docs)  # the stage before; nothing reads it any more
        docs, given = result, False
    return docs
