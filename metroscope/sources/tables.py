"""Reading the given parquet tables (column pruning and filter pushdown are Catalyst's)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def ensure_utc(spark: SparkSession) -> None:
    """All jobs compute in UTC (the source data are UTC wall-clock timestamps)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    ensure_utc(spark)
    return spark.read.parquet(path(sf_dir, name))
