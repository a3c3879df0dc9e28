"""Lake-path plans (E2-E4) over the fixture tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metroscope.operators import baselines, lake
from metroscope.sources import fixtures


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = fixtures.category_mapping(spark)
    return lake.to_silver(fixtures.bronze_requests(spark, sf_dir), mapping, mapping_rows=len(fixtures.CATEGORY_MAPPING))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows with re-deliveries: some requests arrive again on a later ingest day."""
    mapping = fixtures.category_mapping(spark)
    return lake.to_silver(fixtures.delivered_requests(spark, sf_dir), mapping, mapping_rows=len(fixtures.CATEGORY_MAPPING))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.category_cells(lake.latest_deliveries(lake.request_facts(deliveries(spark, sf_dir))))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.hourly(cells(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.daily(cells(spark, sf_dir))


def category_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.category_hourly(cells(spark, sf_dir))


def hourly_baselines(spark: SparkSession, sf_dir: str, lookback_hours: int = 168, min_points: int = 24) -> DataFrame:
    return baselines.hourly_baselines(hourly(spark, sf_dir), lookback_hours, min_points)
