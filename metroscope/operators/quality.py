"""Data-quality checks: F1 required-field validation and D-9 quality report.

Counts come from one aggregate per table; the drift statistic runs on per-day counts,
partitioned by table (never an unpartitioned window). Column drift compares a day's histogram
with the merged histograms of the days before it; histograms are counts in fixed bins, so they
merge by adding and can be kept per day.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Required fields per table.
REQUIRED = {
    "requests_311": ("service_request_id", "status", "requested_datetime"),
    "weather_daily": ("station_id", "obs_date", "tmax"),
    "gdelt_daily": ("city", "obs_date", "avg_tone"),
}


def _missing_any(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def drop_invalid(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """rows with every required field present."""
    return df.dropna(subset=list(required))


def validate_counts(df: DataFrame, table: str, date_col: Column, required: Sequence[str] | None = None) -> DataFrame:
    """F1 report: per (table, day) rows read, rows dropped for a missing field, rows kept."""
    req = required or REQUIRED[table]
    g = df.groupBy(date_col.alias("obs_date")).agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(_missing_any(req)).alias("rows_dropped")
    )
    return g.select(F.lit(table).alias("table_name"), "obs_date", "rows_in", "rows_dropped",
                    (F.col("rows_in") - F.col("rows_dropped")).alias("rows_kept"))


def quality_report(daily_counts: DataFrame) -> DataFrame:
    """D-9: per table total rows, rows missing a required field, days covered, newest day,
    its row count and its drift z-score against all earlier days (ours: sample std)."""
    w = Window.partitionBy("table_name").orderBy("obs_date").rowsBetween(Window.unboundedPreceding, -1)
    z = daily_counts.select(
        "*",
        F.avg("rows_in").over(w).alias("_m"),
        F.stddev_samp("rows_in").over(w).alias("_s"),
    ).withColumn("drift_z", F.when(F.col("_s") > 0, (F.col("rows_in") - F.col("_m")) / F.col("_s")))
    return z.groupBy("table_name").agg(
        F.sum("rows_in").alias("row_count"),
        F.sum("rows_dropped").alias("rows_missing_required"),
        F.count(F.lit(1)).alias("days"),
        F.max("obs_date").alias("last_day"),
        F.max_by("rows_in", "obs_date").alias("last_day_count"),
        F.max_by("drift_z", "obs_date").alias("drift_z"),
    )


# Population stability index from which a day's column counts as drifted, the days it is compared
# with, and how many of them it takes.
DRIFTED, REFERENCE_DAYS, LEAST_DAYS = 0.25, 28, 7
TEXT_BINS = 16


def column_profiles(df: DataFrame, table: str, date_col: Column, numbers: dict[str, float], texts: Sequence[str] = ()) -> DataFrame:
    """One row per (column, day, bin) with its number of rows ``n``: ``numbers`` (column -> bin
    width) are cut into equal widths, ``texts`` into ``TEXT_BINS`` by their digest. Bin null
    counts the nulls (and what is no number). One pass over ``df``; adding ``n`` merges profiles of
    batches or days."""
    def cell(name: str, b: Column) -> Column:
        return F.struct(F.lit(name).alias("column_name"), b.cast("string").alias("bin"))

    def number_bin(c: Column, width: float) -> Column:
        known = c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
        return F.when(known, F.floor(c / F.lit(width)))

    cells = [cell(c, number_bin(F.col(c).cast("double"), w)) for c, w in numbers.items()]
    cells += [cell(c, F.substring(F.md5(F.col(c).cast("binary")), 1, 1)) for c in texts]
    rows = df.select(date_col.cast("date").alias("obs_date"), F.explode(F.array(*cells)).alias("c"))
    counted = rows.groupBy("obs_date", "c.column_name", "c.bin").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.lit(table).alias("table_name"), "column_name", "obs_date", "bin", "n")


def column_drift(profiles: DataFrame, days: int = REFERENCE_DAYS, limit: float = DRIFTED) -> DataFrame:
    """D-9 per (table, column, day): rows, nulls, the population stability index of the day's
    histogram (nulls are a bin of it) against the merged ``days`` days with data before it, and
    whether that is above ``limit`` (not before ``LEAST_DAYS`` earlier days).

    Each bin counts one half more than it holds, on both sides, so that an empty bin has a
    share. Windows run over a column's (day, bin) grid, whatever the number of raw rows."""
    merged = profiles.filter("obs_date is not null").groupBy("table_name", "column_name", "obs_date", "bin").agg(F.sum("n").alias("n"))
    keys = ["table_name", "column_name"]
    by_day = Window.partitionBy(*keys).orderBy("obs_date")
    every_day = merged.groupBy(*keys, "obs_date").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("bin").isNull(), F.col("n")).otherwise(0)).alias("n_null")).withColumn(
        "place", F.row_number().over(by_day))
    bins = merged.select(*keys, F.ifnull("bin", F.lit("null")).alias("bin")).distinct()
    held = merged.select(*keys, "obs_date", F.ifnull("bin", F.lit("null")).alias("bin"), "n")
    grid = every_day.join(bins, keys).join(held, [*keys, "obs_date", "bin"], "left").fillna(0, ["n"])
    before = Window.partitionBy(*keys, "bin").orderBy("obs_date").rowsBetween(-days, -1)
    grid = grid.withColumn("reference", F.ifnull(F.sum("n").over(before), F.lit(0)))
    day = Window.partitionBy(*keys, "obs_date")
    size = F.count(F.lit(1)).over(day) * 0.5
    p = (F.col("n") + 0.5) / (F.sum("n").over(day) + size)
    q = (F.col("reference") + 0.5) / (F.sum("reference").over(day) + size)
    parts = grid.select(*keys, "obs_date", "n_rows", "n_null", "place", ((p - q) * F.log(p / q)).alias("part"))
    found = parts.groupBy(*keys, "obs_date", "n_rows", "n_null", "place").agg(F.sum("part").alias("psi"))
    enough = F.col("place") > LEAST_DAYS
    return found.select(*keys, "obs_date", "n_rows", "n_null", F.when(enough, F.col("psi")).alias("psi"),
                        (enough & (F.col("psi") > limit)).alias("drifted"))
