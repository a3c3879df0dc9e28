"""Article-level media operators (D-1..D-4) and the five-signal profile (D-7).

Theme and location lists are split and filtered with higher-order functions; the
location -> city lookup is a literal map (a small configured list), so no join runs.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroscope.functions.columns import clip, rnd
from metroscope.operators.frames import combine

# Stress themes (exact tokens) and the theme prefix that always counts.
STRESS_THEMES = (
    "KILL", "SHOOTING", "ARREST", "CRIME", "FLOOD", "DROUGHT", "POWER_OUTAGE",
    "WATER_SECURITY", "MANMADE_DISASTER", "NATURAL_DISASTER",
)
STRESS_PREFIX = "CRISISLEX_"


def stress_tokens(themes: Column) -> Column:
    """Theme tokens that mark stress: one of the list or any ``CRISISLEX_`` theme."""
    toks = F.split(F.coalesce(themes, F.lit("")), ";")
    return F.filter(toks, lambda t: t.isin(*STRESS_THEMES) | t.startswith(STRESS_PREFIX))


def theme_filter(articles: DataFrame) -> DataFrame:
    """D-1: keep articles with at least one stress theme; ``STRESS_THEMES`` lists them."""
    s = stress_tokens(F.col("V2Themes"))
    return articles.withColumn("_st", s).filter(F.size("_st") > 0).withColumn(
        "STRESS_THEMES", F.array_join("_st", ";")
    ).drop("_st")


def article_cities(stress_articles: DataFrame, location_to_city: Sequence[tuple[str, str]]) -> DataFrame:
    """D-2: explode locations to (article x city), keep known cities, one row per
    (date, city, url): ``DATE | CITY | SOURCEURL | STRESS_THEMES``."""
    lookup = F.create_map(*[F.lit(x) for kv in ((k.lower(), v) for k, v in location_to_city) for x in kv])
    locs = F.split(F.coalesce(F.col("V2Locations"), F.lit("")), ";")
    out = stress_articles.select(
        "article_ts", "SOURCEURL", "STRESS_THEMES",
        F.explode(F.transform(locs, lambda l: F.try_element_at(lookup, F.lower(F.trim(l))))).alias("CITY"),
    ).filter(F.col("CITY").isNotNull())
    out = out.dropDuplicates(["article_ts", "CITY", "SOURCEURL"])
    return out.select(F.date_format("article_ts", "yyyyMMddHHmmss").alias("DATE"), "CITY", "SOURCEURL", "STRESS_THEMES", "article_ts")


def articles_per_slice(city_articles: DataFrame, minutes: int = 15) -> DataFrame:
    """D-3: article count per city and time slice (tumbling window)."""
    g = city_articles.groupBy(F.window("article_ts", f"{minutes} minutes").alias("w"), "CITY").agg(
        F.count(F.lit(1)).alias("article_count")
    )
    return g.select(F.col("w.start").alias("slice_start"), F.col("CITY").alias("city"), "article_count")


def parse_tone(articles: DataFrame) -> DataFrame:
    """D-4: tone = field 0 and polarity = field 3 of the comma list; protest count = sum
    of the numbers of ``PROTEST`` entries in the ``#``-separated counts list."""
    parts = F.split(F.coalesce(F.col("V15Tone"), F.lit("")), ",")
    entries = F.split(F.coalesce(F.col("V1Counts"), F.lit("")), ";")
    protests = F.filter(entries, lambda e: F.get(F.split(e, "#"), 0) == F.lit("PROTEST"))
    total = F.aggregate(
        protests, F.lit(0).cast("long"),
        lambda acc, e: acc + F.coalesce(F.get(F.split(e, "#"), 1).try_cast("long"), F.lit(0).cast("long")),
    )
    return articles.select(
        "SOURCEURL",
        F.get(parts, 0).try_cast("double").alias("tone"),
        F.get(parts, 3).try_cast("double").alias("polarity"),
        total.alias("protest_count"),
    )


def trailing_z_score(df: DataFrame, value: str, days: int = 30, min_points: int = 7) -> Column:
    """``clip(50 + 15 z)`` rounded to 2 against the previous ``days`` calendar days of the
    same city (RANGE frame on the day number, today excluded); 50 without a valid baseline."""
    dn = F.datediff(F.col("d"), F.lit("1970-01-01"))
    w = Window.partitionBy("city").orderBy(dn).rangeBetween(-days, -1)
    m, s, n = F.avg(value).over(w), F.stddev_samp(value).over(w), F.count(value).over(w)
    z = (F.col(value) - m) / s
    valid = F.col(value).isNotNull() & (n >= min_points) & s.isNotNull() & (s > 0)
    return F.when(valid, rnd(clip(z * 15 + 50), 2)).otherwise(F.lit(50.0))


FIVE = ("tone_spike", "theme_surge", "complaint_spike", "emergency_ratio_score", "alert_severity")
FIVE_NEUTRAL = {"tone_spike": 50.0, "theme_surge": 50.0, "complaint_spike": 50.0, "emergency_ratio_score": 50.0, "alert_severity": 0.0}


def five_signals(news_daily: DataFrame, city_articles: DataFrame, lake_daily: DataFrame, alert_scores: DataFrame) -> DataFrame:
    """D-7: the five 0-100 signals and their equal-weight mean (weights and scale ours).

    Inputs are per (city, day): ``news_daily`` (avg_tone), ``city_articles`` (one row per
    stress article and city), ``lake_daily`` (infrastructure_requests, emergency_ratio),
    ``alert_scores`` (alert_score)."""
    tone = news_daily.select("city", F.col("obs_date").alias("d"), (-F.col("avg_tone")).alias("neg_tone"))
    tone = tone.select("city", "d", trailing_z_score(tone, "neg_tone").alias("tone_spike"))
    arts = city_articles.groupBy(F.lower("CITY").alias("city"), F.to_date("article_ts").alias("d")).agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    arts = arts.select("city", "d", trailing_z_score(arts, "n").alias("theme_surge"))
    lake = lake_daily.groupBy("city", F.col("window_start").alias("d")).agg(
        F.sum("infrastructure_requests").cast("double").alias("infra"),
        (F.sum("emergency_requests") / F.sum("total_requests")).alias("er"),
    )
    lake = lake.select(
        "city", "d", trailing_z_score(lake, "infra").alias("complaint_spike"),
        trailing_z_score(lake, "er").alias("emergency_ratio_score"),
    )
    alerts = alert_scores.select("city", "d", F.col("alert_score").alias("alert_severity"))
    wide = combine(["city", "d"], None, [tone, arts, lake, alerts])  # each input is read once
    vals = [F.coalesce(F.col(c), F.lit(FIVE_NEUTRAL[c])).alias(c) for c in FIVE]
    out = wide.select("city", "d", *vals)
    mean = sum((F.col(c) for c in FIVE[1:]), F.col(FIVE[0])) / len(FIVE)
    return out.withColumn("stress_score", rnd(mean, 2))
