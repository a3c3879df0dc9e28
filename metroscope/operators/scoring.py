"""Daily signal scoring (E7) for every city and date at once.

W7 anomaly, W8 heat, A13 alert, X8 context, J5 assembly, X9 composite, W9 30-day
baseline and X7 readiness. Every window runs on per-(city|station, day) rows that are
already aggregated, so partitions are bounded by days, not by raw volume. The four
signals are assembled with one union + one aggregate on (city, date) - a single
exchange instead of four joins.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroscope.functions.columns import clip, mean_rounded, ordinal, pyround, rnd
from metroscope.operators.frames import combine

# Alert ordinal scales and signal weights.
SEVERITY = (("Extreme", 4), ("Severe", 3), ("Moderate", 2), ("Minor", 1), ("Unknown", 0))
URGENCY = (("Immediate", 3), ("Expected", 2), ("Future", 1), ("Past", 0), ("Unknown", 0))
CERTAINTY = (("Observed", 3), ("Likely", 2), ("Possible", 1), ("Unlikely", 0), ("Unknown", 0))
WEIGHTS = {"anomaly": 0.35, "heat": 0.30, "alert": 0.20, "context": 0.15}
# Earlier three-signal profile (documented alternative): weights for anomaly, heat, context.
LEGACY_WEIGHTS = {"anomaly": 0.40, "heat": 0.35, "context": 0.25}
NEUTRAL = {"anomaly_score": 50.0, "heat_score": 50.0, "alert_score": 0.0, "context_score": 50.0}
SIGNALS = ("anomaly_score", "heat_score", "alert_score", "context_score")


def daily_request_counts(requests: DataFrame) -> DataFrame:
    """Requests per (city, request day)."""
    return requests.groupBy("city", F.to_date("requested_datetime").alias("d")).agg(F.count(F.lit(1)).alias("cnt"))


def anomaly_scores(counts: DataFrame, history_rows: int = 30) -> DataFrame:
    """today's count against the mean of the previous ``history_rows`` days *with data*;
    ``clip(pct*80+50)`` rounded to 2, 50 without history or with a zero baseline.

    The raw value is projected first so the rounding reads a column, not a copy of the
    window expression."""
    w = Window.partitionBy("city").orderBy("d").rowsBetween(-history_rows, -1)
    b = F.col("_b")
    raw = counts.select("city", "d", "cnt", F.avg("cnt").over(w).alias("_b")).select(
        "city", "d", b, F.when(b.isNotNull() & (b != 0), clip((F.col("cnt") - b) / b * 80 + 50)).alias("_raw")
    )
    score = F.when(b.isNull() | (b == 0), F.lit(50.0)).otherwise(pyround(F.col("_raw"), 2))
    return raw.select("city", "d", score.alias("anomaly_score"))


def heat_scores_by_station(weather: DataFrame, history_rows: int = 30) -> DataFrame:
    """W8 per station series: heat index when today has one, else tmax; z against the same
    column's mean and sample std over the previous rows; ``clip(z*15+50)``; 50 when
    the value, mean or std is missing or the std is 0."""
    w = Window.partitionBy("station_id").orderBy("obs_date").rowsBetween(-history_rows, -1)
    hi, tx = F.col("heat_index_max"), F.col("tmax")
    use_hi = hi.isNotNull()
    val = F.coalesce(hi, tx)
    stats = weather.select(
        "station_id", "obs_date", val.alias("_v"), use_hi.alias("_hi"),
        F.avg(hi).over(w).alias("_mh"), F.stddev_samp(hi).over(w).alias("_sh"),
        F.avg(tx).over(w).alias("_mt"), F.stddev_samp(tx).over(w).alias("_st"),
    )
    mean = F.when(F.col("_hi"), F.col("_mh")).otherwise(F.col("_mt"))
    std = F.when(F.col("_hi"), F.col("_sh")).otherwise(F.col("_st"))
    missing = F.col("_v").isNull() | mean.isNull() | std.isNull() | (std == 0)
    raw = stats.select("station_id", "obs_date", missing.alias("_missing"),
                       F.when(~missing, clip((F.col("_v") - mean) / std * 15 + 50)).alias("_raw"))
    score = F.when(F.col("_missing"), F.lit(50.0)).otherwise(pyround(F.col("_raw"), 2))
    return raw.select("station_id", "obs_date", score.alias("heat_score"))


def heat_scores(weather: DataFrame, station_cities: DataFrame) -> DataFrame:
    """Q21: one series per station, then the max per city and day.

    ``station_cities`` is a configured dimension (a handful of rows per city). No hint
    is forced: Spark broadcasts it from its size estimate (``autoBroadcastJoinThreshold``,
    AQE runtime statistics) and falls back to a shuffle join if it were ever large."""
    per_station = heat_scores_by_station(weather)
    j = per_station.join(station_cities, "station_id")
    return j.groupBy("city", F.col("obs_date").alias("d")).agg(F.max("heat_score").alias("heat_score"))


def alert_score_expr(sev: Column, urg: Column, cert: Column) -> Column:
    """Severity x urgency x certainty / 36 x 100 (unknown text -> 0)."""
    return ordinal(sev, SEVERITY) * ordinal(urg, URGENCY) * ordinal(cert, CERTAINTY) / 36 * 100


def alert_scores(alerts: DataFrame) -> DataFrame:
    """The strongest alert per (city, day), rounded to 2 (no alert -> 0 at assembly)."""
    s = alert_score_expr(F.col("severity"), F.col("urgency"), F.col("certainty"))
    return alerts.groupBy("city", F.col("obs_date").alias("d")).agg(pyround(F.max(s), 2).alias("alert_score"))


def context_raw(tone: Column, protests: Column) -> Column:
    """X8 before rounding: ``min(100,|tone|/8*100)*0.7 + min(100,protests/20*100)*0.3``; null when
    the tone is null, null protest count -> term 0 (Q19)."""
    tone_s = F.least(F.lit(100.0), F.abs(tone) / 8 * 100)
    # least() skips nulls, so the null case is handled before it
    prot_s = F.when(protests.isNotNull(), F.least(F.lit(100.0), protests / 20 * 100)).otherwise(F.lit(0.0))
    return F.when(tone.isNotNull(), tone_s * 0.7 + prot_s * 0.3)


def context_score_expr(tone: Column, protests: Column) -> Column:
    """Rounded to 2; a null tone scores 50."""
    return F.coalesce(pyround(context_raw(tone, protests), 2), F.lit(50.0))


def context_scores(gdelt: DataFrame) -> DataFrame:
    """X8 per (city, day): rounded to 2, a null tone scores 50."""
    raw = gdelt.select("city", F.col("obs_date").alias("d"),
                       context_raw(F.col("avg_tone_7d"), F.col("protest_event_count")).alias("_raw"))
    return raw.select("city", "d", F.coalesce(pyround(F.col("_raw"), 2), F.lit(50.0)).alias("context_score"))


def date_spine(*city_days: DataFrame) -> DataFrame:
    """One row per city and calendar day from its first to its last day in any source.

    Built with ``sequence`` + ``explode`` per city (no join)."""
    days = reduce(DataFrame.unionByName, [d.select("city", "d") for d in city_days])
    bounds = days.groupBy("city").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    return bounds.select("city", F.explode(F.sequence("lo", "hi")).alias("d"))


def assemble(spine: DataFrame, anomaly: DataFrame, heat: DataFrame, alert: DataFrame, context: DataFrame) -> DataFrame:
    """Spine left-joined to the four signals with defaults 50 / 50 / 0 / 50,
    written as union + group-by (one shuffle on (city, d))."""
    g = combine(["city", "d"], spine.select("city", "d"), [anomaly, heat, alert, context])
    return g.select("city", "d", *[F.coalesce(F.col(s), F.lit(NEUTRAL[s])).alias(s) for s in SIGNALS])


def composite_raw() -> Column:
    """X9 before rounding: the weighted sum."""
    return (F.col("anomaly_score") * WEIGHTS["anomaly"] + F.col("heat_score") * WEIGHTS["heat"]
            + F.col("alert_score") * WEIGHTS["alert"] + F.col("context_score") * WEIGHTS["context"])


def composite_expr() -> Column:
    """Weighted sum rounded to 2 (apply to a frame where the four scores are columns)."""
    return pyround(composite_raw(), 2)


def readiness_expr(composite: Column, baseline: Column) -> Column:
    """Delta < 10 Normal, < 25 Elevated, else High (both inputs already rounded)."""
    delta = composite - baseline
    return F.when(delta < 10, "Normal").when(delta < 25, "Elevated").otherwise("High")


def with_composite(signals: DataFrame, history_rows: int = 30) -> DataFrame:
    """X9 + W9 + X7: composite, mean of the previous 30 composites (rounded, falls back
    to today's), readiness mode."""
    w = Window.partitionBy("city").orderBy("d").rowsBetween(-history_rows, -1)
    s = signals.withColumn("_raw", composite_raw()).withColumn("composite", pyround(F.col("_raw"), 2)).drop("_raw")
    s = s.withColumn("composite_baseline_30d", F.coalesce(mean_rounded(F.col("composite"), 2, over=w), F.col("composite")))
    return s.withColumn("readiness_mode", readiness_expr(F.col("composite"), F.col("composite_baseline_30d")))


def score_signals(
    requests: DataFrame,
    weather: DataFrame,
    station_cities: DataFrame,
    alerts: DataFrame,
    gdelt: DataFrame,
) -> DataFrame:
    """E7 from raw requests and alerts: ``signal_scores`` rows for all cities and days."""
    return score_daily(daily_request_counts(requests), weather, station_cities, alert_scores(alerts), gdelt)


def score_daily(
    counts: DataFrame,
    weather: DataFrame,
    station_cities: DataFrame,
    alert_daily: DataFrame,
    gdelt: DataFrame,
    spine: DataFrame | None = None,
) -> DataFrame:
    """E7 from the per-(city, day) inputs: request counts, weather, alert scores, news
    (and optionally a precomputed calendar spine)."""
    anomaly = anomaly_scores(counts)
    heat = heat_scores(weather, station_cities)
    alert = alert_daily
    context = context_scores(gdelt)
    spine = spine if spine is not None else date_spine(counts, heat, alert, context)
    scored = with_composite(assemble(spine, anomaly, heat, alert, context))
    return scored.select(
        "city", F.col("d").alias("score_date"), *SIGNALS, "composite", "composite_baseline_30d", "readiness_mode"
    )


def legacy_profile(signals: DataFrame, weather_city: DataFrame, gdelt: DataFrame) -> DataFrame:
    """D-10: the earlier three-signal formula as an alternative profile:
    heat = clip((tmax-5)/35*100), context = clip(|tone|/8*100), weights .40/.35/.25."""
    tw = weather_city.select("city", F.col("obs_date").alias("d"), "tmax")
    tone = gdelt.select("city", F.col("obs_date").alias("d"), "avg_tone")
    j = signals.select("city", "d", "anomaly_score").join(tw, ["city", "d"], "left").join(tone, ["city", "d"], "left")
    heat = F.coalesce(clip((F.col("tmax") - 5) / 35 * 100), F.lit(50.0))
    ctx = F.coalesce(clip(F.abs(F.col("avg_tone")) / 8 * 100), F.lit(50.0))
    comp = rnd(
        F.col("anomaly_score") * LEGACY_WEIGHTS["anomaly"] + heat * LEGACY_WEIGHTS["heat"] + ctx * LEGACY_WEIGHTS["context"], 2
    )
    return j.select("city", F.col("d").alias("score_date"), "anomaly_score", rnd(heat, 2).alias("heat_score"),
                    rnd(ctx, 2).alias("context_score"), comp.alias("composite"))
