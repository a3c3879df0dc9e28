"""Serving queries (E10, E11): latest rows, last update, month and year history.

Per-city "latest" and "newest 30" are window / max_by operations on per-(city, day)
tables, never a driver-side loop; each city's partition holds one row per day.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroscope.functions.verdict import verdict_text


def composite_view(scores: DataFrame) -> DataFrame:
    """T4: scores with ``delta = composite - baseline``; ``newest_first`` puts the view in order."""
    return scores.select(
        "city", "score_date", "composite", "composite_baseline_30d",
        (F.col("composite") - F.col("composite_baseline_30d")).alias("delta"),
        "readiness_mode", "anomaly_score", "heat_score", "alert_score", "context_score",
    )


def newest_first(view: DataFrame, date_col: str = "score_date") -> DataFrame:
    """T4: the read order of the score view (city, newest day first)."""
    return view.orderBy("city", F.desc(date_col))


def latest_per_city(df: DataFrame, date_col: str) -> DataFrame:
    """The newest row per city (``max_by`` over a struct: one aggregate, map-side combined)."""
    rest = [c for c in df.columns if c != "city"]
    g = df.groupBy("city").agg(F.max_by(F.struct(*rest), F.col(date_col)).alias("_r"))
    return g.select("city", *[F.col(f"_r.{c}").alias(c) for c in rest])


def latest_composite(scores: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """Composite, baseline, delta, mode and date of each city's newest score. A city of
    ``cities`` without scores gets zeros, mode Normal and today's date."""
    v = composite_view(scores).select("city", "score_date", "composite", "composite_baseline_30d", "delta", "readiness_mode")
    latest = latest_per_city(v, "score_date")
    if cities is None:
        return latest
    joined = cities.select("city").distinct().join(latest, "city", "left")
    numbers = [F.ifnull(c, F.lit(0.0)).alias(c) for c in ("composite", "composite_baseline_30d", "delta")]
    return joined.select("city", F.ifnull("score_date", F.current_date()).alias("score_date"), *numbers,
                         F.ifnull("readiness_mode", F.lit("Normal")).alias("readiness_mode"))


def latest_metrics(cards: DataFrame) -> DataFrame:
    """Card rows of each city's newest metric date. One pass: the per-city max
    date is a window over the city's card rows (one row per day and card), then a filter."""
    newest = F.max("metric_date").over(Window.partitionBy("city"))
    return cards.withColumn("_newest", newest).filter(F.col("metric_date") == F.col("_newest")).drop("_newest")


def verdicts(scores: DataFrame, model_id: str = "rule-based-v1") -> DataFrame:
    """One verdict row per (city, day) from its score row."""
    return scores.select(
        "city", F.col("score_date").alias("verdict_date"), verdict_text(F.col("city")).alias("verdict_text"),
        F.col("composite").alias("composite_score"), "readiness_mode", F.lit(model_id).alias("model_id"),
    )


def last_updated(runs: DataFrame, scores: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """A17 + E10 fallbacks, one row for every city of ``cities`` (or of the scores): newest successful run ('success' or 'SUCCEEDED', Q13);
    else the newest score date; else yesterday."""
    last_run = runs.filter(F.col("status").isin("success", "SUCCEEDED")).agg(F.max("run_at")).scalar()
    # a scalar subquery: evaluated once, attached as a value (no join)
    per_city = scores.groupBy("city").agg(F.max("score_date").alias("last_score"))
    if cities is not None:
        per_city = cities.select("city").distinct().join(per_city, "city", "left")
    j = per_city.withColumn("last_run", last_run)
    text = F.when(
        F.col("last_run").isNotNull(), F.concat(F.date_format("last_run", "yyyy-MM-dd HH:mm"), F.lit(" UTC"))
    ).when(F.col("last_score").isNotNull(), F.concat(F.col("last_score").cast("string"), F.lit(" (last scored date)"))).otherwise(F.lit("N/A"))
    data_date = F.when(F.col("last_run").isNotNull(), F.date_format(F.col("last_run") - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd")).when(
        F.col("last_score").isNotNull(), F.col("last_score").cast("string")
    ).otherwise(F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd"))
    return j.select("city", text.alias("last_updated"), data_date.alias("data_as_of"))


_HISTORY = ("composite", "comp_base", "tmax", "tone", "vol_311")


def _history_rows(scores: DataFrame, city_weather: DataFrame, gdelt: DataFrame, counts: DataFrame) -> DataFrame:
    """The four daily sources under one another: ``city``, ``d``, ``source`` and the history columns
    (null in the rows of other sources)."""
    sources = {
        "score": scores.select("city", F.col("score_date").alias("d"), "composite", F.col("composite_baseline_30d").alias("comp_base")),
        "weather": city_weather.select("city", F.col("obs_date").alias("d"), "tmax"),
        "news": gdelt.select("city", F.col("obs_date").alias("d"), F.col("avg_tone_7d").alias("tone")),
        "requests": counts.select("city", "d", F.col("cnt").alias("vol_311")),
    }
    tagged = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def history_month(scores: DataFrame, city_weather: DataFrame, gdelt: DataFrame, counts: DataFrame, n: int = 30) -> DataFrame:
    """J2 + A18: per city, the newest 30 scores left-joined to the newest 30 weather,
    news and 311-volume days (``counts``: city, d, cnt); base_311 = mean of the joined
    volume; nulls -> 0. One ranking over all sources, one group-by in place of the joins."""
    newest = Window.partitionBy("city", "source").orderBy(F.col("d").desc())
    rows = _history_rows(scores, city_weather, gdelt, counts).withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n)
    j = rows.groupBy("city", "d").agg(*[F.max(c).alias(c) for c in _HISTORY], F.bool_or(F.col("source") == "score").alias("scored")).filter("scored")
    j = j.withColumn("base_311", F.avg("vol_311").over(Window.partitionBy("city")))
    return j.select(
        "city", F.date_format("d", "yyyy-MM-dd").alias("date"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ("composite", "comp_base", "tmax", "tone")],
        F.coalesce(F.col("vol_311"), F.lit(0)).alias("vol_311"),
        F.coalesce(F.col("base_311"), F.lit(0.0)).alias("base_311"),
    ).orderBy("city", "date")  # T2: at most n rows a city, oldest first


def history_year(scores: DataFrame, city_weather: DataFrame, gdelt: DataFrame, counts: DataFrame) -> DataFrame:
    """J3 + A14: per city and calendar month (years merged) averages and 311 volume of the months
    that have scores; base_311 = mean monthly volume; nulls -> 0. One group-by over all sources."""
    keys = ["city", "month", "month_num"]
    rows = _history_rows(scores, city_weather, gdelt, counts)
    j = rows.groupBy("city", F.date_format("d", "MMM").alias("month"), F.month("d").alias("month_num")).agg(
        *[F.avg(c).alias(c) for c in ("composite", "comp_base", "tmax", "tone")], F.sum("vol_311").alias("vol_311"),
        F.bool_or(F.col("source") == "score").alias("scored")).filter("scored")
    j = j.withColumn("base_311", F.avg("vol_311").over(Window.partitionBy("city")))
    return j.select(
        *keys,
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("composite", "comp_base", "tmax", "tone")],
        F.coalesce(F.col("vol_311"), F.lit(0)).alias("vol_311"),
        F.coalesce(F.col("base_311"), F.lit(0.0)).alias("base_311"),
    )


def today_view(requests: DataFrame, weather: DataFrame, station_cities: DataFrame, gdelt: DataFrame) -> DataFrame:
    """D-5: per (city, day): open requests filed that day, mean close hours of closed ones
    (rounded to 1), the modal service (ties: smallest), plus the lateral picks - the
    city's first station by id for tmax / precipitation and that day's news row.
    Lateral cross joins drop a day without either pick, so these are inner joins."""
    from metroscope.functions.columns import mean_rounded

    hrs = (F.unix_micros("updated_datetime") - F.unix_micros("requested_datetime")) / F.lit(3.6e9)
    day = requests.groupBy("city", F.to_date("requested_datetime").alias("d")).agg(
        F.count_if(F.col("status") == "open").alias("open_backlog"),
        mean_rounded(F.when(F.col("status") == "closed", hrs), 1).alias("mean_close_hrs"),
        F.mode("service_name", deterministic=True).alias("top_category"),
    )
    wx = weather.join(station_cities, "station_id").groupBy("city", F.col("obs_date").alias("d")).agg(
        F.min_by(F.struct("tmax", F.col("precip_6hr_max").alias("prcp")), "station_id").alias("_w")
    )
    g = gdelt.select("city", F.col("obs_date").alias("d"), "avg_tone", F.col("protest_event_count").alias("protest_count"))
    return day.join(wx, ["city", "d"]).join(g, ["city", "d"]).select(
        "city", "d", "open_backlog", "mean_close_hrs", "top_category",
        F.col("_w.tmax").alias("tmax"), F.col("_w.prcp").alias("prcp"), "avg_tone", "protest_count",
    )
