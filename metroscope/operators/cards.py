"""Metric cards (E8) for every city and day: A9-A11, W10-W12, U2.

All eight cards are computed as wide columns on the (city, day) spine and stacked into
the tall ``signal_metrics`` form once (U2), instead of eight separate jobs and a union.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroscope.functions.columns import exact_mean, mean_rounded, pyround, sum_units

from metroscope.operators.frames import combine

CARD_NAMES = (
    "open_backlog", "mean_close_hrs", "top_category", "tmax",
    "heat_streak_days", "media_tone_7d", "protest_mentions", "precip_72hr_mm",
)


def request_days(requests: DataFrame) -> DataFrame:
    """The one pass over raw requests the cards and scores need: per (city, day,
    service, status) the request count and the fixed-point sum / count of resolution
    hours. Everything downstream reads this small table."""
    return requests.groupBy("city", F.to_date("requested_datetime").alias("d"), "service_name", "status").agg(
        F.count(F.lit(1)).alias("n"),
        sum_units(F.col("resolution_hrs")).alias("close_units"),
        F.count("resolution_hrs").alias("close_n"),
    )


def daily_counts(rdays: DataFrame) -> DataFrame:
    """Requests per (city, day)."""
    return rdays.groupBy("city", "d").agg(F.sum("n").alias("cnt"))


def city_days(rdays: DataFrame) -> DataFrame:
    """One row per (city, day) of everything cards and scores need of the requests: ``cnt`` (A8),
    ``opened`` (open requests filed that day), ``mean_close_hrs`` (A10), ``top_category`` (A11)."""
    day_rows = rdays.repartition("city", "d")  # both aggregates below stay within it
    closed = F.col("status") == "closed"
    per_service = day_rows.groupBy("city", "d", "service_name").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("status") == "open", F.col("n"))).alias("opened"),
        F.sum(F.when(closed, F.col("close_units"))).alias("close_units"), F.sum(F.when(closed, F.col("close_n"))).alias("close_n"))
    return per_service.groupBy("city", "d").agg(
        F.sum("n").alias("cnt"), F.ifnull(F.sum("opened"), F.lit(0)).alias("opened"),
        exact_mean(F.sum("close_units"), F.sum("close_n"), 2).alias("mean_close_hrs"),
        F.min_by("service_name", F.struct((-F.col("n")).alias("k"), F.col("service_name").alias("s"))).alias("top_category"))


def backlog_of(days: Column) -> Column:
    """A9 as a window: running sum of the open requests filed up to each day (current status, Q8)."""
    so_far = Window.partitionBy("city").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(F.ifnull(days, F.lit(0))).over(so_far)


def open_backlog(spine: DataFrame, days: DataFrame) -> DataFrame:
    """Open requests requested on or before d, on the spine (union + window, no range join)."""
    known = combine(["city", "d"], spine.select("city", "d"), [days.select("city", "d", "opened")])
    return known.select("city", "d", backlog_of(F.col("opened")).alias("open_backlog"))


def mean_close_hours(rdays: DataFrame) -> DataFrame:
    """A10: mean resolution hours of closed requests requested on d, rounded to 2 (Q9),
    exact from the fixed-point sums."""
    closed = rdays.filter(F.col("status") == "closed")
    return closed.groupBy("city", "d").agg(
        exact_mean(F.sum("close_units"), F.sum("close_n"), 2).alias("mean_close_hrs")
    ).filter(F.col("mean_close_hrs").isNotNull())


def top_category(rdays: DataFrame) -> DataFrame:
    """The most requested service on d; ties go to the smallest name."""
    c = rdays.groupBy("city", "d", "service_name").agg(F.sum("n").alias("cnt"))
    return c.groupBy("city", "d").agg(
        F.min_by("service_name", F.struct((-F.col("cnt")).alias("k"), F.col("service_name").alias("n"))).alias("top_category")
    )


def station_spine(spine: DataFrame, station_cities: DataFrame) -> DataFrame:
    """(station, city, d) for each spine day. The station dimension is a small configured
    table; Spark picks the broadcast from its size estimate (no unchecked hint)."""
    return spine.join(station_cities, "city")


def station_cards(weather: DataFrame, st_spine: DataFrame, hot_index: float = 40.0, hot_tmax: float = 35.0) -> DataFrame:
    """W11, W12 and the tmax card per (city, d), the largest of the city's stations, from one pass over the
    station days:

    ``heat_streak_days``: consecutive station rows back from d (inclusive) with heat index
    > 40 or tmax > 35, counted in rows (Q10); a day without a row has the streak of the
    latest row before it. ``precip_72hr_mm``: precipitation of the days [d-2, d], null -> 0,
    rounded to 2; ``tmax``: the warmest reading on d, rounded to 1.

    Readings and calendar days meet in one group per station and day; both cards are
    then windows over the same partition and order (one exchange, one sort)."""
    measured = [F.col(c) if c in weather.columns else F.lit(None).cast("double").alias(c) for c in ("tmax", "heat_index_max", "precip_6hr_max")]
    readings = weather.select("station_id", F.col("obs_date").alias("d"), *measured, F.lit(1).alias("row"))
    days = st_spine.select("station_id", "d").unionByName(readings, allowMissingColumns=True).groupBy("station_id", "d").agg(
        *[F.max(c).alias(c) for c in ("tmax", "heat_index_max", "precip_6hr_max")], F.ifnull(F.max("row"), F.lit(0)).alias("row"))
    hot = F.ifnull((F.col("heat_index_max") > hot_index), F.lit(False)) | F.ifnull((F.col("tmax") > hot_tmax), F.lit(False))
    by_day = Window.partitionBy("station_id").orderBy(F.datediff("d", F.lit("1970-01-01")))
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    counted = days.select("station_id", "d", "tmax", (~hot & (F.col("row") == 1)).alias("cold"), F.sum("row").over(so_far).alias("rows"),
                          F.sum("precip_6hr_max").over(by_day.rangeBetween(-2, 0)).alias("rain"))
    last_cold = F.max(F.when(F.col("cold"), F.col("rows"))).over(so_far)
    per_station = counted.select("station_id", "d", "tmax", (F.col("rows") - F.ifnull(last_cold, F.lit(0))).alias("streak"), "rain")
    return st_spine.join(per_station, ["station_id", "d"]).groupBy("city", "d").agg(
        F.max("streak").cast("int").alias("heat_streak_days"), pyround(F.ifnull(F.max("rain"), F.lit(0.0)), 2).alias("precip_72hr_mm"),
        pyround(F.max("tmax"), 1).alias("tmax"))


def heat_streak(weather: DataFrame, st_spine: DataFrame) -> DataFrame:
    """W11 alone."""
    return station_cards(weather, st_spine).select("city", "d", "heat_streak_days")


def precip_72h(weather: DataFrame, st_spine: DataFrame) -> DataFrame:
    """W12 alone."""
    return station_cards(weather, st_spine).select("city", "d", "precip_72hr_mm")


def _truthy_num(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


def card_baseline(value: Column, prior_mean: Column, need_value: bool) -> tuple[Column, Column]:
    """delta_pct = round((x-b)/b*100, 2) when b (and x, for some cards) is truthy,
    else 0.0; baseline = b when truthy, else x."""
    ok = _truthy_num(prior_mean) & (_truthy_num(value) if need_value else F.lit(True))
    delta = F.when(ok, pyround((value - prior_mean) / prior_mean * 100, 2)).otherwise(F.lit(0.0))
    base = F.when(_truthy_num(prior_mean), prior_mean).otherwise(value.cast("double"))
    return delta, base


def metric_cards(
    spine: DataFrame,
    days: DataFrame,
    weather: DataFrame,
    station_cities: DataFrame,
    gdelt: DataFrame,
    baseline_rows: int | None = None,
) -> DataFrame:
    """The eight cards per (city, day) in tall form, from the per-day request table
    (``city_days``), the weather and news daily tables.

    ``baseline_rows=None`` averages all earlier stored values (Q6 default); an int
    limits the card baseline to that many earlier days."""
    st = station_spine(spine, station_cities)
    news = gdelt.select("city", F.col("obs_date").alias("d"), pyround(F.col("avg_tone_7d"), 3).alias("media_tone_7d"),
                        F.col("protest_event_count").alias("protest_mentions"), F.lit(True).alias("_has_news"))
    wide = combine(["city", "d"], spine.select("city", "d"),
                   [days.select("city", "d", "opened", "mean_close_hrs", "top_category"), station_cards(weather, st), news])
    wide = wide.withColumns({"_has_news": F.coalesce("_has_news", F.lit(False)), "open_backlog": backlog_of(F.col("opened"))})
    lo = Window.unboundedPreceding if baseline_rows is None else -baseline_rows
    w = Window.partitionBy("city").orderBy("d").rowsBetween(lo, -1)
    wide = wide.select(
        "*",
        mean_rounded(F.col("open_backlog"), 6, over=w).alias("_b_ob"),
        mean_rounded(F.col("mean_close_hrs"), 6, over=w).alias("_b_mc"),
        mean_rounded(F.col("tmax"), 6, over=w).alias("_b_tx"),
    )
    d_ob, b_ob = card_baseline(F.col("open_backlog"), F.col("_b_ob"), need_value=False)
    d_mc, b_mc = card_baseline(F.col("mean_close_hrs"), F.col("_b_mc"), need_value=True)
    d_tx, b_tx = card_baseline(F.col("tmax"), F.col("_b_tx"), need_value=True)
    nd = F.lit(None).cast("double")
    ns = F.lit(None).cast("string")

    def card(name: str, num: Column, text: Column, delta: Column, base: Column) -> Column:
        return F.struct(F.lit(name).alias("metric_name"), num.cast("double").alias("value_num"),
                        text.alias("value_text"), delta.alias("delta_pct"), base.alias("baseline"))

    cards = F.array(
        card("open_backlog", F.col("open_backlog"), ns, d_ob, b_ob),
        card("mean_close_hrs", F.col("mean_close_hrs"), ns, d_mc, b_mc),
        card("top_category", nd, F.coalesce(F.col("top_category"), F.lit("N/A")), nd, nd),
        card("tmax", F.col("tmax"), ns, d_tx, b_tx),
        card("heat_streak_days", F.coalesce(F.col("heat_streak_days"), F.lit(0)), ns, nd, nd),
        card("media_tone_7d", F.col("media_tone_7d"), ns, nd, nd),
        card("protest_mentions", F.when(F.col("_has_news"), F.col("protest_mentions")).otherwise(F.lit(0)), ns, nd, nd),
        card("precip_72hr_mm", F.coalesce(F.col("precip_72hr_mm"), F.lit(0.0)), ns, nd, nd),
    )
    tall = wide.select("city", F.col("d").alias("metric_date"), F.inline(cards))
    return tall
