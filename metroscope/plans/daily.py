"""Daily-path plans (E5-E11) over the fixture tables, all cities and days at once."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroscope.operators import cards as cd
from metroscope.operators import collectors as co
from metroscope.operators import merge as mg
from metroscope.operators import news as nw
from metroscope.operators import scoring as sc
from metroscope.operators import serving as sv
from metroscope.session import scratch_path
from metroscope.sources import fixtures as fx

CITIES = fx.CITIES


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """``requests_311``: W13 keep-latest by id, then M4 resolution hours."""
    raw = fx.requests_daily(spark, sf)
    return mg.resolution_hours(mg.keep_latest(raw, ["service_request_id"], ["updated_datetime"]))


def weather(spark: SparkSession, sf: str) -> DataFrame:
    return fx.weather_daily(spark, sf)


def stations(spark: SparkSession) -> DataFrame:
    return fx.station_cities(spark)


def city_list(spark: SparkSession) -> DataFrame:
    """The configured cities, with or without data."""
    return spark.createDataFrame([(c,) for c in CITIES], "city string")


def city_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Weather per (city, day): the city's stations folded with max (Q21)."""
    j = weather(spark, sf).join(stations(spark), "station_id")
    return j.groupBy("city", "obs_date").agg(F.max("tmax").alias("tmax"), F.max("heat_index_max").alias("heat_index_max"))


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return co.parse_alerts(fx.alert_features(spark, sf))


def gdelt(spark: SparkSession, sf: str) -> DataFrame:
    return nw.gdelt_daily(fx.news_events(spark, sf), CITIES)


def materialize(spark: SparkSession, df: DataFrame, name: str = "daily") -> DataFrame:
    """Cut lineage: write a small daily table as parquet under the shared checkpoint
    folder once (one job; ``checkpoint(eager=True)`` would compute it twice), so every
    consumer reads it instead of re-scanning the raw tables. A lost executor never
    forces a recomputation from raw data."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


@dataclass(frozen=True)
class DailyInputs:
    """Per-(city | station, day) inputs of the daily path. Each raw table is read once."""

    days: DataFrame  # requests folded to one row per (city, day)
    counts: DataFrame  # requests per (city, day)
    weather: DataFrame  # per (station, day)
    stations: DataFrame
    alert_daily: DataFrame  # strongest alert per (city, day)
    gdelt: DataFrame  # per (city, day)
    spine: DataFrame  # (city, d) calendar spine


def inputs(spark: SparkSession, sf: str, city: str | None = None, until: str | None = None) -> DailyInputs:
    """The per-day inputs of all cities, or of one, and of all days or of those up to ``until`` (no
    window looks ahead). The filters stand on the raw rows: other cities and later days are
    neither folded nor scored."""
    def some(df: DataFrame, day: Column, by_city: bool = True) -> DataFrame:
        if city and by_city:
            df = df.filter(F.col("city") == city)
        return df.filter(day < F.date_add(F.lit(until).cast("date"), 1)) if until else df

    st = stations(spark)
    wx = weather(spark, sf)
    if city:
        st = st.filter(F.col("city") == city)
        wx = wx.join(st.select("station_id").distinct(), "station_id", "left_semi")
    news = nw.gdelt_daily(fx.news_events(spark, sf), [city] if city else CITIES)
    return inputs_of(spark, some(requests(spark, sf), F.col("requested_datetime")), some(wx, F.col("obs_date"), False),
                     some(alerts(spark, sf), F.col("obs_date")), some(news, F.col("obs_date")), st)


def inputs_of(spark: SparkSession, requests: DataFrame, weather: DataFrame, alerts: DataFrame, news: DataFrame,
              stations: DataFrame) -> DailyInputs:
    """Build the four per-day tables from request, weather, alert and news rows. They are
    independent, so their jobs are submitted concurrently from driver threads (Spark
    schedules them side by side on the cluster); the calendar spine derives from them."""
    from concurrent.futures import ThreadPoolExecutor

    plans = {
        "city-days": lambda: cd.city_days(cd.request_days(requests)),
        "weather-daily": lambda: weather,
        "alert-daily": lambda: sc.alert_scores(alerts),
        "news-daily": lambda: news,
    }
    with ThreadPoolExecutor(max_workers=len(plans)) as pool:
        futures = {k: pool.submit(lambda k=k, f=f: materialize(spark, f(), k)) for k, f in plans.items()}
        done = {k: fut.result() for k, fut in futures.items()}
    return _inputs(done["city-days"], done["weather-daily"], done["alert-daily"], done["news-daily"], stations)


def inputs_of_days(spark: SparkSession, days: DataFrame, weather: DataFrame, alert_days: DataFrame, news: DataFrame,
                   stations: DataFrame) -> DailyInputs:
    """The same from tables that are folded to days already."""
    return _inputs(days, weather, alert_days, news, stations)


def _inputs(days: DataFrame, wx: DataFrame, al: DataFrame, gd: DataFrame, st: DataFrame) -> DailyInputs:
    counts = days.select("city", "d", "cnt")
    heat_days = wx.join(st, "station_id").select("city", F.col("obs_date").alias("d"))
    # a few thousand rows from the four small tables: Spark reuses its exchange where it is read twice
    spine = sc.date_spine(counts, heat_days, al, gd.select("city", F.col("obs_date").alias("d")))
    return DailyInputs(days, counts, wx, st, al, gd, spine)


def scores(spark: SparkSession, sf: str, di: DailyInputs | None = None) -> DataFrame:
    return scores_of(di or inputs(spark, sf))


def scores_of(di: DailyInputs) -> DataFrame:
    return sc.score_daily(di.counts, di.weather, di.stations, di.alert_daily, di.gdelt, di.spine)


def spine(spark: SparkSession, sf: str) -> DataFrame:
    return inputs(spark, sf).spine


def cards(spark: SparkSession, sf: str, baseline_rows: int | None = None, di: DailyInputs | None = None) -> DataFrame:
    return cards_of(di or inputs(spark, sf), baseline_rows)


def cards_of(di: DailyInputs, baseline_rows: int | None = None) -> DataFrame:
    return cd.metric_cards(di.spine, di.days, di.weather, di.stations, di.gdelt, baseline_rows)


def city_weather_of(wx: DataFrame, st: DataFrame) -> DataFrame:
    j = wx.join(st, "station_id")
    return j.groupBy("city", "obs_date").agg(F.max("tmax").alias("tmax"), F.max("heat_index_max").alias("heat_index_max"))


def verdicts(spark: SparkSession, sf: str) -> DataFrame:
    return sv.verdicts(scores(spark, sf))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return co.normalize_runs(fx.run_events(spark, sf))
