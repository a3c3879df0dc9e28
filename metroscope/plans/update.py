"""E17 for changed days: one day's run at about one day's cost.

The daily job keeps beside its outputs what it has folded from the raw tables: one row per
(city, day) of the requests (``cards.city_days``) and of the alerts (``alert_score``). A run for
changed (city, day) cells

1. folds only those cells again, reading only the raw partitions they stand in;
2. plans how far the change reaches: a score looks back over 30 request days and 30 station
   readings, its baseline over 30 days, so scores and verdicts change from the first changed day
   to 30 days after the 30th later reading; the backlog and the card baselines run over all
   earlier days, so cards change from the first changed day on;
3. scores the cities it touches from their per-day rows and merges the planned range.

Weather and news tables hold one row per day already and are read for those cities only. The
stored days are put in place before the outputs; a run that dies in between is simply run again.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metroscope.operators import cards as cd
from metroscope.operators import merge as mg
from metroscope.operators import scoring as sc
from metroscope.operators import serving as sv
from metroscope.operators import staged
from metroscope.plans import daily
from metroscope.session import remove_scratch, scratch_path

STATE = "_days"           # folder beside the outputs
NEWEST = "_newest"        # folder beside an output table
HISTORY = 30              # rows that the score windows look back, and days of the score baseline
PARTITIONS = ("city", "month")
OUTPUTS = {"signal_scores": ("score_date", ["city", "score_date"]),
           "signal_metrics": ("metric_date", ["city", "metric_date", "metric_name"]),
           "verdicts": ("verdict_date", ["city", "verdict_date"])}


def with_month(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn("month", F.date_format(date_col, "yyyy-MM"))


def keep_days(spark: SparkSession, out_root: str, days: DataFrame, alert_days: DataFrame) -> None:
    """Store the folded days of a run over everything, in place of those stored before."""
    root = f"{out_root.rstrip('/')}/{STATE}"
    staged.recover(spark, root)
    changes = []
    for name, rows in (("requests", days), ("alerts", alert_days)):
        rows = with_month(rows.filter("d is not null"), "d")
        old = staged.stored(spark, f"{root}/{name}", rows)
        changes.append(staged.Change(name, f"{root}/{name}", PARTITIONS, rows, None if old is None else old.select(*PARTITIONS).distinct()))
    staged.commit(spark, root, changes)


def merge_outputs(spark: SparkSession, out_root: str, scores: DataFrame, cards: DataFrame) -> dict[str, DataFrame]:
    """Merge score, card and verdict rows by key into their tables (by city and month). The tables
    are independent: their merges are submitted from driver threads."""
    path = scratch_path(spark, "merge-rows")

    def merge(name: str, df: DataFrame) -> None:
        date, keys = OUTPUTS[name]
        root = f"{out_root.rstrip('/')}/{name}"
        with_month(df, date).write.parquet(f"{path}/{name}")
        rows = spark.read.parquet(f"{path}/{name}")
        mg.merge_into_path(spark, root, rows, keys, PARTITIONS, also=[newest_days(spark, root, rows, date)])

    def merge_scored() -> None:
        scores.write.parquet(f"{path}/scored")  # once, for the scores and the verdicts
        scored = spark.read.schema(scores.schema).parquet(f"{path}/scored")
        verdicts = sv.verdicts(scored).withColumn("generated_at", F.current_timestamp())
        staged.at_once(lambda: merge("signal_scores", scored), lambda: merge("verdicts", verdicts))

    try:
        staged.at_once(merge_scored, lambda: merge("signal_metrics", cards))
    finally:
        remove_scratch(spark, path)
    return {name: spark.read.parquet(f"{out_root.rstrip('/')}/{name}") for name in OUTPUTS}


def newest_days(spark: SparkSession, root: str, rows: DataFrame, date: str) -> staged.Change:
    """W14 kept by the merges: each city's newest day and its month, beside the table. Readers of
    the newest rows go straight to that partition."""
    newest = rows.groupBy("city").agg(F.max(date).alias("day"))
    old = staged.stored(spark, f"{root}/{NEWEST}", newest)
    if old is not None:
        cities = newest.select("city")
        newest = newest.unionByName(staged.in_scope(old, cities, ["city"])).groupBy("city").agg(F.max("day").alias("day"))
    return staged.Change("newest", f"{root}/{NEWEST}", ("city",), newest)


def newest_rows(spark: SparkSession, out_root: str, name: str, city: str | None = None) -> DataFrame:
    """E10, F7, F8 and W14 from a stored table: the rows of each city's newest day (or of one
    city's), read from those days' partitions only."""
    date = OUTPUTS[name][0]
    root = f"{out_root.rstrip('/')}/{name}"
    days = spark.read.parquet(f"{root}/{NEWEST}").withColumn("month", F.date_format("day", "yyyy-MM"))
    if city is not None:
        days = days.filter(F.col("city") == city)
    table = staged.in_scope(spark.read.parquet(root), days.select(*PARTITIONS), PARTITIONS)
    # one row a city on the right
    return table.join(days.select("city", F.col("day").alias(date)), ["city", date], "left_semi").drop("month")


def day_rows(spark: SparkSession, out_root: str, name: str, city: str, start: str, end: str) -> DataFrame:
    """D-8 from a stored table: one city's rows of ``start`` to ``end`` (yyyy-mm-dd, both
    included); partitions of other cities and months are not read."""
    date = OUTPUTS[name][0]
    table = spark.read.parquet(f"{out_root.rstrip('/')}/{name}")
    days = F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return table.filter((F.col("city") == city) & F.col("month").cast("string").between(start[:7], end[:7]) & days).drop("month")


def request_cells(requests: DataFrame, changed: DataFrame) -> DataFrame:
    """The folded request days of the changed cells, from their partitions alone. ``requests`` is
    the table ``jobs.requests_job`` keeps: a row per request, by city and month."""
    scope = staged.in_scope(requests, with_month(changed, "d").select(*PARTITIONS), PARTITIONS)
    folded = cd.city_days(cd.request_days(scope))
    return staged.in_scope(folded, changed, ["city", "d"])


def alert_cells(alerts: DataFrame, changed: DataFrame) -> DataFrame:
    """The strongest alert of the changed cells; ``alerts`` is the table of ``jobs.alerts_job``."""
    scope = staged.in_scope(alerts, with_month(changed, "d").select("month"), ["month"])
    return staged.in_scope(sc.alert_scores(scope), changed, ["city", "d"])


def reach(changed: DataFrame, readings: DataFrame) -> DataFrame:
    """Per city: ``lo``, the first changed day, and ``hi``, the last day whose score a change can
    reach. ``readings``: (series, city, d) - request days and station readings, each series by itself."""
    bounds = changed.groupBy("city").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    after = readings.join(bounds, "city").filter("d > hi")
    nth = after.withColumn("place", F.row_number().over(Window.partitionBy("series", "city").orderBy("d"))).filter(F.col("place") <= HISTORY)
    last = nth.groupBy("city").agg(F.max("d").alias("read"))
    return bounds.join(last, "city", "left").select("city", "lo", F.date_add(F.greatest("hi", F.ifnull("read", "hi")), HISTORY).alias("hi"))


def update_job(spark: SparkSession, requests: DataFrame, weather: DataFrame, alerts: DataFrame, news: DataFrame,
               stations: DataFrame, out_root: str, changed: DataFrame) -> dict[str, DataFrame]:
    """Bring scores, cards and verdicts up to date for ``changed`` (``city``, ``d``): every cell
    whose requests, weather, alerts or news changed since the last run (a request that moved to
    another day changed two). The outputs then equal those of a full run.

    ``requests`` and ``alerts`` are read by partition (``request_cells``, ``alert_cells``);
    ``weather``, ``news`` and ``stations`` as in ``jobs.daily_job``, which must have run once."""
    out_root = out_root.rstrip("/")
    root, path = f"{out_root}/{STATE}", scratch_path(spark, "update")
    staged.recover(spark, root)
    try:
        changed.select("city", F.col("d").cast("date").alias("d")).distinct().write.parquet(f"{path}/changed")
        changed = spark.read.parquet(f"{path}/changed")
        if changed.isEmpty():
            return {name: spark.read.parquet(f"{out_root}/{name}") for name in OUTPUTS}
        touched = with_month(changed, "d").select(*PARTITIONS).distinct()
        changes = []
        for name, rows in (("requests", request_cells(requests, changed)), ("alerts", alert_cells(alerts, changed))):
            rows = with_month(rows, "d")
            old = staged.stored(spark, f"{root}/{name}", rows)
            if old is None:
                raise RuntimeError(f"no folded days under {root}: run the daily job over everything once")
            scope = staged.in_scope(old, touched, PARTITIONS)
            stay = scope.join(changed, staged.same(scope, changed, ["city", "d"]), "left_anti")
            changes.append(staged.Change(name, f"{root}/{name}", PARTITIONS, stay.unionByName(rows), touched))
        staged.commit(spark, root, changes)

        cities = changed.select("city").distinct()
        of_cities = lambda df: staged.in_scope(df, cities, ["city"])
        days, alert_days = (of_cities(spark.read.schema(c.rows.schema).parquet(c.root)).drop("month") for c in changes)
        stations, news = of_cities(stations), of_cities(news)
        weather = weather.join(stations.select("station_id").distinct(), "station_id", "left_semi")
        di = daily.inputs_of_days(spark, days, weather, alert_days, news, stations)
        readings = di.counts.select(F.lit("requests").alias("series"), "city", "d").unionByName(
            di.weather.join(stations, "station_id").select(F.col("station_id").alias("series"), "city", F.col("obs_date").alias("d")))
        plan = reach(changed, readings)
        plan.write.parquet(f"{path}/plan")
        plan = spark.read.parquet(f"{path}/plan")
        scores = daily.scores_of(di).join(plan, "city").filter(F.col("score_date").between(F.col("lo"), F.col("hi"))).drop("lo", "hi")
        cards = daily.cards_of(di).join(plan, "city").filter(F.col("metric_date") >= F.col("lo")).drop("lo", "hi")
        return merge_outputs(spark, out_root, scores, cards)
    finally:
        remove_scratch(spark, path)
