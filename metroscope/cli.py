"""Command line for the batch jobs, with the parameters the reference's jobs take.

    python -m metroscope.cli bronze --landing-root L --bronze-root R
    python -m metroscope.cli silver --bronze-root R --mapping-file M --silver-root S [--from-day D]
    python -m metroscope.cli aggregate --silver-file S --hourly-output-root H --daily-output-root D --category-output-root C
                                       [--from-day D] [--state-root T]
    python -m metroscope.cli baselines --input-root H --output-root B [--lookback-hours 168] [--min-history-points 24]
    python -m metroscope.cli news --export-path E --cities boston chicago --events-root V --news-root N
    python -m metroscope.cli weather   --observations-path P --daily-values-path D --weather-root W
    python -m metroscope.cli alerts    --features-path P --alerts-root A
    python -m metroscope.cli requests  --records-path P --city C --requests-root Q [--socrata]
    python -m metroscope.cli run-log   --events-path P --log-root L
    python -m metroscope.cli stream    --landing-root L --target T --checkpoint K [--delay "2 days"]
    python -m metroscope.cli update    (the roots of daily) --days D [D ...] [--cities C ...]
    python -m metroscope.cli daily --requests-root Q --weather-root W --alerts-root A --news-root N --stations-csv T
                                   --output-root O [--start D] [--end D]

Under spark-submit the cluster's master and settings apply; ``--spark-master`` and
``--shuffle-partitions`` only fill in what the session does not set.
"""
from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from metroscope.plans import jobs, update
from metroscope.sources import io
from metroscope.streaming import hourly


def session(args: argparse.Namespace) -> SparkSession:
    b = SparkSession.builder.appName(args.app_name)
    if args.spark_master:
        b = b.master(args.spark_master)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    return spark


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="metroscope")
    ap.add_argument("--app-name", default="metroscope")
    ap.add_argument("--spark-master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=0)
    sub = ap.add_subparsers(dest="job", required=True)
    z = sub.add_parser("bronze")
    z.add_argument("--landing-root", required=True)
    z.add_argument("--bronze-root", required=True)
    s = sub.add_parser("silver")
    s.add_argument("--bronze-root", required=True)
    s.add_argument("--mapping-file", required=True)
    s.add_argument("--silver-root", required=True)
    s.add_argument("--from-day", default=None)
    a = sub.add_parser("aggregate")
    a.add_argument("--silver-file", required=True)
    a.add_argument("--hourly-output-root", required=True)
    a.add_argument("--daily-output-root", required=True)
    a.add_argument("--category-output-root", required=True)
    a.add_argument("--from-day", default=None)
    a.add_argument("--state-root", default=None)
    b = sub.add_parser("baselines")
    b.add_argument("--input-root", required=True)
    b.add_argument("--output-root", required=True)
    b.add_argument("--lookback-hours", type=int, default=24 * 7)
    b.add_argument("--min-history-points", type=int, default=24)
    b.add_argument("--output-partitions", type=int, default=0)
    b.add_argument("--from-day", default=None)
    d, u = sub.add_parser("daily"), sub.add_parser("update")
    for p in (d, u):
        for name in ("requests", "weather", "alerts", "news"):
            p.add_argument(f"--{name}-root", required=True)
        p.add_argument("--stations-csv", required=True)
        p.add_argument("--output-root", required=True)
    d.add_argument("--start", default=None)
    d.add_argument("--end", default=None)
    u.add_argument("--days", nargs="+", required=True)
    u.add_argument("--cities", nargs="*", default=None)
    w = sub.add_parser("weather")
    w.add_argument("--observations-path", required=True)
    w.add_argument("--daily-values-path", required=True)
    w.add_argument("--weather-root", required=True)
    al = sub.add_parser("alerts")
    al.add_argument("--features-path", required=True)
    al.add_argument("--alerts-root", required=True)
    r = sub.add_parser("requests")
    r.add_argument("--records-path", required=True)
    r.add_argument("--city", required=True)
    r.add_argument("--requests-root", required=True)
    r.add_argument("--socrata", action="store_true")
    lo = sub.add_parser("run-log")
    lo.add_argument("--events-path", required=True)
    lo.add_argument("--log-root", required=True)
    st = sub.add_parser("stream")
    st.add_argument("--landing-root", required=True)
    st.add_argument("--target", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--delay", default="2 days")
    n = sub.add_parser("news")
    n.add_argument("--export-path", required=True)
    n.add_argument("--cities", nargs="+", required=True)
    n.add_argument("--events-root", required=True)
    n.add_argument("--news-root", required=True)
    args = ap.parse_args(argv)
    spark = session(args)
    if args.job == "bronze":
        out = {"bronze_rows": jobs.bronze_job(spark, args.landing_root, args.bronze_root, io.OPEN311_SCHEMA)}
    elif args.job == "silver":
        out = {"silver_rows": jobs.silver_job(spark, args.bronze_root, args.mapping_file, args.silver_root, args.from_day)}
    elif args.job == "aggregate":
        out = jobs.aggregate_job(spark, args.silver_file, args.hourly_output_root, args.daily_output_root,
                                 args.category_output_root, args.from_day, args.state_root)
    elif args.job == "baselines":
        out = jobs.baseline_job(spark, args.input_root, args.output_root, args.lookback_hours, args.min_history_points,
                                args.output_partitions, args.from_day)
    elif args.job == "news":
        out = {"news_days": jobs.news_job(spark, args.export_path, args.cities, args.events_root, args.news_root).count()}
    elif args.job == "weather":
        out = {"weather_days": jobs.weather_job(spark, spark.read.parquet(args.observations_path), spark.read.parquet(args.daily_values_path),
                                                args.weather_root).count()}
    elif args.job == "alerts":
        out = {"alerts": jobs.alerts_job(spark, spark.read.parquet(args.features_path), args.alerts_root).count()}
    elif args.job == "requests":
        out = {"requests": jobs.requests_job(spark, spark.read.parquet(args.records_path), args.city, args.requests_root, args.socrata).count()}
    elif args.job == "run-log":
        out = {"runs": jobs.run_log_job(spark, spark.read.parquet(args.events_path), args.log_root).count()}
    elif args.job == "stream":
        landed = spark.read.parquet(args.landing_root)
        out = hourly.run_hourly_stream(spark, args.landing_root, hourly.stream_schema(landed), args.target, args.checkpoint, args.delay)
    else:
        read = [spark.read.parquet(getattr(args, f"{n}_root")) for n in ("requests", "weather", "alerts", "news")]
        stations = spark.read.option("header", True).schema("station_id string, city string").csv(args.stations_csv)
        if args.job == "update":
            cities = spark.createDataFrame([(c,) for c in args.cities], "city string") if args.cities else stations.select("city").distinct()
            changed = cities.select("city", F.explode(F.array(*[F.lit(d).cast("date") for d in args.days])).alias("d"))
            done = update.update_job(spark, *read, stations, args.output_root, changed)
        else:
            done = jobs.daily_job(spark, *read, stations, args.output_root, args.start, args.end)
        out = {k: v.count() for k, v in done.items()}
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
