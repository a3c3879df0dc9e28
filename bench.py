"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (the whole plan runs, nothing is
collected to the driver). Before timing, every headline query runs once on the smallest
tables (other data, so nothing is reused) to warm the JVM's JIT; the numbers are steady
state. Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from metroscope.plans.catalog import QUERIES  # noqa: E402
from metroscope.session import local_session  # noqa: E402

HEADLINE = (
    "a1_hourly",
    "a3_category_hourly",
    "w1_baseline_168h",
    "a6_news_daily",
    "e7_signal_scores",
    "u2_metric_cards",
    "x11_verdict",
    "j2_history_month",
    "d2_article_city",
    "d6_zone_join",
    "d7_five_signals",
    "m1_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))
    # warm-up on the smallest tables: class loading and JIT are not part of any query
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if Path(warm).exists() and warm != sf_dir:
        for n in names:
            QUERIES[n](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
