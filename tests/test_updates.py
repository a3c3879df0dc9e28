"""Work that follows a change: dirty days, dirty months, and name lookups of any size."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from metroscope.operators import merge as mg
from metroscope.operators import news as nw
from metroscope.plans import jobs
from metroscope.plans import update as up
from metroscope.session import scratch_path
from metroscope.sources import io

# ---------------------------------------------------------------- E17

FIRST = dt.date(2024, 1, 1)


def world(rng, days=150):
    """Requests, weather, alerts, news of two cities with gaps."""
    day = lambda i: FIRST + dt.timedelta(days=i)
    req = [(str(n), c, rng.choice(["open", "closed"]), rng.choice(["Pothole", "Graffiti"]), f"{day(i)} 08:00:00", f"{day(i)} {rng.randint(9, 20)}:00:00")
           for n, (c, i) in enumerate((c, i) for c in ("boston", "chicago") for i in range(days) for _ in range(rng.randint(0, 3)))]
    wx = [(s, day(i), rng.choice([None, 20.0 + rng.randint(0, 20)]), rng.choice([None, 30.0 + rng.randint(0, 20)]), rng.choice([None, 1.5]))
          for s in ("S1", "S2") for i in range(days) if rng.random() < 0.8]
    al = [(f"a{n}", c, day(rng.randrange(days)), rng.choice(["Severe", "Minor"]), "Immediate", "Observed") for n, c in enumerate(["boston", "chicago"] * 20)]
    news = [(c, day(i), rng.choice([None, -3.0 * rng.random()]), rng.randint(0, 9)) for c in ("boston", "chicago") for i in range(days) if rng.random() < 0.9]
    return {"requests": req, "weather": wx, "alerts": al, "news": news}


def tables(spark, w):
    req = spark.createDataFrame(w["requests"], "service_request_id string, city string, status string, service_name string, r string, u string").select(
        "service_request_id", "city", "status", "service_name", F.to_timestamp("r").alias("requested_datetime"), F.to_timestamp("u").alias("updated_datetime"))
    al = spark.createDataFrame(w["alerts"], "alert_id string, city string, obs_date date, severity string, urgency string, certainty string")
    roots = {}
    for name, df, date, parts in (("requests", mg.resolution_hours(req), "requested_datetime", ["city", "month"]), ("alerts", al, "obs_date", ["month"])):
        roots[name] = scratch_path(spark, name)
        io.write_partitioned(df.withColumn("month", F.date_format(date, "yyyy-MM")), roots[name], parts)
    wx = spark.createDataFrame(w["weather"], "station_id string, obs_date date, tmax double, heat_index_max double, precip_6hr_max double")
    news = spark.createDataFrame(w["news"], "city string, obs_date date, avg_tone double, protest_event_count int")
    stations = spark.createDataFrame([("S1", "boston"), ("S2", "boston"), ("S2", "chicago")], "station_id string, city string")
    return spark.read.parquet(roots["requests"]), wx, spark.read.parquet(roots["alerts"]), nw.tone_7d(news), stations


def contents(done):
    drop = {"verdicts": ["generated_at"]}
    return {n: sorted((tuple(map(str, r)) for r in df.select(*sorted(c for c in df.columns if c not in drop.get(n, []))).collect())) for n, df in done.items()}


def test_an_update_ends_where_a_full_run_does(spark):
    rng = random.Random(5)
    before = world(rng)
    after = {k: list(v) for k, v in before.items()}
    cells = {("boston", FIRST + dt.timedelta(days=70)), ("boston", FIRST + dt.timedelta(days=73)), ("chicago", FIRST + dt.timedelta(days=40))}
    # one request closes, one goes, one appears; a reading and an alert change
    hit = [r for r in after["requests"] if (r[1], dt.date.fromisoformat(r[4][:10])) in cells]
    after["requests"].remove(hit[0])
    after["requests"][after["requests"].index(hit[-1])] = (*hit[-1][:2], "closed", "Noise", hit[-1][4], hit[-1][5])
    after["requests"].append(("new", "chicago", "open", "Noise", "2024-02-10 01:00:00", "2024-02-10 02:00:00"))
    after["alerts"].append(("late", "boston", FIRST + dt.timedelta(days=73), "Extreme", "Immediate", "Observed"))
    after["weather"] = [(*r[:2], 39.0, 45.0, 2.5) if r[0] == "S2" and r[1] in {d for _, d in cells} else r for r in after["weather"]]
    cells |= {("chicago", FIRST + dt.timedelta(days=70)), ("chicago", FIRST + dt.timedelta(days=73)), ("boston", FIRST + dt.timedelta(days=40))}  # S2 serves both
    full, inc = scratch_path(spark, "full"), scratch_path(spark, "inc")
    want = contents(jobs.daily_job(spark, *tables(spark, after), full))
    jobs.daily_job(spark, *tables(spark, before), inc)
    r, wx, al, news, st = tables(spark, after)
    changed = spark.createDataFrame(sorted(cells), "city string, d date")
    assert contents(up.update_job(spark, r, wx, al, news, st, inc, changed)) == want
    assert contents(up.update_job(spark, r, wx, al, news, st, inc, changed)) == want  # again: nothing more
    assert contents(up.update_job(spark, r, wx, al, news, st, inc, changed.limit(0))) == want
    for cell in (up.request_cells(r, changed.limit(1)), up.alert_cells(al, changed.limit(1))):
        plan = cell._jdf.queryExecution().executedPlan().toString()
        assert "2024-02" in plan and "2024-03" not in plan  # only the raw month of the cell is read


def test_the_plan_says_how_far_a_change_reaches(spark):
    day = lambda i: FIRST + dt.timedelta(days=i)
    readings = spark.createDataFrame([("requests", "boston", day(2 * i)) for i in range(100)] + [("S1", "boston", day(i)) for i in range(20)],
                                     "series string, city string, d date")
    changed = spark.createDataFrame([("boston", day(10)), ("boston", day(12)), ("nowhere", day(5))], "city string, d date")
    got = {r.city: (r.lo, r.hi) for r in up.reach(changed, readings).collect()}
    assert got == {"boston": (day(10), day(12 + 60 + 30)), "nowhere": (day(5), day(35))}


def test_an_update_needs_a_first_full_run(spark):
    w = tables(spark, world(random.Random(1), 40))
    with pytest.raises(RuntimeError, match="run the daily job"):
        up.update_job(spark, *w, scratch_path(spark, "never"), spark.createDataFrame([("boston", FIRST)], "city string, d date"))


# ---------------------------------------------------------------- E12: months that a change reaches


def news_days(rng, city, dates):
    return [(city, d, rng.choice([None, round(rng.uniform(-5, 5), 3)]), rng.randint(0, 5), d.strftime("%Y-%m")) for d in dates]


SCHEMA = "city string, obs_date date, avg_tone double, num_articles int, month string"


@pytest.mark.parametrize("seed", range(4))
def test_rewritten_months_equal_a_full_rewrite(spark, seed):
    """Sparse and dense months, batches at both ends and in the middle."""
    rng = random.Random(seed)
    dates = sorted(rng.sample([FIRST + dt.timedelta(days=i) for i in range(400)], rng.choice([25, 60, 200])))
    null = {c: F.lit(None).cast("double") for c in ("avg_tone_7d", "polarity")}
    make = lambda rows: spark.createDataFrame(rows, SCHEMA).withColumns(null)
    table, tails = None, None
    known = {}
    for _ in range(4):
        batch = news_days(rng, "boston", rng.sample(dates, len(dates) // 4)) + news_days(rng, "chicago", rng.sample(dates, 3))
        known |= {(r[0], r[1]): r for r in batch}
        rows, tails_new = nw.rewritten_months(table, tails, make(batch))
        rows, tails_new = rows.collect(), tails_new.collect()
        rows_df, cols = spark.createDataFrame(rows, make(batch).schema), make(batch).columns
        if table is not None:
            months = rows_df.select("city", "month").distinct()
            rows_df = rows_df.unionByName(table.join(months, ["city", "month"], "left_anti"))
            cities = {r.city for r in tails_new}
            tails_new += [r for r in tails.collect() if r.city not in cities]
        path = scratch_path(spark, "news-step")
        rows_df.select(*cols).write.parquet(path)
        table = spark.read.parquet(path)
        tails = spark.createDataFrame(tails_new, nw.month_tails(table).schema)
        want = nw.tone_7d(make(list(known.values())))
        key = lambda df: sorted(tuple(map(str, r)) for r in df.select("city", "obs_date", "avg_tone", "avg_tone_7d", "num_articles").collect())
        assert key(table) == key(want)
        assert sorted(map(str, tails.collect())) == sorted(map(str, nw.month_tails(table).collect()))


def export(path, days, tone):
    line = lambda i, d: "\t".join(
        {"GLOBALEVENTID": str(i), "SQLDATE": d.strftime("%Y%m%d"), "EventRootCode": "14", "AvgTone": str(tone), "NumMentions": "3", "NumSources": "1",
         "NumArticles": "2", "GoldsteinScale": "1", "ActionGeo_FullName": "Boston, MA"}.get(c, "") for c in io.NEWS_COLUMNS)
    path.write_text("\n".join(line(i, d) for i, d in enumerate(days)))
    return str(path)


def test_other_months_of_the_news_table_stay_untouched(spark, tmp_path):
    days = [FIRST + dt.timedelta(days=i) for i in range(150)]
    root, events = str(tmp_path / "news"), scratch_path(spark, "events")
    jobs.news_job(spark, export(tmp_path / "all.tsv", days, -2), ["boston"], events, root)
    times = lambda: {p.parent.name: p.stat().st_mtime_ns for p in (tmp_path / "news" / "city=boston").rglob("*.parquet")}
    first = times()
    out = jobs.news_job(spark, export(tmp_path / "one.tsv", [dt.date(2024, 2, 27)], 5), ["boston"], events, root)
    second = times()
    assert {m for m in second if second[m] != first[m]} == {"month=2024-02", "month=2024-03"}
    tones = {r.obs_date: r.avg_tone_7d for r in out.collect()}
    assert tones[dt.date(2024, 2, 26)] == -2 and tones[dt.date(2024, 2, 27)] == tones[dt.date(2024, 3, 4)] == -1 and tones[dt.date(2024, 3, 5)] == -2
    out = jobs.news_job(spark, export(tmp_path / "two.tsv", [dt.date(2024, 3, 10)], 5), ["boston"], events, root)
    assert {m for m, t in times().items() if t != second[m]} == {"month=2024-03"} and out.count() == 150


# ---------------------------------------------------------------- F2 with many names


def test_many_names_give_the_rows_of_contains(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdXyß é") for _ in range(rng.randint(0, 7)))
    names = sorted({word() for _ in range(120)} | {"", "ab", "a", "New York"})
    geo = lambda: rng.choice([None, "", word() + rng.choice(names) + word(), "new york, NEW YORK"])
    rows = [(i, geo(), geo(), geo()) for i in range(400)]
    events = spark.createDataFrame(rows, "id int, ActionGeo_FullName string, Actor1Geo_FullName string, Actor2Geo_FullName string")
    want = sorted((r[0], n) for r in rows for n in names if any(g is not None and n.lower() in g.lower() for g in r[1:]))
    table = spark.createDataFrame([(n,) for n in names] + [(None,), ("ab",)], "city string")
    assert sorted((r.id, r.city) for r in nw.match_city_names(events, table).collect()) == want
    assert sorted((r.id, r.city) for r in nw.match_cities(events, names).collect()) == want
    few = names[:5]
    assert sorted((r.id, r.city) for r in nw.match_cities(events, few).collect()) == [w for w in want if w[1] in few]
    kept = nw.match_city_names(events, table, keep_unmatched=True)
    assert kept.columns == [*events.columns, "city"] and {r.id for r in kept.collect()} == set(range(400))


def test_numbered_names_meet_only_their_own_texts(spark):
    """Names that differ in their numbers alone share all short grams; texts must not meet them all."""
    names = [f"Customer#{i:09d}" for i in range(0, 90000, 45)] + ["Peru", "In", "a"]
    rows = [(i, None if i % 7 == 0 else "PERU", f"{names[i * 13 % 2000]}, Peru", None if i % 3 else f"x {names[i % 2000]} y") for i in range(2500)]
    events = spark.createDataFrame(rows * 2, "text int, ActionGeo_FullName string, Actor1Geo_FullName string, Actor2Geo_FullName string")
    table = spark.createDataFrame([(n,) for n in names], "city string")
    want = {(r[0], n) for r in rows for n in (names[r[0] * 13 % 2000], "Peru", *([names[r[0] % 2000]] if r[3] else []))}
    met = nw.match_city_names(events, table)
    assert met.columns == [*events.columns, "city"]
    assert sorted((r.text, r.city) for r in met.collect()) == sorted([*want, *want])
    assert "collect_set" not in met._jdf.queryExecution().toString()  # events are not grouped by their combination of texts
    posted = nw.postings(table.select("city", F.lower("city").alias("name")))
    assert posted.count() == len(names) and posted.groupBy("gram").count().agg(F.max("count")).first()[0] <= 10
