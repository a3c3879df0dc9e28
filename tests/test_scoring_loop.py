"""Set-based = loop: E7 over the whole range equals scoring one date at a
time in plain Python, the way a daily job run in date order would, on the smallest fixture."""
import math

import pytest

from metroscope.plans import daily
from metroscope.operators import scoring as sc

from conftest import SMALL_SF

SEV = dict(sc.SEVERITY)
URG = dict(sc.URGENCY)
CER = dict(sc.CERTAINTY)


def _mean(xs):
    xs = [x for x in xs if x is not None and not (isinstance(x, float) and math.isnan(x))]
    return sum(xs) / len(xs) if xs else None


def _std(xs):
    xs = [x for x in xs if x is not None]
    if len(xs) < 2:
        return None
    m = sum(xs) / len(xs)
    return math.sqrt(sum((x - m) ** 2 for x in xs) / (len(xs) - 1))


def _clip(x):
    return min(100.0, max(0.0, x))


@pytest.fixture(scope="module")
def tables(spark):
    di = daily.inputs(spark, SMALL_SF)
    reqs = [r.asDict() for r in di.counts.collect()]
    wx = [r.asDict() for r in di.weather.collect()]
    st = [r.asDict() for r in di.stations.collect()]
    alerts = [r.asDict() for r in daily.alerts(spark, SMALL_SF).collect()]
    news = [r.asDict() for r in di.gdelt.collect()]
    scores = [r.asDict() for r in daily.scores(spark, SMALL_SF, di).collect()]
    return reqs, wx, st, alerts, news, scores


def test_scores_equal_date_by_date_loop(tables):
    reqs, wx, st, alerts, news, scores = tables
    city = "chicago"
    counts = sorted((r["d"], r["cnt"]) for r in reqs if r["city"] == city)
    stations = [s["station_id"] for s in st if s["city"] == city]
    series = {s: sorted((w for w in wx if w["station_id"] == s), key=lambda w: w["obs_date"]) for s in stations}
    news_by_day = {n["obs_date"]: n for n in news if n["city"] == city}
    mine = sorted((s for s in scores if s["city"] == city), key=lambda s: s["score_date"])
    history = []
    for row in mine:
        d = row["score_date"]
        # 311 anomaly: today's count against the previous 30 days with data
        today = [c for day, c in counts if day == d]
        prior = [c for day, c in counts if day < d][-30:]
        b = _mean(prior)
        anomaly = 50.0 if not today or b is None or b == 0 else round(_clip((today[0] - b) / b * 80 + 50), 2)
        # heat: per station, then the max over the city's stations
        heats = []
        for s in stations:
            rows = series[s]
            now = [w for w in rows if w["obs_date"] == d]
            if not now:
                continue
            hi, tx = now[0]["heat_index_max"], now[0]["tmax"]
            col = "heat_index_max" if hi is not None else "tmax"
            val = hi if hi is not None else tx
            base = [w[col] for w in rows if w["obs_date"] < d][-30:]
            m, sd = _mean(base), _std(base)
            heats.append(50.0 if val is None or m is None or sd is None or sd == 0 else round(_clip((val - m) / sd * 15 + 50), 2))
        heat = max(heats) if heats else 50.0
        # alerts: strongest alert of the day
        al = [SEV.get(a["severity"], 0) * URG.get(a["urgency"], 0) * CER.get(a["certainty"], 0) / 36 * 100
              for a in alerts if a["city"] == city and a["obs_date"] == d]
        alert = round(max(al), 2) if al else 0.0
        # context: 7-day tone and protests of the day
        n = news_by_day.get(d)
        if n is None or n["avg_tone_7d"] is None:
            context = 50.0
        else:
            p = n["protest_event_count"]
            context = round(min(100, abs(n["avg_tone_7d"]) / 8 * 100) * 0.7 + (min(100, p / 20 * 100) if p is not None else 0) * 0.3, 2)
        composite = round(anomaly * 0.35 + heat * 0.30 + alert * 0.20 + context * 0.15, 2)
        prev = history[-30:]
        baseline = round(sum(prev) / len(prev), 2) if prev else composite
        history.append(row["composite"])
        for name, want in (("anomaly_score", anomaly), ("heat_score", heat), ("alert_score", alert),
                           ("context_score", context), ("composite", composite), ("composite_baseline_30d", baseline)):
            assert abs(row[name] - want) <= 0.0100001, (d, name, row[name], want)
        delta = row["composite"] - row["composite_baseline_30d"]
        if min(abs(delta - 10), abs(delta - 25)) > 0.02:
            want_mode = "Normal" if delta < 10 else ("Elevated" if delta < 25 else "High")
            assert row["readiness_mode"] == want_mode


def test_cards_equal_date_by_date_loop(spark):
    di = daily.inputs(spark, SMALL_SF)
    city = "boston"
    req = [r.asDict() for r in daily.requests(spark, SMALL_SF).filter(f"city = '{city}'").collect()]
    stations = [s.station_id for s in di.stations.collect() if s.city == city]
    wx = {s: sorted((r.asDict() for r in di.weather.filter(f"station_id = '{s}'").collect()), key=lambda w: w["obs_date"])
          for s in stations}
    news = {r.obs_date: r.asDict() for r in di.gdelt.filter(f"city = '{city}'").collect()}
    cards = {}
    for r in daily.cards(spark, SMALL_SF, di=di).filter(f"city = '{city}'").collect():
        cards.setdefault(r.metric_date, {})[r.metric_name] = r
    stored = {"open_backlog": [], "mean_close_hrs": [], "tmax": []}
    for d in sorted(cards):
        got = cards[d]
        rd = [r for r in req if r["requested_datetime"].date() == d]
        backlog = sum(1 for r in req if r["status"] == "open" and r["requested_datetime"].date() <= d)
        closed = [r["resolution_hrs"] for r in rd if r["status"] == "closed"]
        mean_close = round(sum(closed) / len(closed), 2) if closed else None
        by_service = {}
        for r in rd:
            by_service[r["service_name"]] = by_service.get(r["service_name"], 0) + 1
        top = min(by_service, key=lambda k: (-by_service[k], k)) if by_service else "N/A"
        tx_today = [w["tmax"] for s in stations for w in wx[s] if w["obs_date"] == d and w["tmax"] is not None]
        tmax = round(max(tx_today), 1) if tx_today else None
        streaks, precips = [], []
        for s in stations:
            n = 0
            for w in sorted((w for w in wx[s] if w["obs_date"] <= d), key=lambda w: w["obs_date"], reverse=True):
                if (w["heat_index_max"] is not None and w["heat_index_max"] > 40) or (w["tmax"] is not None and w["tmax"] > 35):
                    n += 1
                else:
                    break
            streaks.append(n)
            ps = [w["precip_6hr_max"] for w in wx[s] if 0 <= (d - w["obs_date"]).days <= 2 and w["precip_6hr_max"] is not None]
            precips.append(sum(ps) if ps else None)
        precip = round(max(p for p in precips if p is not None), 2) if any(p is not None for p in precips) else 0.0
        n = news.get(d)
        tone = round(n["avg_tone_7d"], 3) if n and n["avg_tone_7d"] is not None else None
        protests = n["protest_event_count"] if n else 0
        want = {"open_backlog": backlog, "mean_close_hrs": mean_close, "top_category": top, "tmax": tmax,
                "heat_streak_days": max(streaks) if streaks else 0, "media_tone_7d": tone,
                "protest_mentions": protests, "precip_72hr_mm": precip}
        for name, value in want.items():
            card = got[name]
            if name == "top_category":
                assert card.value_text == value, (d, name)
            elif value is None:
                assert card.value_num is None, (d, name)
            else:
                assert abs(card.value_num - value) <= 0.0100001, (d, name, card.value_num, value)
        for name, need_x in (("open_backlog", False), ("mean_close_hrs", True), ("tmax", True)):
            x, prev = want[name], stored[name]
            vals = [v for v in prev if v is not None]
            b = sum(vals) / len(vals) if vals else None
            ok = bool(b) and (bool(x) if need_x else True)
            delta = round((x - b) / b * 100, 2) if ok else 0.0
            base = b if b else (float(x) if x is not None else None)
            assert abs(got[name].delta_pct - delta) <= 0.0100001, (d, name, got[name].delta_pct, delta)
            assert (got[name].baseline is None and base is None) or abs(got[name].baseline - base) <= 1e-6, (d, name)
            prev.append(x)
