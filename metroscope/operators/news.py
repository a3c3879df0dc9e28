"""News events (E12): P6 coercion, F2/F3 city filters, F4 protests, A6/A7 daily roll-ups, W6.

City matching is one projection for a short list of names and a gram index over the
distinct geo texts for a long one; an event that names two cities counts for both (as
running the reference once per city would).
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroscope.functions.columns import exact_mean, mean_rounded, sum_units
from metroscope.operators import staged
from metroscope.operators.merge import partial_upsert

NUMERIC = ("GoldsteinScale", "NumMentions", "NumSources", "NumArticles", "AvgTone")
GEO_COLUMNS = ("ActionGeo_FullName", "Actor1Geo_FullName", "Actor2Geo_FullName")


def coerce(events: DataFrame) -> DataFrame:
    """Numeric text -> double (bad text -> null), root code trimmed with null -> ''."""
    return events.withColumns(
        {c: F.col(c).try_cast("double") for c in NUMERIC}
        | {"EventRootCode": F.trim(F.coalesce(F.col("EventRootCode"), F.lit("")))}
    )


def with_obs_date(events: DataFrame, date_col: str = "SQLDATE") -> DataFrame:
    """Daily file date as ``obs_date`` (yyyyMMdd text; unparsable -> null)."""
    return events.withColumn("obs_date", _parsed_date(F.col(date_col)))


INLINE_CITIES = 40  # names compared one by one in a projection; more go through the gram index
GRAM = 3
GRAM_SIZES = (1, 2, GRAM, 8)
INLINE_GRAMS = 2000  # short grams named in a projection


def with_cities(events: DataFrame, cities: Sequence[str], column: str) -> DataFrame:
    """adds ``column``, the cities whose name any of the three geo columns contains (case
    ignored; null contains nothing; none: an empty array).

    A short list is one ``contains`` per (city, column) in a single codegen'd projection - no
    join; a longer one is looked up with ``with_city_names``."""
    cities = list(dict.fromkeys(cities))
    if len(cities) > INLINE_CITIES:
        names = events.sparkSession.createDataFrame([(c,) for c in cities], "city string")
        return with_city_names(events, names, column)
    geo = _free(events, "geo")
    # the folded texts are a step of their own: each is lower-cased once per row
    folded = events.withColumn(geo, F.struct(*[F.lower(F.col(g)).alias(f"g{i}") for i, g in enumerate(GEO_COLUMNS)]))
    texts = [F.col(f"{geo}.g{i}") for i in range(len(GEO_COLUMNS))]
    hits = [
        F.when(reduce(lambda a, b: a | b, [F.coalesce(g.contains(c.lower()), F.lit(False)) for g in texts]), F.lit(c))
        for c in cities
    ]
    return folded.withColumn(column, F.array_compact(F.array(*hits))).drop(geo)


def _one_row_a_city(events: DataFrame, found: DataFrame, column: str, keep_unmatched: bool) -> DataFrame:
    # the outer form in both cases: for the inner one the optimizer evaluates the whole match twice, once to filter
    each = found.select(*events.columns, F.explode_outer(column).alias("city"))
    return each if keep_unmatched else each.where(F.col("city").isNotNull())


def match_cities(events: DataFrame, cities: Sequence[str], keep_unmatched: bool = False) -> DataFrame:
    """one row per event and city that it names (``with_cities``), in column ``city``."""
    column = _free(events, "cities")
    return _one_row_a_city(events, with_cities(events, cities, column), column, keep_unmatched)


def _free(df: DataFrame, base: str) -> str:
    name = base
    while name in df.columns:
        name += "_"
    return name


def _grams(text: Column, sizes: Sequence[int]) -> Column:
    """Distinct substrings of ``text`` of the given sizes."""
    if not sizes:
        return F.array().cast("array<string>")

    def of(n: int) -> Column:
        last = F.char_length(text) - (n - 1)
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(text, i, F.lit(n)))).otherwise(F.array())

    return F.array_distinct(F.concat(*[of(n) for n in sizes]))


def _own_size(name: Column) -> Column:
    """The gram size a name is posted under: the largest of ``GRAM_SIZES`` that it reaches."""
    return F.coalesce(*[F.when(F.char_length(name) >= n, F.lit(n)) for n in reversed(GRAM_SIZES)])


def postings(posted: DataFrame) -> DataFrame:
    """``city``, ``name`` and the ``gram`` each name that is not empty is posted under: of its own
    size, the one that the fewest names hold."""
    grams = F.coalesce(*[F.when(_own_size(F.col("name")) == n, _grams(F.col("name"), [n])) for n in GRAM_SIZES])
    choices = posted.select("city", "name", F.explode(grams).alias("gram"))
    often = choices.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return choices.join(often, "gram").groupBy("city", "name").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))


def names_in_texts(texts: DataFrame, names: DataFrame) -> DataFrame:
    """``text``, ``city``, ``name`` (lower-cased) for every name of ``names`` (``city``) that
    ``text`` contains, case ignored, for a table of distinct lower-cased texts.

    Every name is posted once, under the one of its grams that the fewest names hold; a text
    that contains the name holds the gram. Long names have long grams: numbered names share all
    their three-letter grams, and would meet texts by the square of their number. Texts
    meet postings by gram and are then searched for the few names posted there; short grams
    that no name is posted under stay at home. An empty name is in every text that is not null."""
    posted = names.select("city", F.lower("city").alias("name")).where(F.col("name").isNotNull()).distinct()
    sizes = [r[0] for r in posted.select(_own_size(F.col("name")).alias("n")).where("n is not null").distinct().collect()]
    place = postings(posted)
    long = [n for n in sizes if n > GRAM]
    short = _grams(F.col("text"), [n for n in sizes if n <= GRAM])
    known = place.where(F.char_length("gram") <= GRAM).select("gram").distinct().limit(INLINE_GRAMS + 1).collect()
    if len(known) <= INLINE_GRAMS:
        short = F.array_intersect(short, F.array(*[F.lit(r.gram) for r in known]).cast("array<string>"))
    texts = texts.where(F.col("text").isNotNull())
    held = texts.select("text", F.explode(F.concat(short, _grams(F.col("text"), long))).alias("gram"))
    found = held.join(place, "gram").filter(F.contains("text", "name")).select("text", "city", "name")
    everywhere = posted.filter("name = ''").select("city", "name")
    return found.unionByName(texts.join(everywhere).select("text", "city", "name"))


def with_city_names(events: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """``with_cities`` for any number of names (a ``city`` column).

    The work per name is done on the distinct geo texts, not on the events: texts are searched
    through a gram index, and events get their cities back by one join on their distinct
    combination of geo texts."""
    geos = [F.lower(F.col(g)).alias(f"g{i}") for i, g in enumerate(GEO_COLUMNS)]
    geo = _free(events, "geo")
    places = events.select(*geos).distinct()
    keys = [f"g{i}" for i in range(len(GEO_COLUMNS))]
    each = places.select(*keys, F.explode(F.array_distinct(F.array_compact(F.array(*keys)))).alias("text"))
    pairs = names_in_texts(each.select("text").distinct(), names).drop("name")
    cities = each.join(pairs, "text").groupBy(*keys).agg(F.sort_array(F.collect_set("city")).alias(column))
    folded = events.withColumn(geo, F.struct(*geos))
    met = folded.join(cities, reduce(lambda a, b: a & b, [F.col(f"{geo}.{k}").eqNullSafe(cities[k]) for k in keys]), "left")
    return met.select(*events.columns, F.ifnull(column, F.array().cast("array<string>")).alias(column))


def match_city_names(events: DataFrame, names: DataFrame, keep_unmatched: bool = False) -> DataFrame:
    """F2 for any number of names: the same rows as ``match_cities``.

    Without the unmatched events every event goes out once for each of its distinct geo texts
    and meets that text's names there. A name that an earlier text of the event contains has been met
    already, which the row itself shows: no second grouping by event or by combination of texts."""
    if keep_unmatched:
        column = _free(events, "cities")
        return _one_row_a_city(events, with_city_names(events, names, column), column, keep_unmatched)
    geos = F.array_distinct(F.array_compact(F.array(*[F.lower(F.col(g)) for g in GEO_COLUMNS])))
    text, place, before = (_free(events, c) for c in ("text", "place", "before"))
    texts = events.select(F.explode(geos).alias("text")).distinct()
    pairs = names_in_texts(texts, names).select(F.col("text").alias("known"), F.col("city").alias("met"), "name")
    each = events.select(*events.columns, geos.alias(before), F.posexplode(geos).alias(place, text))
    each = each.withColumn(before, F.slice(before, F.lit(1), F.col(place)))
    met = each.join(pairs, each[text] == pairs["known"]).where(~F.exists(each[before], lambda t: F.contains(t, pairs["name"])))
    return met.select(*[each[c] for c in events.columns], pairs["met"].alias("city"))


def match_cities_strict(events: DataFrame, patterns: Sequence[tuple[str, str]]) -> DataFrame:
    """action geo contains the exact ``City, State`` text (case-sensitive)."""
    action = F.col("ActionGeo_FullName")
    hits = [F.when(F.coalesce(action.contains(p), F.lit(False)), F.lit(c)) for c, p in patterns]
    return events.withColumn("city", F.explode(F.array_compact(F.array(*hits))))


def is_protest(root: Column | None = None) -> Column:
    """CAMEO root code 14."""
    return (F.col("EventRootCode") if root is None else root) == F.lit("14")


def _parsed_date(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")


# Mergeable parts of a day's roll-up.
_DAY_PARTS = ("tone_units", "tone_n", "gold_units", "gold_n", "protests", "mentions", "articles", "sources")


def _day_parts(matched: DataFrame, *keys: str) -> DataFrame:
    p = is_protest()
    return matched.groupBy(*keys).agg(
        sum_units(F.col("AvgTone")).alias("tone_units"), F.count("AvgTone").alias("tone_n"),
        sum_units(F.col("GoldsteinScale")).alias("gold_units"), F.count("GoldsteinScale").alias("gold_n"),
        F.count_if(p).alias("protests"), F.sum(F.when(p, F.col("NumMentions"))).alias("mentions"),
        F.sum("NumArticles").alias("articles"), F.sum("NumSources").alias("sources"))


def _rolled_days(parts: DataFrame, count_type: str) -> DataFrame:
    """A6 per (city, obs_date) from parts that are merged here: mean tone and Goldstein rounded
    to 3, protest count and mention sum, article and source sums (sums of nothing are 0)."""
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0.0)).cast(count_type)
    return parts.groupBy("city", "obs_date").agg(
        exact_mean(F.sum("tone_units"), F.sum("tone_n"), 3).alias("avg_tone"),
        F.coalesce(F.sum("protests"), F.lit(0)).cast(count_type).alias("protest_event_count"),
        whole("mentions").alias("protest_mention_sum"),
        exact_mean(F.sum("gold_units"), F.sum("gold_n"), 3).alias("goldstein_avg"),
        whole("articles").alias("num_articles"), whole("sources").alias("source_count"))


def daily_rollup(matched: DataFrame) -> DataFrame:
    """Per (city, obs_date)."""
    return _rolled_days(_day_parts(matched, "city", "obs_date"), "long")


def daily_rollup_distinct(matched: DataFrame, approximate: bool = False) -> DataFrame:
    """API variant - unrounded means, sources = distinct source URLs, no row without events."""
    p = is_protest()
    src = F.approx_count_distinct("SOURCEURL") if approximate else F.count_distinct("SOURCEURL")
    return matched.groupBy("city", "obs_date").agg(
        F.avg("AvgTone").alias("avg_tone"),
        F.count_if(p).alias("protest_event_count"),
        F.coalesce(F.sum(F.when(p, F.col("NumMentions"))), F.lit(0.0)).cast("long").alias("protest_mention_sum"),
        F.avg("GoldsteinScale").alias("goldstein_avg"),
        F.coalesce(F.sum("NumArticles"), F.lit(0.0)).cast("long").alias("num_articles"),
        src.alias("source_count"),
    )


def rollup_with_empty_days(events: DataFrame, cities: Sequence[str], date_col: str = "SQLDATE") -> DataFrame:
    """A6 as the reference writes it: a downloaded day with no matching event still gets
    a row (tone null, counts 0).

    One pass over the raw events: they are folded per set of matched cities and date *text*, and
    only the folded rows are given out to the cities and parsed. Unmatched events are kept
    with an empty set, so the fold itself knows every file day: one folded row of each day is also
    given out to every city, without counts - no second scan, no join."""
    column = _free(events, "cities")
    parts = _day_parts(with_cities(events, cities, column), column, date_col).select(
        F.col(column).alias("found"), _parsed_date(F.col(date_col)).alias("obs_date"), *_DAY_PARTS)
    place = F.row_number().over(Window.partitionBy("obs_date").orderBy("found"))
    city = lambda own: lambda c: F.struct(c.alias("city"), F.lit(own).alias("own"))
    every = F.when(F.col("obs_date").isNotNull() & (F.col("place") == 1), F.array(*[F.lit(c) for c in cities])).otherwise(F.array())
    given = parts.withColumn("place", place).select(
        "obs_date", *_DAY_PARTS, F.explode(F.concat(F.transform("found", city(True)), F.transform(every, city(False)))).alias("to"))
    return _rolled_days(given.select("to.city", "obs_date", *[F.when(F.col("to.own"), F.col(c)).alias(c) for c in _DAY_PARTS]), "int")


def tone_7d(daily: DataFrame) -> DataFrame:
    """W6 + M5: 7-row trailing mean of avg_tone per city (nulls skipped but occupy a row),
    at least one value, rounded to 3; replaces ``avg_tone_7d`` on every row."""
    w = Window.partitionBy("city").orderBy("obs_date").rowsBetween(-6, 0)
    return daily.withColumn("avg_tone_7d", mean_rounded(F.col("avg_tone"), 3, over=w, python_round=False))  # pandas .round(3)


WINDOW_ROWS = 7


def month_tails(rows: DataFrame) -> DataFrame:
    """Per (city, month): ``n`` rows, and ``tail``, the last six (obs_date, avg_tone) up to its
    end - what the next month's 7-row means need of the past."""
    back = Window.partitionBy("city").orderBy("obs_date").rowsBetween(2 - WINDOW_ROWS, 0)
    tails = rows.select("city", "month", "obs_date", F.collect_list(F.struct("obs_date", "avg_tone")).over(back).alias("tail"))
    return tails.groupBy("city", "month").agg(F.count(F.lit(1)).alias("n"), F.max_by("tail", "obs_date").alias("tail"))


def reached_months(changed: DataFrame, tails: DataFrame) -> DataFrame:
    """(city, month) of ``changed`` (with ``last``, its last changed day there) and of the later
    stored months that a change can reach: those with fewer than six stored rows between."""
    keys = ["city", "month"]
    after = F.ifnull(F.size(F.filter("tail", lambda t: t["obs_date"] > F.col("last"))), F.lit(0))
    source = changed.join(tails.select(*keys, "tail"), keys, "left").select("city", F.col("month").alias("source"), after.alias("after"))
    later = source.join(tails.select(*keys, "n"), "city").filter("month > source")
    before = Window.partitionBy("city", "source").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    between = F.col("after") + F.ifnull(F.sum("n").over(before), F.lit(0))
    near = later.withColumn("between", between).filter(F.col("between") < WINDOW_ROWS - 1)
    return changed.select(*keys).union(near.select(*keys)).distinct()


def rewritten_months(stored: DataFrame | None, tails: DataFrame | None, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """W6 + M5 for a batch of days: the new rows of every month the batch touches or reaches,
    and the new tails of the batch's cities. Months that no change reaches are not read."""
    changed = batch.groupBy("city", "month").agg(F.max("obs_date").alias("last"))
    if stored is None or tails is None:
        rows = tone_7d(batch.withColumns({c: F.lit(None).cast("double") for c in ("avg_tone_7d", "polarity")}))
        return rows.select(*batch.columns), month_tails(rows)
    dirty = reached_months(changed, tails)
    keys = ["city", "month"]
    old = staged.in_scope(stored, dirty, keys)
    merged = partial_upsert(old, batch, ["city", "obs_date"], ["avg_tone_7d", "polarity"])
    # six earlier rows for each dirty month, from the nearest month before it that stays as it is
    clean = tails.join(dirty, keys, "left_anti").join(changed.select("city").distinct(), "city", "left_semi")
    nearest = dirty.join(clean.select("city", F.col("month").alias("before"), "tail"), "city").filter("before < month")
    context = nearest.groupBy("city", "month").agg(F.max_by("tail", "before").alias("tail")).select("city", F.explode("tail").alias("t")).select(
        "city", "t.obs_date", "t.avg_tone").distinct()
    context = context.join(merged.select("city", "obs_date"), ["city", "obs_date"], "left_anti")
    both = merged.withColumn("own", F.lit(True)).unionByName(context.withColumn("own", F.lit(False)), allowMissingColumns=True)
    timed = tone_7d(both)
    new_tails = month_tails(timed.withColumn("month", F.when(F.col("own"), F.col("month")))).filter("month is not null")
    kept = tails.join(changed.select("city").distinct(), "city", "left_semi").join(dirty, keys, "left_anti")
    return timed.filter("own").select(*batch.columns), kept.unionByName(new_tails)


def gdelt_daily(raw_events: DataFrame, cities: Sequence[str]) -> DataFrame:
    """E12 result table keyed by (city, obs_date) with avg_tone_7d and polarity."""
    daily = rollup_with_empty_days(coerce(raw_events), cities).withColumn("polarity", F.lit(None).cast("double"))
    return tone_7d(daily)
