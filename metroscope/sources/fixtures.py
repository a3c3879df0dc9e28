"""Domain tables derived from the driver's read-only parquet tables.

Every mapping is deterministic and pure DataFrame code (see FIXTURES.md); the
oracle SQL in ``metroscope.plans.oracle`` restates the same mappings for DuckDB.
Timestamps leave this module as ``TimestampType`` (session zone UTC).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroscope.functions.columns import rnd
from metroscope.sources import tables

# City names by key modulo 3, and the station -> city dimension.
CITIES = ("boston", "chicago", "new york")
STATION_CITIES = (("STN0", "boston"), ("STN1", "boston"), ("STN1", "chicago"), ("STN0", "new york"))
# News geo names by key modulo 3 and the strict match text per city.
GEO_NAMES = (
    "Boston, Massachusetts, United States",
    "Chicago, Illinois, United States",
    "New York, New York, United States",
)
STRICT_GEO = (("boston", "Boston, Massachusetts"), ("chicago", "Chicago, Illinois"), ("new york", "New York, New York"))


def _city(key: Column) -> Column:
    m = key % 3
    return F.when(m == 0, F.lit(CITIES[0])).when(m == 1, F.lit(CITIES[1])).otherwise(F.lit(CITIES[2]))


def _ts(c: str) -> Column:
    return F.col(c).cast("timestamp")


# Event type -> 311 service name (purchase is deliberately unmapped).
SERVICE_BY_EVENT = (
    ("click", "Pothole"),
    ("view", "Illegal Parking"),
    ("error", "Rodent Activity"),
    ("signup", "Needle Cleanup"),
    ("purchase", "Street Light Outage"),
)


def _lookup(col: Column, pairs, default=None) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def bronze_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze 311 records (lake path) from ``events``."""
    ev = tables.read(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    dept = F.concat(F.lit("dept"), (uid % 4).cast("string"))
    ts = _ts("ts")
    ingested = F.date_trunc("day", ts) + F.expr("INTERVAL 1 DAY")
    status = (
        F.when(eid % 17 == 0, F.lit(None).cast("string"))
        .when(eid % 3 == 0, "Open")
        .when(eid % 3 == 1, "closed")
        .otherwise("in progress")
    )
    code = (
        F.when(uid % 10 == 0, F.lit(None).cast("string"))
        .when(uid % 10 == 1, dept)
        .otherwise(F.concat(dept, F.lit(":"), F.col("event_type")))
    )
    return ev.select(
        F.lit("open311").alias("source"),
        _city(uid).alias("city"),
        F.concat(F.date_format(ingested, "yyyyMMdd"), F.lit("-"), F.replace(_city(uid), F.lit(" "), F.lit("_"))).alias("batch_id"),
        ingested.alias("ingested_at_utc"),
        eid.cast("string").alias("service_request_id"),
        status.alias("status"),
        _lookup(F.col("event_type"), SERVICE_BY_EVENT).alias("service_name"),
        code.alias("service_code"),
        F.lit(None).cast("string").alias("description"),
        ts.alias("requested_datetime"),
        (ts + F.make_dt_interval(hours=uid.cast("int"))).alias("updated_datetime"),
        F.when(eid % 3 == 1, ts + F.make_dt_interval(hours=uid.cast("int"))).alias("closed_datetime"),
        F.lit(None).cast("string").alias("address"),
        (F.lit(42.0) + (uid % 50) / 100.0).alias("lat"),
        (F.lit(-71.0) - (eid % 50) / 100.0).alias("lon"),
        F.lit(None).cast("string").alias("media_url"),
    )


def delivered_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze records with re-deliveries: every third request arrives again, updated and
    closed, in a batch ingested two days later (Q20)."""
    first = bronze_requests(spark, sf_dir)
    later = first["ingested_at_utc"] + F.expr("INTERVAL 2 DAYS")
    again = first.filter(F.col("service_request_id").cast("long") % 3 == 0).withColumns({
        "ingested_at_utc": later, "status": F.lit("closed"),
        "updated_datetime": F.col("updated_datetime") + F.expr("INTERVAL 2 DAYS"),
        "batch_id": F.concat(F.date_format(later, "yyyyMMdd"), F.substring("batch_id", 9, 100)),
    })
    return first.unionByName(again)


def late_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``delivered_requests`` with deliveries older than a week: every fifth request arrives once
    more 12 days later, and all Boston requests of the first ingest day 20 days later, so that
    this day's Boston partition ends without a row."""
    every = delivered_requests(spark, sf_dir)
    first = bronze_requests(spark, sf_dir)

    def again(rows: DataFrame, days: int, status: str, updated: str) -> DataFrame:
        later = F.col("ingested_at_utc") + F.expr(f"INTERVAL {days} DAYS")
        return rows.withColumns({"ingested_at_utc": later, "status": F.lit(status), "updated_datetime": F.col("updated_datetime") + F.expr(updated),
                                 "batch_id": F.concat(F.date_format(later, "yyyyMMdd"), F.substring("batch_id", 9, 100))})

    start = first.filter(F.col("city") == CITIES[0]).agg(F.min("ingested_at_utc")).first()[0]
    emptied = first.filter((F.col("city") == CITIES[0]) & (F.col("ingested_at_utc") == F.lit(start)))
    fifth = first.filter(F.col("service_request_id").cast("long") % 5 == 1)
    return every.unionByName(again(fifth, 12, "open", "INTERVAL 12 DAYS")).unionByName(again(emptied, 20, "closed", "INTERVAL 400 DAYS"))


# The 14-row category mapping (raw, normalized, infrastructure, emergency).
CATEGORY_MAPPING = (
    ("Broken Sidewalk", "Sidewalk Infrastructure", 1, 0),
    ("Pothole", "Road Infrastructure", 1, 0),
    ("Damaged Sign", "Traffic Infrastructure", 1, 0),
    ("Requests for Street Cleaning", "Sanitation", 0, 0),
    ("Residential Trash out Illegally", "Sanitation Violation", 0, 0),
    ("Overflowing or Unkept Dumpster", "Sanitation Violation", 0, 0),
    ("Rodent Activity", "Public Health", 0, 1),
    ("Needle Cleanup", "Public Health Hazard", 0, 1),
    ("Poor Conditions of Property", "Property Violation", 0, 0),
    ("Unsatisfactory Living Conditions", "Housing Violation", 0, 1),
    ("Illegal Parking", "Traffic Violation", 0, 0),
    ("Abandoned Vehicle", "Traffic Violation", 0, 0),
    ("Abandoned Bicycle", "Public Space Issue", 0, 0),
    ("Other", "General Request", 0, 0),
)


def category_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(CATEGORY_MAPPING),
        "raw_category string, normalized_category string, is_infrastructure int, is_emergency_type int",
    )


def station_cities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATION_CITIES), "station_id string, city string")


def requests_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``requests_311`` rows (daily path) from ``orders``; status lower-cased at ingest."""
    o = tables.read(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    requested = _ts("o_orderdate")
    return o.select(
        F.col("o_orderkey").cast("string").alias("service_request_id"),
        _city(F.col("o_custkey")).alias("city"),
        F.when(st == "F", "closed").when(st == "O", "open").otherwise("in progress").alias("status"),
        F.col("o_orderpriority").alias("service_name"),
        requested.alias("requested_datetime"),
        (requested + F.make_dt_interval(hours=(F.col("o_custkey") % 200).cast("int"))).alias("updated_datetime"),
    )


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``weather_daily`` rows keyed by (station_id, obs_date) from ``orders``."""
    o = tables.read(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    return (
        o.groupBy(
            F.concat(F.lit("STN"), (F.col("o_custkey") % 2).cast("string")).alias("station_id"),
            F.to_date(F.col("o_orderdate")).alias("obs_date"),
        )
        .agg(
            rnd(F.max(price) / 12500, 2).alias("tmax"),
            rnd(F.min(price) / 12500, 2).alias("tmin"),
            rnd(F.max(F.when(F.col("o_orderstatus") == "F", price / 10000)), 2).alias("heat_index_max"),
            rnd(F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", price / 100000)), 2).alias("precip_6hr_max"),
        )
    )


# Alert scales picked by priority digit, order status and customer key.
SEVERITY_BY_PRIORITY = (("1", "Extreme"), ("2", "Severe"), ("3", "Moderate"), ("4", "Minor"), ("5", "Unknown"))
URGENCY_BY_STATUS = (("F", "Immediate"), ("O", "Expected"), ("P", "Past"))
CERTAINTY_BY_MOD4 = ((0, "Observed"), (1, "Likely"), (2, "Possible"), (3, "Unlikely"))


def alert_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert GeoJSON-like features (id + nested properties) from ``orders``."""
    o = tables.read(spark, sf_dir, "orders")
    props = F.struct(
        F.col("o_orderpriority").alias("event"),
        _lookup(F.substring("o_orderpriority", 1, 1), SEVERITY_BY_PRIORITY).alias("severity"),
        _lookup(F.col("o_orderstatus"), URGENCY_BY_STATUS).alias("urgency"),
        _lookup(F.col("o_custkey") % 4, CERTAINTY_BY_MOD4).alias("certainty"),
        F.lit("Monitor").alias("response"),
        F.lit("Met").alias("category"),
        _ts("o_orderdate").alias("onset"),
        (_ts("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("expires"),
        F.concat(F.lit("alert "), F.col("o_orderkey").cast("string")).alias("headline"),
        F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("string").alias("instruction"),
        F.lit(None).cast("string").alias("areaDesc"),
    )
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        _city(F.col("o_custkey")).alias("city"),
        F.to_date("o_orderdate").alias("obs_date"),
        props.alias("properties"),
    )


def news_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News-event export rows from ``lineitem`` (numeric fields typed; the TSV path,
    ``e12_news_tsv``, lands them as text and parses them back)."""
    li = tables.read(spark, sf_dir, "lineitem")
    geo = lambda k: F.when(k == 0, F.lit(GEO_NAMES[0])).when(k == 1, F.lit(GEO_NAMES[1])).otherwise(F.lit(GEO_NAMES[2]))
    ln = F.col("l_linenumber")
    return li.select(
        F.date_format("l_shipdate", "yyyyMMdd").alias("SQLDATE"),
        F.when(ln == 4, F.lit("14")).otherwise(F.lpad(ln.cast("string"), 2, "0")).alias("EventRootCode"),
        ((F.col("l_tax") - F.col("l_discount")) * 100).alias("AvgTone"),
        (F.col("l_quantity") / 5 - 5).alias("GoldsteinScale"),
        F.col("l_quantity").cast("bigint").cast("double").alias("NumMentions"),
        ln.cast("double").alias("NumSources"),
        (F.col("l_quantity").cast("bigint") + ln).cast("double").alias("NumArticles"),
        F.when(F.col("l_partkey") % 5 == 0, F.lit(None).cast("string"))
        .otherwise(geo(F.col("l_suppkey") % 2))
        .alias("Actor1Geo_FullName"),
        F.lit(None).cast("string").alias("Actor2Geo_FullName"),
        geo(F.col("l_suppkey") % 3).alias("ActionGeo_FullName"),
        F.concat(F.lit("u"), F.col("l_orderkey").cast("string")).alias("SOURCEURL"),
    )


def place_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News rows whose geo texts name a customer with their nation, and a supplier's nation."""
    li, orders = tables.read(spark, sf_dir, "lineitem"), tables.read(spark, sf_dir, "orders")
    customers, suppliers = tables.read(spark, sf_dir, "customer"), tables.read(spark, sf_dir, "supplier")
    nations = tables.read(spark, sf_dir, "nation")
    home = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.concat("c_name", F.lit(", "), F.initcap("n_name")).alias("ActionGeo_FullName"))
    base = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("supplier_nation"))
    # the customer's text meets the orders, not their many lines
    placed = orders.join(home, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "ActionGeo_FullName")
    rows = li.join(base, F.col("l_suppkey") == F.col("s_suppkey")).join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        "l_orderkey", "l_linenumber", "ActionGeo_FullName", F.lit(None).cast("string").alias("Actor2Geo_FullName"),
        F.when(F.col("l_partkey") % 5 > 0, F.col("supplier_nation")).alias("Actor1Geo_FullName"))


def place_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names to look for: all customers, nations and regions, and two short ones."""
    read = lambda t, c: tables.read(spark, sf_dir, t).select(F.col(c).alias("city"))
    return read("customer", "c_name").union(read("nation", "n_name")).union(read("region", "r_name")).union(
        spark.createDataFrame([("In",), ("a",)], "city string"))


def _ring(n: int, cx: Column, cy: Column, radius: Column, wobble: float) -> Column:
    """A closed star of ``n`` vertices as a struct of coordinate arrays."""
    turn = lambda i: i * F.lit(2 * 3.141592653589793 / n)
    far = lambda i: radius * (F.lit(1.0) + F.lit(wobble) * F.sin(turn(i) * 5))
    return F.struct(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: cx + far(i) * F.cos(turn(i))).alias("xs"),
                    F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: cy + far(i) * F.sin(turn(i))).alias("ys"))


def nested_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones of very different sizes: countries (regions), districts with holes (nations) and
    blocks (suppliers), all around the requests' coordinates."""
    key = lambda t, c: tables.read(spark, sf_dir, t).select(F.col(c).cast("double").alias("k"))
    k = F.col("k")
    country = key("region", "r_regionkey").select(F.concat(F.lit("R"), k.cast("int")).alias("zone_id"), F.array(
        _ring(400, -74.03 + k, 40.01 + k * 0.5, F.lit(3.7), 0.1)).alias("rings"))
    cx, cy, far = -71.48 + (k * 7 % 25) * 0.0197, 42.02 + (k * 11 % 25) * 0.0189, 0.013 + (k % 7) * 0.0131
    district = key("nation", "n_nationkey").select(F.concat(F.lit("D"), k.cast("int")).alias("zone_id"), F.array(
        _ring(90, cx, cy, far, 0.3), _ring(24, cx, cy, far * 0.4, 0.0)).alias("rings"))
    block = key("supplier", "s_suppkey").select(F.concat(F.lit("B"), k.cast("int")).alias("zone_id"), F.array(
        _ring(6, -71.4933 + (k * 37 % 499) * 0.00099, 42.0023 + (k * 91 % 499) * 0.00097, F.lit(0.0061), 0.0)).alias("rings"))
    return country.union(district).union(block)


# Article theme lists by event type (purchase has none).
THEMES_BY_EVENT = (
    ("error", "KILL;CRISISLEX_T03_DEAD"),
    ("view", "POWER_OUTAGE;ECON"),
    ("click", "TAX_X"),
    ("signup", "CRISISLEX_C05_NEED_OF_SHELTERS"),
)
LOCATION_NAMES = ("Boston", "Chicago", "New York")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article records (date, url, themes, locations, tone fields) from ``events``."""
    ev = tables.read(spark, sf_dir, "events")
    uid, eid = F.col("user_id"), F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    m = uid % 3
    loc = F.when(m == 0, F.lit(LOCATION_NAMES[0])).when(m == 1, F.lit(LOCATION_NAMES[1])).otherwise(F.lit(LOCATION_NAMES[2]))
    etype = F.col("event_type")
    counts = (
        F.when(etype == "error", F.concat(F.lit("PROTEST#"), (k % 7).cast("string"), F.lit("#people#1#Boston;KILL#2#people#1#Boston")))
        .when(etype == "view", F.concat(F.lit("PROTEST#3#crowd#1#Chicago;PROTEST#"), (uid % 5).cast("string"), F.lit("#crowd#1#Chicago")))
        .when(etype == "click", F.lit("ARREST#1#man#1#Boston"))
    )
    return ev.select(
        _ts("ts").alias("article_ts"),
        F.concat(F.lit("a"), eid.cast("string")).alias("SOURCEURL"),
        _lookup(etype, THEMES_BY_EVENT).alias("V2Themes"),
        F.when(uid % 4 == 0, F.concat(loc, F.lit(";Chicago"))).otherwise(loc).alias("V2Locations"),
        F.concat(
            (k - 50).cast("string"), F.lit("."), (eid % 10).cast("string"), F.lit(",1.5,2.5,"),
            (uid % 13).cast("string"), F.lit(".25,0,0"),
        ).alias("V15Tone"),
        counts.alias("V1Counts"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State-machine status events (detail fields) from ``orders``."""
    o = tables.read(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    start_ms = F.unix_millis(_ts("o_orderdate"))
    failed = st != "F"
    return o.select(
        F.concat(F.lit("arn:exec:"), F.col("o_orderkey").cast("string")).alias("executionArn"),
        F.when(F.col("o_orderkey") % 50 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("a:b:c:pipe-"), F.substring("o_orderpriority", 1, 1)))
        .alias("stateMachineArn"),
        F.when(st == "F", "SUCCEEDED").when(st == "O", "FAILED").otherwise("TIMED_OUT").alias("status"),
        start_ms.alias("startDate"),
        F.when(failed & (F.col("o_orderkey") % 40 == 0), F.lit(None).cast("bigint"))
        .otherwise(start_ms + F.col("o_custkey") * 997)
        .alias("stopDate"),
        F.when(failed & (F.col("o_custkey") % 4 != 0), F.concat(F.lit("States.E"), (F.col("o_custkey") % 3).cast("string")))
        .alias("error"),
        F.when(failed & (F.col("o_custkey") % 3 != 0), F.concat(F.lit("cause "), (F.col("o_custkey") % 7).cast("string")))
        .alias("cause"),
    )


def observation_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station observation readings as nested JSON text (P5) from ``events``."""
    ev = tables.read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    etype = F.col("event_type")
    ts = _ts("ts")
    no_temp = (F.dayofmonth(ts) % 4 == 0) | (F.col("event_id") % 11 == 0)
    temp = F.when(no_temp, F.lit("null")).otherwise(F.concat(F.lit('{"value":'), k, F.lit("}")))
    heat = F.when(etype.isin("click", "purchase"), F.concat(F.lit('{"value":'), F.col("value").cast("string"), F.lit("}"))).otherwise(F.lit("{}"))
    precip = F.when(etype == "error", F.concat(F.lit('{"value":'), (F.col("value") / 10).cast("string"), F.lit("}"))).otherwise(F.lit('"n/a"'))
    gust = F.when(etype == "view", F.concat(F.lit('{"value":'), F.col("value").cast("string"), F.lit("}"))).otherwise(F.lit('{"value":null}'))
    props = F.concat(
        F.lit('{"properties":{"temperature":'), temp,
        F.lit(',"heatIndex":'), heat,
        F.lit(',"precipitationLast6Hours":'), precip,
        F.lit(',"windGust":'), gust,
        F.lit(',"relativeHumidity":{"value":'), k, F.lit("}"),
        F.lit(',"textDescription":"'), etype, F.lit('"}}'),
    )
    return ev.select(
        F.concat(F.lit("STN"), (F.col("user_id") % 2).cast("string")).alias("station_id"),
        F.to_date(ts).alias("obs_date"),
        props.alias("feature_json"),
    )


# Event type -> daily-climate data type.
DATATYPE_BY_EVENT = (("click", "TMAX"), ("view", "TMIN"), ("error", "PRCP"), ("signup", "AWND"), ("purchase", "WSF5"))


def daily_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tall daily-climate values (station, date, datatype, value) from ``events``."""
    ev = tables.read(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("STN"), (F.col("user_id") % 2).cast("string")).alias("station_id"),
        F.to_date(_ts("ts")).alias("obs_date"),
        _lookup(F.col("event_type"), DATATYPE_BY_EVENT).alias("datatype"),
        (F.col("value") - 10).alias("value"),
    )


def socrata_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Socrata-style 311 records (text fields, '' for missing) from ``orders``."""
    o = tables.read(spark, sf_dir, "orders")
    key, cust, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    opened = _ts("o_orderdate")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return o.select(
        F.when(key % 13 == 0, F.lit(None).cast("string")).otherwise(key.cast("string")).alias("case_enquiry_id"),
        F.when(key % 26 == 0, F.concat(F.lit("sr"), key.cast("string"))).alias("service_request_id"),
        F.when(cust % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("reason"), (cust % 5).cast("string"))).alias("reason"),
        F.when(cust % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("dept"), (cust % 4).cast("string"))).alias("department"),
        F.when(key % 5 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("case_title"),
        F.when(st == "F", "Closed").when(st == "O", "Open").otherwise("In Progress").alias("case_status"),
        iso(opened).alias("open_dt"),
        F.when(st == "F", iso(opened + F.make_dt_interval(hours=(cust % 200).cast("int")))).otherwise(F.lit("")).alias("closed_dt"),
        iso(opened + F.expr("INTERVAL 72 HOURS")).alias("target_dt"),
        (F.col("o_totalprice") / 1e6).alias("latitude"),
        (-F.col("o_totalprice") / 1e6).alias("longitude"),
        F.concat(F.lit("n"), (cust % 9).cast("string")).alias("neighborhood"),
        F.when(st == "F", F.lit("resolved")).otherwise(F.lit("")).alias("closure_reason"),
    )


def open311_api_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open311 API records as the collector receives them, from ``events``."""
    b = bronze_requests(spark, sf_dir)
    return b.select(
        F.when(F.col("service_request_id").cast("bigint") % 23 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("service_request_id"))
        .alias("service_request_id"),
        "service_code",
        "service_name",
        "status",
        "requested_datetime",
        "updated_datetime",
        F.col("lat"),
        F.col("lon").alias("long"),
        "description",
    )
