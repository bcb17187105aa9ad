"""The operators applied to the driver's tables (mapping in SURVEY §7.3).

Mapping used throughout:

* hotel offer = ``lineitem`` row; city = ``l_suppkey``; day = month of
  ``l_shipdate``; total price = ``l_extendedprice`` (per night = / 4);
  review = ``l_quantity``; the scored currency = ``l_returnflag = 'R'``.
* import log = ``events``; key = (``user_id``, ``event_type``); import time =
  ``ts``; flight duration = ``floor(value)`` minutes.
* capital = ``nation``; country = ``region``.

Every query reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark import schemas
from waymark.constants import BEST_BUCKET, CURRENCY, ORIGIN_CITY, PRICE_DIVISOR_NIGHTS
from waymark.functions import timefn
from waymark.functions.scoring import price_per_night
from waymark.operators import catalog, flights, hotels, latest, reports, sets
from waymark.session import scratch_path
from waymark.sources import delimited, payloads, sinks, topics
from waymark.sources.tables import read_table, register_views, scan_columns, sql_table
from waymark.streaming import history

OFFER_KEYS = ("l_suppkey", "ship_month")
OFFER_ARGS = dict(keys=OFFER_KEYS, price="price_per_night", review="l_quantity",
                  currency_col="l_returnflag", currency="R")


def lineitem_offers(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem")
    return li.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_returnflag",
        F.trunc(F.to_date("l_shipdate"), "month").alias("ship_month"),
        price_per_night("l_extendedprice", PRICE_DIVISOR_NIGHTS).alias("price_per_night"),
        "l_quantity", "l_shipdate")


# --- hotels -------------------------------------------------------------------

def q_hotel_range(spark: SparkSession, base: str) -> DataFrame:
    """Min/max price per night and quantity per (supplier, ship month) of returned items."""
    return hotels.hotel_range(lineitem_offers(spark, base), **OFFER_ARGS)


def q_price_per_night(spark: SparkSession, base: str) -> DataFrame:
    """Extended price over four nights, every line item."""
    li = read_table(spark, base, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice",
                     price_per_night("l_extendedprice", PRICE_DIVISOR_NIGHTS).alias("price_per_night"))


SCORED_COLUMNS = ("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "ship_month",
                  "price_per_night", "l_quantity", "price_points", "review_points", "total_points")


def q_hotel_score(spark: SparkSession, base: str) -> DataFrame:
    """Price and review points of every scored line item."""
    scored = hotels.hotel_score(lineitem_offers(spark, base), **OFFER_ARGS)
    return scored.select(*SCORED_COLUMNS)


def q_hotel_top3(spark: SparkSession, base: str) -> DataFrame:
    """The three best-scored items per (supplier, ship month), ties kept."""
    top = hotels.hotel_top3(lineitem_offers(spark, base), **OFFER_ARGS)
    return top.select(*SCORED_COLUMNS, "rank")


HOTELDAY_FROM_LINEITEM = {
    "ship_month": "checkin_date",
    "l_suppkey": "city",
    "l_partkey": "name",
    "price_per_night": "price",
    "l_quantity": "rating",
    "l_shipdate": "import_date",
}


def q_hotelday_publish(spark: SparkSession, base: str) -> DataFrame:
    """The top three renamed to the published hotel-day columns."""
    top = hotels.hotel_top3(lineitem_offers(spark, base), **OFFER_ARGS)
    return hotels.hotelday_publish(top, HOTELDAY_FROM_LINEITEM)


QUERIES: dict = {
    "hotel_range": q_hotel_range,
    "price_per_night": q_price_per_night,
    "hotel_score": q_hotel_score,
    "hotel_top3": q_hotel_top3,
    "hotelday_publish": q_hotelday_publish,
}


# --- import log: latest import, date window -------------------------------------


REF_DATE = "2024-01-10"
EVENT_COLUMNS = ("event_id", "user_id", "event_type", "ts", "value")


def _events(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "events")


def q_latest_flights(spark: SparkSession, base: str) -> DataFrame:
    """Events of each (day, user, type) at its latest time."""
    ev = _events(spark, base).select(*EVENT_COLUMNS).withColumn("day", F.to_date("ts"))
    return latest.latest_per_key(ev, ["day", "user_id", "event_type"], ts="ts")


LATEST_FLIGHTS_SQL = """
SELECT event_id, user_id, event_type, day, ts, value
FROM (SELECT event_id, user_id, event_type, to_date(ts) AS day, ts, value,
             rank() OVER (PARTITION BY to_date(ts), user_id, event_type ORDER BY ts DESC) AS age
      FROM events
      WHERE ts >= CAST(:ref AS TIMESTAMP_NTZ)
        AND ts < timestampadd(DAY, :days, CAST(:ref AS TIMESTAMP_NTZ)))
WHERE age = 1
"""


def q_latest_flights_sql(spark: SparkSession, base: str) -> DataFrame:
    """The same as SQL text over a view, for the four days from the reference date."""
    register_views(spark, base, ["events"])
    return sql_table(spark, LATEST_FLIGHTS_SQL, ref=REF_DATE, days=4)


def q_latest_hotels(spark: SparkSession, base: str) -> DataFrame:
    """Events of each (user, type) at its latest time."""
    ev = _events(spark, base).select(*EVENT_COLUMNS)
    return latest.latest_per_key(ev, ["user_id", "event_type"], ts="ts")


def q_date_window(spark: SparkSession, base: str) -> DataFrame:
    """Events in the four days from the reference date."""
    return latest.date_window(_events(spark, base), "ts", REF_DATE, 4)


# --- flights: arrival time, dedupe, first item ----------------------------------

def _flight_like(spark: SparkSession, base: str) -> DataFrame:
    return _events(spark, base).select(
        "event_id", "ts", timefn.clock_of_ts("ts").alias("departure_time"),
        F.floor("value").cast("int").alias("duration"))


def q_arrival_time(spark: SparkSession, base: str) -> DataFrame:
    """Event time as departure plus floor(value) minutes: clock, full time, hours."""
    return flights.arrival_time(_flight_like(spark, base), clock="departure_time",
                                duration="duration", departure_ts="ts")


def q_arrival_time_compat(spark: SparkSession, base: str) -> DataFrame:
    """The same departure and duration under the original carry rule."""
    return flights.arrival_time_compat(_flight_like(spark, base), clock="departure_time",
                                       duration="duration").drop("ts")


def q_flight_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Distinct (supplier, return flag, line status)."""
    li = read_table(spark, base, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus")
    return flights.flight_dedup(li)


def q_best_item(spark: SparkSession, base: str) -> DataFrame:
    """Each user's first event by (time, id)."""
    ev = _events(spark, base).select(*EVENT_COLUMNS)
    return flights.first_per_key(ev, ["user_id"], ["ts", "event_id"])


QUERIES.update({
    "latest_flights": q_latest_flights,
    "latest_flights_sql": q_latest_flights_sql,
    "latest_hotels": q_latest_hotels,
    "date_window": q_date_window,
    "arrival_time": q_arrival_time,
    "arrival_time_compat": q_arrival_time_compat,
    "flight_dedup": q_flight_dedup,
    "best_item": q_best_item,
})


# --- payloads and topic records ----------------------------------------------------


HOTEL_ITEM_FROM_LINEITEM = {
    "city_trans": "CAST(l_suppkey AS STRING)",
    "hotel_name": "CAST(l_partkey AS STRING)",
    "min_total_price": "l_extendedprice",
    "currencycode": "l_returnflag",
    "longitude": "l_discount",
    "latitude": "l_tax",
    "review_score": "l_quantity",
}


def hotel_responses(spark: SparkSession, base: str) -> DataFrame:
    """Response pages of a (city, month)'s offers, up to fifty on a page."""
    li = read_table(spark, base, "lineitem").withColumn(
        "checkin_date", F.trunc(F.to_date("l_shipdate"), "month"))
    items = {k: F.expr(v) for k, v in HOTEL_ITEM_FROM_LINEITEM.items()}
    return payloads.hotel_payload_of(li, ["l_suppkey", "checkin_date"], items).drop("l_suppkey")


def q_hotel_payload_parse(spark: SparkSession, base: str) -> DataFrame:
    """Line items packed into hotel responses and parsed back to rows."""
    return payloads.parse_hotel_payload(hotel_responses(spark, base))


def flight_responses(spark: SparkSession, base: str) -> DataFrame:
    """One search response per event: purchases carry the chosen bucket, a search whose
    price is under 5 found no bookable items (empty list), error events have no itineraries."""
    ev = _events(spark, base)
    leg = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("departure"),
        F.floor("value").cast("int").alias("durationInMinutes"),
        F.pmod("user_id", F.lit(3)).cast("int").alias("stopCount"),
        F.struct(F.array(F.struct(F.col("event_type").alias("name"))).alias("marketing")).alias("carriers"))
    item = F.struct(F.struct(F.col("value").alias("raw")).alias("price"), F.array(leg).alias("legs"))
    items = F.when(F.col("value") < 5, F.filter(F.array(item), lambda x: F.lit(False))) \
             .otherwise(F.array(item))
    bucket = F.struct(F.when(F.col("event_type") == "purchase", F.lit(BEST_BUCKET))
                      .otherwise(F.lit("Cheapest")).alias("id"), items.alias("items"))
    body = F.when(F.col("event_type") == "error",
                  F.to_json(F.struct(F.lit("rate limited").alias("message")))) \
            .otherwise(F.to_json(F.struct(F.struct(F.array(bucket).alias("buckets")).alias("itineraries"))))
    return ev.select(F.to_date("ts").alias("date"), F.lit(ORIGIN_CITY).alias("origin"),
                     F.col("user_id").cast("string").alias("destination"),
                     F.col("ts").alias("import_date"), body.alias("payload"))


def q_flight_payload_parse(spark: SparkSession, base: str) -> DataFrame:
    """Flights parsed from the event responses' chosen bucket."""
    return payloads.parse_flight_payload(flight_responses(spark, base))


def q_payload_rejects(spark: SparkSession, base: str) -> DataFrame:
    """Event responses that give no flight, with the reason."""
    return payloads.flight_payload_rejects(flight_responses(spark, base))


def _event_records(spark: SparkSession, base: str, value: str) -> DataFrame:
    ev = _events(spark, base)
    return ev.select(F.col("event_id").cast("string").alias("key"), F.col(value).alias("value"),
                     F.col("ts").alias("timestamp"))


def q_topic_encode(spark: SparkSession, base: str) -> DataFrame:
    """Every event as a keyed JSON record."""
    return topics.encode_records(_events(spark, base), key="event_id")


def q_topic_decode(spark: SparkSession, base: str) -> DataFrame:
    """The events' JSON property decoded with a declared schema; record time as import time."""
    return topics.decode_records(_event_records(spark, base, "props"), "k BIGINT", keep=["key"])


def q_topic_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """Events encoded to records and decoded back to the same rows."""
    ev = _events(spark, base)
    records = topics.encode_records(ev, key="event_id")
    return topics.decode_records(records, ev.schema, timestamp=None)


def q_topic_counts(spark: SparkSession, base: str) -> DataFrame:
    """Records per event type."""
    return topics.record_counts(_events(spark, base).withColumnRenamed("event_type", "topic"))


QUERIES.update({
    "hotel_payload_parse": q_hotel_payload_parse,
    "flight_payload_parse": q_flight_payload_parse,
    "payload_rejects": q_payload_rejects,
    "topic_encode": q_topic_encode,
    "topic_decode": q_topic_decode,
    "topic_roundtrip": q_topic_roundtrip,
    "topic_counts": q_topic_counts,
})


# --- catalogue, sets, reports -------------------------------------------------------


SELECTED_COUNTRY = "NATION_1"
SELECTED_DAY = "1995-01-20"
HOME_NATION = "NATION_0"


def _capitals(spark: SparkSession, base: str) -> DataFrame:
    """Capital catalogue: one row per nation with its region as the country."""
    nation = read_table(spark, base, "nation")
    region = read_table(spark, base, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        "n_nationkey", F.col("n_name").alias("capital"), F.col("r_name").alias("country"))


def q_request_plan(spark: SparkSession, base: str) -> DataFrame:
    """Every capital (nation) with its country (region), for the three days after the
    reference date (J5 F12)."""
    return catalog.request_plan(_capitals(spark, base), REF_DATE, n_days=3, offset=1)


def q_filter_by_country(spark: SparkSession, base: str) -> DataFrame:
    """Suppliers located in the capital of one country."""
    supplier = read_table(spark, base, "supplier").withColumnRenamed("s_nationkey", "city")
    nations = read_table(spark, base, "nation")
    return catalog.filter_by_country(supplier, nations, SELECTED_COUNTRY,
                                     capital_col="n_nationkey", catalog_country_col="n_name")


def q_filter_by_day(spark: SparkSession, base: str) -> DataFrame:
    """Orders of one day."""
    orders = read_table(spark, base, "orders")
    return catalog.filter_by_day(orders, SELECTED_DAY, columns=("date", "checkin_date", "o_orderdate"))


def q_catalog_options(spark: SparkSession, base: str) -> DataFrame:
    """Each country name with each of the next four days."""
    nations = read_table(spark, base, "nation")
    return catalog.catalog_options(scan_columns(nations, "n_name").withColumnRenamed("n_name", "country"), "country",
                                   "2024-01-11", n_days=4)


def q_union_by_name(spark: SparkSession, base: str) -> DataFrame:
    """Orders and line items in one table by column name."""
    return sets.union_by_name(read_table(spark, base, "orders"), read_table(spark, base, "lineitem"))


def _points(spark: SparkSession, base: str) -> DataFrame:
    return sets.map_points({
        "monument": (read_table(spark, base, "customer"), "c_name", "c_acctbal", "c_nationkey"),
        "hotel": (read_table(spark, base, "supplier"), "s_name", "s_acctbal", "s_nationkey"),
    })


def q_map_points(spark: SparkSession, base: str) -> DataFrame:
    """Customers and suppliers as one point table with a layer column."""
    return _points(spark, base)


def q_geo_midpoint(spark: SparkSession, base: str) -> DataFrame:
    """Bounding-box centre per event type."""
    ev = _events(spark, base).select("event_type", F.col("value").alias("lon"),
                                     F.col("user_id").cast("double").alias("lat"))
    return reports.geo_midpoint(ev, ["event_type"])


def q_price_extremes(spark: SparkSession, base: str) -> DataFrame:
    """Every line item's price flagged against the table's rounded max/min, raw form."""
    li = read_table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return reports.price_flags(li, "l_extendedprice", rounded=False)


BOARD_DAYS = 14


def q_price_board(spark: SparkSession, base: str) -> DataFrame:
    """The board of the days from the reference date: each type's latest import of a user and day,
    flagged against the type's rounded max/min (V1)."""
    window = latest.date_window(_events(spark, base), "ts", REF_DATE, BOARD_DAYS)
    board = window.select(
        F.col("event_type").alias("destination"), F.to_date("ts").alias("date"), "user_id",
        timefn.clock_of_ts("ts").alias("time"),
        F.pmod("user_id", F.lit(3)).cast("int").alias("n_connections"),
        F.col("value").alias("price"), F.col("ts").alias("import_date"))
    newest = latest.latest_per_key(board, ["date", "user_id", "destination"], method="landed")
    return reports.price_flags(newest.drop("import_date"), "price", group=["destination"], rounded=True)


def q_monument_list(spark: SparkSession, base: str) -> DataFrame:
    """Parts numbered per brand by (name, key)."""
    part = read_table(spark, base, "part").select("p_brand", "p_name", "p_partkey")
    return reports.numbered(part, ["p_brand"], ["p_name", "p_partkey"])


def q_trip_report(spark: SparkSession, base: str) -> DataFrame:
    """Per nation: latest order, three richest suppliers, customer count."""
    nation = read_table(spark, base, "nation")
    plan = nation.select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("country"))
    customer = read_table(spark, base, "customer")
    orders = read_table(spark, base, "orders")
    supplier = read_table(spark, base, "supplier")
    # flight side: each nation's latest order (order date, then key), as text
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner").select(
        F.col("c_nationkey").alias("nationkey"), "o_orderkey", "o_orderdate", "o_totalprice")
    last = flights.first_per_key(joined, ["nationkey"], ["o_orderdate", "o_orderkey"],
                                 descending=True)
    flight_side = last.select("nationkey", F.format_string(
        "order %d on %s for %.2f", F.col("o_orderkey"),
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_totalprice")).alias("flight"))
    # hotel side: three suppliers with the highest balance
    hotel_side = reports.top_slots(
        supplier.withColumnRenamed("s_nationkey", "nationkey"), ["nationkey"],
        F.format_string("%s (%.2f)", F.col("s_name"), F.col("s_acctbal")),
        [F.col("s_acctbal").desc(), F.col("s_suppkey")])
    # monument side: how many customers the nation has
    monuments = customer.groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.format_string("%d monuments", F.count(F.lit(1))).alias("monuments"))
    return reports.trip_report(plan, ["nationkey"], "country", HOME_NATION,
                               flights=flight_side, hotels=hotel_side, monuments=monuments)


QUERIES.update({
    "request_plan": q_request_plan,
    "filter_by_country": q_filter_by_country,
    "filter_by_day": q_filter_by_day,
    "catalog_options": q_catalog_options,
    "union_by_name": q_union_by_name,
    "map_points": q_map_points,
    "geo_midpoint": q_geo_midpoint,
    "price_extremes": q_price_extremes,
    "price_board": q_price_board,
    "monument_list": q_monument_list,
    "trip_report": q_trip_report,
})


# --- tables, files, casts, streams ---------------------------------------------------


def q_key_check(spark: SparkSession, base: str) -> DataFrame:
    """(order key, line number) pairs that occur more than once (K4)."""
    li = read_table(spark, base, "lineitem")
    return sinks.key_violations(li, ["l_orderkey", "l_linenumber"])


def q_typed_cast(spark: SparkSession, base: str) -> DataFrame:
    """Order price as int (floor), order date as date, priority level via try_cast."""
    o = read_table(spark, base, "orders")
    return o.select(
        "o_orderkey",
        F.floor("o_totalprice").cast("int").alias("total_int"),
        F.to_date("o_orderdate").alias("order_date"),
        F.substring_index("o_orderpriority", "-", 1).try_cast("int").alias("priority"))


def q_date_format(spark: SparkSession, base: str) -> DataFrame:
    """Order date as yyyy-MM-dd and yyyy-MM text."""
    o = read_table(spark, base, "orders")
    return o.select("o_orderkey", timefn.to_iso_date_text("o_orderdate").alias("order_day"),
                    F.date_format("o_orderdate", "yyyy-MM").alias("order_month"))


def q_table_scan(spark: SparkSession, base: str) -> DataFrame:
    """A full table scan."""
    return read_table(spark, base, "orders")


def q_table_overwrite(spark: SparkSession, base: str) -> DataFrame:
    """Write the whole table, then the whole table with one column changed: the scan sees only the second write."""
    orders = read_table(spark, base, "orders")
    path = scratch_path(spark, "orders-table")
    sinks.overwrite_table(sinks.conform(orders, orders.schema), path)
    sinks.overwrite_table(orders.withColumn("o_orderstatus", F.lower("o_orderstatus")), path)
    return spark.read.parquet(path)


def q_csv_reference_load(spark: SparkSession, base: str) -> DataFrame:
    """Supplier catalogue written as ';' / decimal-comma text, read back typed."""
    supplier = read_table(spark, base, "supplier")
    path = scratch_path(spark, "supplier-csv")
    delimited.write_delimited(supplier, path)
    return delimited.read_delimited(spark, path, supplier.schema)


def q_stream_latest(spark: SparkSession, base: str) -> DataFrame:
    """Events arrive as files in time order, as many as the table is large; a stream appends them to a
    history table (one micro-batch per file); latest import per key is read from the history."""
    ev = _events(spark, base).select(*EVENT_COLUMNS)
    source = scratch_path(spark, "events-arrivals")
    ev.repartitionByRange("ts").write.parquet(source)
    sink, ckpt = scratch_path(spark, "events-history"), scratch_path(spark, "events-history-ckpt")
    query = history.start_history(history.file_stream(spark, source, ev.schema, max_files_per_trigger=1),
                                  sink, ckpt)
    query.awaitTermination()
    return latest.latest_per_key(spark.read.parquet(sink), ["user_id", "event_type"], ts="ts")


QUERIES.update({
    "key_check": q_key_check,
    "typed_cast": q_typed_cast,
    "date_format": q_date_format,
    "table_scan": q_table_scan,
    "table_overwrite": q_table_overwrite,
    "csv_reference_load": q_csv_reference_load,
    "stream_latest": q_stream_latest,
})


# --- the travel assembly end to end (capitals, monuments, hotel and flight histories) ----

from waymark.plans import trips  # noqa: E402
from waymark.plans.strategy import materialize  # noqa: E402
from waymark.streaming.pipeline import FLIGHT_REQUIRED, start_flight_stream  # noqa: E402

TRIP_START = "1996-03-01"
TRIP_DAYS = 4


def _travel_inputs(spark: SparkSession, base: str, start: str = TRIP_START,
                   days: int = TRIP_DAYS) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Catalogues and histories in the travel schemas, derived from the driver tables:
    capital = nation (id as text), monument = customer, hotel offer = line item at its
    supplier's nation, flight = order to its customer's nation.

    The look-ahead window is applied to the raw timestamps here (``date(ts)`` in
    the window is ``ts`` in the same whole days), so it reaches the parquet scans;
    a history stored partitioned by date gets the same from partition pruning."""
    nation, customer = read_table(spark, base, "nation"), read_table(spark, base, "customer")
    capitals = nation.select(F.col("n_name").alias("country"),
                             F.col("n_nationkey").cast("string").alias("capital"))
    monuments = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner").select(
        F.col("c_name").alias("name"), F.col("n_name").alias("country"),
        F.col("c_acctbal").alias("longitude"), F.col("c_nationkey").cast("double").alias("latitude"))
    li = latest.date_window(read_table(spark, base, "lineitem"), "l_shipdate", start, days)
    supplier = read_table(spark, base, "supplier")
    hotelday = li.join(supplier, li.l_suppkey == supplier.s_suppkey, "inner").select(
        F.to_date("l_shipdate").alias("checkin_date"), F.col("s_nationkey").cast("string").alias("city"),
        F.col("l_partkey").cast("string").alias("name"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("longitude"), F.col("l_tax").alias("latitude"),
        F.col("l_quantity").alias("rating"),
        F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate")).alias("import_date"),
        F.lit(None).cast("bigint").alias("rank"))  # not scored: slots go by price
    orders = latest.date_window(read_table(spark, base, "orders"), "o_orderdate", start, days)
    flight = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner").select(
        F.to_date("o_orderdate").alias("date"),
        F.format_string("%02d:%02d:00", F.pmod("o_orderkey", F.lit(24)),
                        F.pmod("o_custkey", F.lit(60))).alias("time"),
        (F.lit(60) + F.pmod("o_orderkey", F.lit(300))).cast("int").alias("duration"),
        F.col("o_orderpriority").alias("company"), F.col("o_totalprice").alias("price"),
        F.pmod("o_custkey", F.lit(3)).cast("int").alias("n_connections"),
        F.lit(ORIGIN_CITY).alias("origin"), F.col("c_nationkey").cast("string").alias("destination"),
        F.timestamp_add("HOUR", F.pmod("o_orderkey", F.lit(5)), F.col("o_orderdate")).alias("import_date"))
    flight = flights.arrival_time(flight, clock="time", duration="duration")
    return capitals, monuments, hotelday, flight


def q_trip_days(spark: SparkSession, base: str) -> DataFrame:
    """The travel assembly: per country and day, flight, hotel slots and monuments."""
    capitals, monuments, hotelday, flight = _travel_inputs(spark, base)
    hotelday, flight = materialize(hotelday, "hotelday")[0], materialize(flight, "flight")[0]
    return trips.trip_report_table(capitals, monuments, hotelday, flight, TRIP_START,
                                   n_days=TRIP_DAYS, home_country=HOME_NATION)


def q_trip_monument_lines(spark: SparkSession, base: str) -> DataFrame:
    """Each country's monuments numbered by name."""
    _, monuments, _, _ = _travel_inputs(spark, base)
    return trips.monument_lines(monuments)


QUERIES.update({
    "trip_days": q_trip_days,
    "trip_monument_lines": q_trip_monument_lines,
})


# --- the consumer path: records → decode → land → latest import → score → publish → trip ----

E2E_START = "1996-03-01"
E2E_DAYS = 62


def _season_day(number: str) -> Column:
    """One of the ``E2E_DAYS`` days from ``E2E_START`` on, by a number."""
    return F.date_add(F.to_date(F.lit(E2E_START)), F.pmod(number, F.lit(E2E_DAYS)).cast("int"))


def hotel_records(spark: SparkSession, base: str) -> DataFrame:
    """Hotel topic records: a line item is an offer of its supplier's nation for one of the season's days, by its
    part, imported at 08:00 or 09:00 that day by its line number; returned ones are priced in EUR."""
    li, supplier = read_table(spark, base, "lineitem"), read_table(spark, base, "supplier")
    day = _season_day("l_partkey")
    offers = li.join(supplier, li.l_suppkey == supplier.s_suppkey).select(
        F.col("s_nationkey").cast("string").alias("city_trans"), F.col("l_partkey").cast("string").alias("hotel_name"),
        F.col("l_extendedprice").alias("min_total_price"),
        F.when(F.col("l_returnflag") == "R", CURRENCY).otherwise("USD").alias("currencycode"),
        F.col("l_discount").alias("longitude"), F.col("l_tax").alias("latitude"),
        F.col("l_quantity").cast("double").alias("review_score"), day.alias("checkin_date"),
        F.timestamp_add("HOUR", (F.lit(8) + F.pmod("l_linenumber", F.lit(2))).cast("int"),
                        day.cast("timestamp")).alias("import_date"))
    return topics.encode_records(offers)


def flight_records(spark: SparkSession, base: str, monthly: bool = False) -> DataFrame:
    """Flight topic records: an order flies from the origin to its customer's nation on one of the season's days
    (``monthly``: on the first of its month), imported at one of five hours."""
    orders, customer = read_table(spark, base, "orders"), read_table(spark, base, "customer")
    day = F.trunc(F.to_date("o_orderdate"), "month") if monthly else _season_day("o_orderkey")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.format_string("%02d:%02d:00", F.pmod("o_orderkey", F.lit(24)), F.pmod("o_custkey", F.lit(60))).alias("time"),
        (F.lit(60) + F.pmod("o_orderkey", F.lit(300))).cast("int").alias("duration"),
        F.col("o_orderpriority").alias("company"), F.col("o_totalprice").alias("price"),
        F.pmod("o_custkey", F.lit(3)).cast("int").alias("n_connections"), day.alias("date"),
        F.timestamp_add("HOUR", F.pmod("o_orderkey", F.lit(5)).cast("int"), day.cast("timestamp")).alias("import_date"),
        F.lit(ORIGIN_CITY).alias("origin"), F.col("c_nationkey").cast("string").alias("destination"))
    return topics.encode_records(rows)


def q_trip_end_to_end(spark: SparkSession, base: str) -> DataFrame:
    """Both topics consumed, scored and landed, then the trips of two months: rank 1 is the first hotel."""
    nation = read_table(spark, base, "nation")
    capitals = nation.select(F.col("n_name").alias("country"), F.col("n_nationkey").cast("string").alias("capital"))
    customer = read_table(spark, base, "customer")
    monuments = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_name").alias("name"), F.col("n_name").alias("country"))
    hotelday = materialize(trips.best_of_latest(hotel_records(spark, base)), "hotelday")[0]
    flight = materialize(trips.flights_from_records(flight_records(spark, base)), "flight")[0]
    return trips.trip_report_table(capitals, monuments, hotelday, flight, E2E_START, n_days=E2E_DAYS,
                                   home_country=HOME_NATION)


def q_import_scores(spark: SparkSession, base: str) -> DataFrame:
    """Every import of a city and month scored on its own, as the consumer loop does batch by batch."""
    out = trips.hotels_from_records(hotel_records(spark, base))
    return out.select("checkin_date", "city", "name", "price", "rating", F.col("import_date").cast("timestamp_ntz")
                      .alias("import_date"), "rank")


def q_flight_stream(spark: SparkSession, base: str) -> DataFrame:
    """The flight topic consumed as a stream into a table partitioned by travel date (R2)."""
    source, sink, ckpt = (scratch_path(spark, f"flight-{x}") for x in ("records", "table", "table-ckpt"))
    flight_records(spark, base, monthly=True).write.parquet(source)
    start_flight_stream(history.file_stream(spark, source, "value string"), sink, ckpt).awaitTermination()
    return spark.read.parquet(sink).select(
        F.to_date("date").alias("date"), "time", "arrival_time", F.col("arrival_ts").cast("timestamp_ntz")
        .alias("arrival_ts"), "duration", "origin", "destination", "company", "price", "n_connections")


def _mixed_records(spark: SparkSession, base: str) -> DataFrame:
    """Flight records of which some are bad: error events are cut short, views name a price that is no
    number, clicks lack a duration, and purchases of user 0 have no value at all."""
    ev = _events(spark, base)
    body = F.struct(timefn.clock_of_ts("ts").alias("time"),
                    F.when(F.col("event_type") != "click", F.floor("value").cast("int")).alias("duration"),
                    F.lit("Air").alias("company"),
                    F.when(F.col("event_type") == "view", F.lit("cheap")).otherwise(F.col("value").cast("string"))
                    .alias("price"),
                    F.lit(0).alias("n_connections"), F.to_date("ts").alias("date"), F.col("ts").alias("import_date"),
                    F.lit(ORIGIN_CITY).alias("origin"), F.col("user_id").cast("string").alias("destination"))
    # numbers unquoted, as a producer writes them
    text = F.regexp_replace(F.to_json(body, topics.JSON_WRITE_OPTIONS), r'"price":"([0-9.E-]+)"', r'"price":$1')
    value = (F.when((F.col("event_type") == "purchase") & (F.col("user_id") == 0), F.lit(None))
             .when(F.col("event_type") == "error", F.expr("substring(text, 1, length(text) - 5)"))
             .otherwise(F.col("text")))
    return ev.withColumn("text", text).select(F.col("event_id").cast("string").alias("key"), value.alias("value"))


def q_record_rejects(spark: SparkSession, base: str) -> DataFrame:
    """What becomes of each record: the flight it gives, or why it is set aside."""
    good, bad = topics.split_records(_mixed_records(spark, base), schemas.FLIGHT_OFFER,
                                     required=FLIGHT_REQUIRED, keep=["key"])
    return good.select("key", F.lit("flight").alias("outcome")).unionByName(
        bad.select("key", F.col("reject_reason").alias("outcome")))


def q_typed_table(spark: SparkSession, base: str) -> DataFrame:
    """A table created with declared types, filled, read by its path after it is dropped (K4 K5)."""
    orders = read_table(spark, base, "orders")
    wanted = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DecimalType(18, 2)),
                           T.StructField("o_orderstatus", T.StringType())])
    path = scratch_path(spark, "typed-table")
    name = "typed_" + path.rsplit("-", 1)[-1]
    sinks.create_table(spark, name, wanted, path)
    sinks.conform(orders, wanted).write.insertInto(name)
    kind = spark.table(name).schema
    sinks.drop_tables(spark, [name])
    return spark.read.schema(kind).parquet(path).withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


QUERIES.update({
    "trip_end_to_end": q_trip_end_to_end,
    "import_scores": q_import_scores,
    "flight_stream": q_flight_stream,
    "record_rejects": q_record_rejects,
    "typed_table": q_typed_table,
})


# --- stored tables that are replaced, updated and kept current -------------------------------

from waymark.plans import histories  # noqa: E402
from waymark.sources import audit  # noqa: E402
from waymark.sources.versions import VersionedTable, upsert  # noqa: E402
from waymark.streaming import ledger  # noqa: E402


def q_table_replace(spark: SparkSession, base: str) -> DataFrame:
    """A stored table rewritten twice from itself, each time as a version swapped in whole (K2)."""
    table = VersionedTable(spark, scratch_path(spark, "orders-versions"))
    table.replace(read_table(spark, base, "orders"))
    table.replace(table.read().withColumn("o_orderstatus", F.lower("o_orderstatus")))
    table.replace(table.read().withColumn("o_totalprice", F.when(
        F.col("o_orderstatus") == "f", F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice"))))
    return table.read()


def q_table_upsert(spark: SparkSession, base: str) -> DataFrame:
    """Two batches enter a table with a primary key (K4): orders by (order, month), stored by month.

    The first brings the orders of 1995 again, each twice: the later import counts. The second brings new orders of
    three months, each row twice, of which those of every tenth customer have no key and stay out.
    """
    orders = read_table(spark, base, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("o_month"), "o_totalprice", "o_orderstatus",
        F.lit(0).cast("long").alias("imported"), "o_custkey")
    table = VersionedTable(spark, scratch_path(spark, "orders-keyed"), ["o_month"])
    table.replace(orders.drop("o_custkey").repartition("o_month"))
    again = orders.filter(F.col("o_month").startswith("1995")).drop("o_custkey").withColumn(
        "imported", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(2).cast("long"))))
    again = again.withColumn("o_totalprice", F.col("o_totalprice") * F.col("imported") * 2)
    upsert(table, again, ["o_orderkey", "o_month"], ["imported"])
    new = orders.filter(F.col("o_month").between("1996-01", "1996-03")).select(
        F.when(F.pmod("o_custkey", F.lit(10)) != 0, F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey"),
        "o_month", "o_totalprice", F.lit("N").alias("o_orderstatus"), F.lit(1).cast("long").alias("imported"))
    upsert(table, new.unionByName(new), ["o_orderkey", "o_month"], ["imported"])
    return table.read()


def q_latest_incremental(spark: SparkSession, base: str) -> DataFrame:
    """Each key's newest import, kept while three batches of events arrive, some rows late and one batch
    twice (J2 J3): every batch reads its own days only."""
    ev = _events(spark, base).select(*EVENT_COLUMNS).withColumn("day", F.to_date("ts"))
    third = F.least(F.lit(2), (F.dayofmonth("ts") - 1) / 10).cast("int")
    late = F.when(F.pmod("event_id", F.lit(7)) == 0, 1).otherwise(0)
    ev = materialize(ev.withColumn("arrival", F.least(F.lit(2), third + late)), "arrivals")[0]
    table = VersionedTable(spark, scratch_path(spark, "latest-events"), ["day"])
    for n in (0, 1, 1, 2):
        latest.merge_latest(table, ev.filter(F.col("arrival") == n).drop("arrival"),
                            ["day", "user_id", "event_type"], "ts", batch_id=str(n))
    return table.read()


def q_drifting_topic(spark: SparkSession, base: str) -> DataFrame:
    """Event records of three shapes, decoded into the union of their fields."""
    code = F.when(F.pmod("event_id", F.lit(2)) == 0, F.to_json(F.struct(F.col("user_id").alias("code"))))
    shapes = (F.when(F.col("event_type") == "click", F.to_json(F.struct(
                  F.col("event_id").alias("id"), F.col("value").alias("x"), F.lit(True).alias("seen"))))
              .when(F.col("event_type") == "view", F.coalesce(
                  F.regexp_replace(code, r"^\{", F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(","))),
                  F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("code")))))
              .otherwise(F.to_json(F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("x")))))
    records = _events(spark, base).select(shapes.alias("value"))
    return topics.drifting_records(records)[0]


QUERIES.update({
    "table_replace": q_table_replace,
    "table_upsert": q_table_upsert,
    "latest_incremental": q_latest_incremental,
    "drifting_topic": q_drifting_topic,
})


# --- streams that run again and again ----------------------------------------------------------


def lose_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Take back a stream's note that its last batch is done, as a crash right before that note would leave it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()]
    if done:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, str(max(done))), False)


def _event_arrivals(spark: SparkSession, base: str) -> DataFrame:
    """Events with real timestamps (streams need them) and ``arrival``: 0, 1 or 2 by the day of the month."""
    ev = history.ntz_to_timestamp(_events(spark, base).select(*EVENT_COLUMNS), ["ts"])
    return materialize(ev.withColumn("arrival", F.least(F.lit(2), F.floor((F.dayofmonth("ts") - 1) / 10)).cast("int")),
                       "arrivals")[0]


def q_stream_restart(spark: SparkSession, base: str) -> DataFrame:
    """A stream run three times on one checkpoint (R1): more arrives between the runs, and the second run's last
    batch is delivered again. The history has every row once."""
    ev = _event_arrivals(spark, base)
    source, sink, ckpt = (scratch_path(spark, f"restart-{x}") for x in ("source", "history", "ckpt"))
    stored = ev.drop("arrival").schema
    for n in (0, 1, None, 2):
        if n is None:
            lose_last_commit(spark, ckpt)
        else:
            ev.filter(F.col("arrival") == n).drop("arrival").write.mode("append").parquet(source)
        history.start_history(history.file_stream(spark, source, stored), sink, ckpt).awaitTermination()
    return spark.read.parquet(sink).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def q_stream_state(spark: SparkSession, base: str) -> DataFrame:
    """The latest event per day, user and type kept as stream state over three runs (R4): a day's rows come out
    once it is closed, and its state goes."""
    ev = _event_arrivals(spark, base)
    source, sink, ckpt = (scratch_path(spark, f"state-{x}") for x in ("source", "days", "ckpt"))
    stored = ev.drop("arrival").schema
    for n in range(3):
        ev.filter(F.col("arrival") == n).drop("arrival").write.mode("append").parquet(source)
        days = history.latest_per_day_state(history.file_stream(spark, source, stored), ["user_id", "event_type"], "ts")
        history.start_history(days, sink, ckpt).awaitTermination()
    return spark.read.parquet(sink).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def q_import_ledger(spark: SparkSession, base: str) -> DataFrame:
    """Hotel records land as a stream in two runs; after each, the imports that the ledger lacks are scored
    (R2 R3). Some imports get more offers in the second run and are scored again; a third step finds nothing open."""
    records = materialize(hotel_records(spark, base), "hotel-records")[0]
    source, raw, scored, ckpt = (scratch_path(spark, f"ledger-{x}") for x in ("records", "offers", "hotelday", "ckpt"))
    done = VersionedTable(spark, scratch_path(spark, "ledger-imports"))
    first = F.pmod(F.xxhash64("value"), F.lit(8)) < 4
    for part in (records.filter(first), records.filter(~first), None):
        if part is not None:
            part.write.mode("append").parquet(source)
        ledger.start_offer_landing(history.file_stream(spark, source, "value string"), raw, ckpt).awaitTermination()
        ledger.score_open_imports(spark, raw, scored, done)
    return spark.read.parquet(scored).select(
        "checkin_date", "city", "name", "price", "rating", F.col("import_date").cast("timestamp_ntz").alias("import_date"),
        "rank")


def q_load_audit(spark: SparkSession, base: str) -> DataFrame:
    """Records in, rows out and rejects, counted while they are written: a batch run and a stream run."""
    records = materialize(_mixed_records(spark, base), "mixed-records")[0]
    table = VersionedTable(spark, scratch_path(spark, "load-audit"))
    audit.audited_split(records, schemas.FLIGHT_OFFER, "batch", "flights", table, required=FLIGHT_REQUIRED)
    source, sink, ckpt = (scratch_path(spark, f"audit-{x}") for x in ("records", "outcomes", "ckpt"))
    records.write.parquet(source)
    outcomes = topics.record_outcomes(history.file_stream(spark, source, records.schema), schemas.FLIGHT_OFFER,
                                      required=FLIGHT_REQUIRED)
    query = history.start_history(audit.observed(outcomes), sink, ckpt)
    query.awaitTermination()
    audit.append_audit(spark, table, audit.stream_audit(query, "stream", "flights"))
    return table.read()


QUERIES.update({
    "stream_restart": q_stream_restart,
    "stream_state": q_stream_state,
    "import_ledger": q_import_ledger,
    "load_audit": q_load_audit,
})


# --- histories laid out for their joins --------------------------------------------------------

HISTORY_BUCKETS = 16


def q_window_of_plan(spark: SparkSession, base: str) -> DataFrame:
    """A date-partitioned history read only on the days that a request plan asks for."""
    path = scratch_path(spark, "events-by-day")
    ev = _events(spark, base).select(*EVENT_COLUMNS).withColumn("day", F.to_date("ts"))
    ev.repartition("day").write.partitionBy("day").parquet(path)
    nation = read_table(spark, base, "nation").select(F.col("n_name").alias("country"))
    plan = catalog.request_plan(nation, REF_DATE, 3, offset=1)
    return histories.window_of_plan(spark.read.parquet(path), plan, "day").select(*EVENT_COLUMNS, "day")


def _stored_offers(spark: SparkSession, base: str) -> tuple[DataFrame, bool]:
    return histories.store_history(lineitem_offers(spark, base), scratch_path(spark, "offers-by-city"),
                                   OFFER_KEYS, HISTORY_BUCKETS)


def q_score_in_place(spark: SparkSession, base: str) -> DataFrame:
    """Offers stored by (city, day) and scored where they lie: no exchange of the history."""
    offers, bucketed = _stored_offers(spark, base)
    args = {k: v for k, v in OFFER_ARGS.items() if k != "keys"}
    score = histories.score_in_place if bucketed else hotels.hotel_score
    return score(offers, OFFER_KEYS, **args).select(*SCORED_COLUMNS)


def q_latest_in_place(spark: SparkSession, base: str) -> DataFrame:
    """The latest import of every (city, day) of a history stored that way: no exchange of the history."""
    offers, bucketed = _stored_offers(spark, base)
    if bucketed:
        return histories.latest_in_place(offers, OFFER_KEYS, "l_shipdate")
    return latest.latest_per_key(offers, OFFER_KEYS, ts="l_shipdate")


QUERIES.update({
    "window_of_plan": q_window_of_plan,
    "score_in_place": q_score_in_place,
    "latest_in_place": q_latest_in_place,
})
