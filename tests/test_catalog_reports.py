import datetime as dt
import random

from pyspark.sql import functions as F

from waymark.operators import catalog, reports, sets

CAPITALS = [("Austria", "Vienna", "VIE", -1), ("France", "Paris", "CDG", -2),
            ("Italy", "Rome", "FCO", -3)]
CAP_COLS = "country string, capital string, airport_code string, dest_id_booking bigint"


def caps(spark):
    return spark.createDataFrame(CAPITALS, CAP_COLS)


def test_request_plan(spark):
    plan = catalog.request_plan(caps(spark), "2024-01-10", n_days=3, offset=1).collect()
    assert len(plan) == 9
    assert sorted({r.day for r in plan}) == [dt.date(2024, 1, d) for d in (11, 12, 13)]


def test_filter_by_country_precedence(spark):
    flights = spark.createDataFrame([("Paris", 1), ("Rome", 2)], "destination string, x int")
    monuments = spark.createDataFrame([("Eiffel", "France"), ("Colosseum", "Italy")],
                                      "name string, country string")
    hotels = spark.createDataFrame([("Paris", "H1"), ("Vienna", "H2")], "city string, name string")
    other = spark.createDataFrame([(1,)], "x int")
    c = caps(spark)
    assert [r.x for r in catalog.filter_by_country(flights, c, "France").collect()] == [1]
    assert [r.name for r in catalog.filter_by_country(monuments, c, "Italy").collect()] == ["Colosseum"]
    assert [r.name for r in catalog.filter_by_country(hotels, c, "Austria").collect()] == ["H2"]
    assert catalog.filter_by_country(other, c, "Austria").count() == 1


def test_filter_by_day_picks_column(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 10), 1), (dt.date(2024, 1, 11), 2)],
                               "checkin_date date, x int")
    assert [r.x for r in catalog.filter_by_day(df, "2024-01-11").collect()] == [2]


def test_catalog_options(spark):
    out = catalog.catalog_options(caps(spark), "country", "2024-01-11", n_days=4)
    assert out.count() == 12
    assert catalog.day_options(spark, "2024-01-11").count() == 4


def test_union_by_name_and_points(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.0)], "id int, b double")
    u = sets.union_by_name(a, b).collect()
    assert [(r.id, r.a, r.b) for r in u] == [(1, "x", None), (2, None, 3.0)]
    mon = spark.createDataFrame([("M", 16.37, 48.21), ("N", None, 1.0)], "name string, lon double, lat double")
    hot = spark.createDataFrame([("H", 16.3, 48.2)], "name string, longitude double, latitude double")
    pts = sets.map_points({"monument": (mon, "name", "lon", "lat"),
                           "hotel": (hot, "name", "longitude", "latitude")}).collect()
    assert sorted((p.name, p.layer) for p in pts) == [("H", "hotel"), ("M", "monument")]


def test_geo_midpoint(spark):
    df = spark.createDataFrame([("A", 10.0, 40.0), ("A", 20.0, 50.0), ("B", 1.0, 1.0)],
                               "country string, lon double, lat double")
    got = {r.country: (r.lon_mid, r.lat_mid) for r in reports.geo_midpoint(df, ["country"]).collect()}
    assert got == {"A": (15.0, 45.0), "B": (1.0, 1.0)}


def test_price_flags_rounded_and_raw(spark):
    df = spark.createDataFrame([(1, 100.004), (2, 50.0), (3, 70.0)], "id int, price double")
    rounded = {r.id: r.price_flag for r in reports.price_flags(df, "price").collect()}
    raw = {r.id: r.price_flag for r in reports.price_flags(df, "price", rounded=False).collect()}
    assert rounded == {1: "max", 2: "min", 3: "other"}
    assert raw == {1: "other", 2: "min", 3: "other"}  # Q17: unrounded max never flagged
    g = spark.createDataFrame([("P", 1.0), ("P", 2.0), ("R", 5.0)], "dest string, price double")
    flags = sorted((r.dest, r.price, r.price_flag) for r in reports.price_flags(g, "price", ["dest"]).collect())
    assert flags == [("P", 1.0, "min"), ("P", 2.0, "max"), ("R", 5.0, "max")]


def test_numbered_range_equals_window_on_skew(spark):
    rnd = random.Random(3)
    # one hot group with most rows, many small ones, duplicate names
    rows = [("hot", f"n{rnd.randint(0, 300):03d}", i) for i in range(3000)]
    rows += [(f"g{i % 40}", f"n{rnd.randint(0, 9)}", 10000 + i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, name string, id int")
    a = sorted(reports.numbered(df, ["g"], ["name", "id"], method="range", partitions=16).collect())
    b = sorted(reports.numbered(df, ["g"], ["name", "id"], method="window").collect())
    c = sorted(reports.numbered(df, ["g"], ["name", "id"], method="range").collect())
    spark.conf.set("waymark.skew.rowsPerTask", "500")
    try:  # auto picks the range path: the hot group has 3,000 rows
        d = sorted(reports.numbered(df, ["g"], ["name", "id"]).collect())
    finally:
        spark.conf.unset("waymark.skew.rowsPerTask")
    assert a == b == c == d
    hot = sorted(r.idx for r in a if r.g == "hot")
    assert hot == list(range(1, 3001))


def test_top_slots_and_trip(spark):
    hotels = spark.createDataFrame([("France", "A", 3.0), ("France", "B", 5.0),
                                    ("Italy", "C", 1.0)], "country string, name string, score double")
    slots = reports.top_slots(hotels, ["country"], "name", [F.col("score").desc()])
    plan = spark.createDataFrame([("Austria",), ("France",), ("Italy",), ("Spain",)], "country string")
    mons = spark.createDataFrame([("France", "1. Louvre")], "country string, monuments string")
    trips = {r.country: r for r in reports.trip_report(plan, ["country"], "country", "Austria",
                                                       hotels=slots, monuments=mons).collect()}
    assert trips["Austria"].flight == reports.NO_FLIGHT_NEEDED
    assert trips["Spain"].flight == reports.NO_FLIGHTS and trips["Spain"].hotel_1 == reports.NO_HOTELS
    assert (trips["France"].hotel_1, trips["France"].hotel_2, trips["France"].hotel_3) == ("B", "A", None)
    assert trips["Italy"].monuments == reports.NO_MONUMENTS


def test_country_aliases_opt_in(spark):
    from waymark.constants import COUNTRY_ALIASES
    c = spark.createDataFrame([("United Kingdom", "London", "LHR", -9)], CAP_COLS)
    mon = spark.createDataFrame([("Stonehenge", "England"), ("Castle", "Scotland"), ("X", "France")],
                                "name string, country string")
    assert catalog.filter_by_country(mon, c, "United Kingdom").count() == 0
    got = catalog.filter_by_country(mon, c, "United Kingdom", aliases=COUNTRY_ALIASES)
    assert sorted(r.name for r in got.collect()) == ["Castle", "Stonehenge"]


def test_price_flags_salted_path_same(spark):
    rows = [("Hot", float(i % 97)) for i in range(500)] + [(f"D{i % 7}", float(i)) for i in range(70)]
    df = spark.createDataFrame(rows, "dest string, price double")
    a = sorted(reports.price_flags(df, "price", ["dest"]).collect())
    spark.conf.set("waymark.broadcast.maxBytes", "1")
    spark.conf.set("waymark.skew.rowsPerTask", "50")
    try:
        b = sorted(reports.price_flags(df, "price", ["dest"]).collect())
    finally:
        spark.conf.unset("waymark.broadcast.maxBytes")
        spark.conf.unset("waymark.skew.rowsPerTask")
    assert a == b and len(a) == 570
