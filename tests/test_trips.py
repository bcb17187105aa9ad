import datetime as dt
import json

from waymark import schemas
from waymark.operators import reports
from waymark.plans import trips

D0 = dt.date(2024, 1, 10)


def test_trip_tables(spark):
    capitals = spark.createDataFrame(
        [("Austria", "Vienna", "VIE", -1), ("France", "Paris", "CDG", -2), ("Spain", "Madrid", "MAD", -3)],
        schemas.CAPITAL)
    monuments = spark.createDataFrame(
        [("Louvre", "France", 2.33, 48.86), ("Eiffel", "France", 2.29, 48.85),
         ("Stephansdom", "Austria", 16.37, 48.21)], schemas.MONUMENT)
    imp1, imp2 = dt.datetime(2024, 1, 9, 8), dt.datetime(2024, 1, 9, 9)
    hotelday = spark.createDataFrame(
        [(D0, "Paris", "Old", 10.0, 2.3, 48.8, 5.0, imp1, 1),       # older import: ignored
         (D0, "Paris", "B", 90.0, 2.3, 48.8, 8.0, imp2, 1),
         (D0, "Paris", "A", 80.0, 2.3, 48.8, None, imp2, 2),
         (D0, "Paris", "A", 80.0, 2.3, 48.8, None, imp2, 2),      # landed twice: one slot
         (dt.date(2024, 1, 20), "Paris", "Late", 1.0, 2.3, 48.8, 9.0, imp2, 1)],  # outside window
        schemas.HOTELDAY)
    flight = spark.createDataFrame(
        [(D0, "10:30:00", "12:35:00", None, 125, "Vienna", "Paris", "AirX", 199.0, 0, imp2),
         (D0, "07:00:00", "09:00:00", None, 120, "Vienna", "Paris", "AirY", 149.0, 1, imp2),
         (D0, "06:00:00", "08:00:00", None, 120, "Vienna", "Paris", "AirZ", 99.0, 0, imp1)],
        schemas.FLIGHT)
    t, lines = trips.trip_tables(capitals, monuments, hotelday, flight, D0, n_days=2)
    rows = {(r.country, r.day): r for r in t.collect()}
    assert len(rows) == 6
    paris = rows[("France", D0)]
    assert paris.flight == "149.00 EUR with AirY, Vienna to Paris, leaves 07:00:00, lands 09:00:00, stops: 1"
    assert paris.hotel_1 == "90.00 a night: B (8.0)"  # the best, not the cheapest
    assert paris.hotel_2 == "80.00 a night: A" and paris.hotel_3 is None
    assert paris.monuments == "2 monuments"
    assert rows[("Austria", D0)].flight == reports.NO_FLIGHT_NEEDED
    spain = rows[("Spain", D0)]
    assert (spain.flight, spain.hotel_1, spain.monuments) == (
        reports.NO_FLIGHTS, reports.NO_HOTELS, reports.NO_MONUMENTS)
    assert rows[("France", dt.date(2024, 1, 11))].hotel_1 == reports.NO_HOTELS
    assert sorted((r.country, r.line, r.name) for r in lines.collect()) == [
        ("Austria", 1, "Stephansdom"), ("France", 1, "Eiffel"), ("France", 2, "Louvre")]


def test_records_to_tables(spark):
    hotel = [{"city_trans": "Paris", "hotel_name": h, "min_total_price": p * 7, "currencycode": "EUR",
              "longitude": 2.3, "latitude": 48.8, "review_score": r, "checkin_date": "2024-01-10",
              "import_date": "2024-01-09T08:00:00"}
             for h, p, r in (("A", 100, 8), ("B", 50, 6), ("C", 75, 9), ("D", 60, 9))]
    recs = spark.createDataFrame([(json.dumps(x),) for x in hotel], "value string")
    out = trips.hotels_from_records(recs)
    assert out.columns == schemas.HOTELDAY.fieldNames()
    assert sorted(r.name for r in out.collect()) == ["B", "C", "D"]
    fl = {"time": "23:50:00", "duration": 15, "company": "Air", "price": 99.0, "n_connections": 0,
          "date": "2024-01-10", "import_date": "2024-01-09T08:00:00", "origin": "Vienna",
          "destination": "Paris"}
    f = trips.flights_from_records(spark.createDataFrame([(json.dumps(fl),)], "value string")).first()
    assert f.arrival_time == "00:05:00" and f.arrival_ts == dt.datetime(2024, 1, 11, 0, 5)


def test_trip_monuments_with_aliases(spark):
    from waymark.constants import COUNTRY_ALIASES
    capitals = spark.createDataFrame([("United Kingdom", "London", "LHR", -9)], schemas.CAPITAL)
    monuments = spark.createDataFrame([("Stonehenge", "England", -1.83, 51.18),
                                       ("Castle", "Scotland", -3.2, 55.95)], schemas.MONUMENT)
    empty_h = spark.createDataFrame([], schemas.HOTELDAY)
    empty_f = spark.createDataFrame([], schemas.FLIGHT)
    t, lines = trips.trip_tables(capitals, monuments, empty_h, empty_f, D0, n_days=1)
    assert t.first().monuments == reports.NO_MONUMENTS
    t, lines = trips.trip_tables(capitals, monuments, empty_h, empty_f, D0, n_days=1,
                                 aliases=COUNTRY_ALIASES)
    assert t.first().monuments == "2 monuments"
    assert sorted((r.country, r.line) for r in lines.collect()) == [("United Kingdom", 1), ("United Kingdom", 2)]


def test_readme_flow(spark):
    """The README's flow, with record frames standing in for the two topics."""
    import os
    from waymark.session import scratch_path
    from waymark.sources import delimited, sinks
    root = scratch_path(spark, "flow")
    os.makedirs(f"{root}/cap")
    os.makedirs(f"{root}/mon")
    with open(f"{root}/cap/c.csv", "w", encoding="utf-8") as fh:
        fh.write("﻿country;capital;airport_code;dest_id_booking\r\nFrance;Paris;CDG;-2\r\n")
    with open(f"{root}/mon/m.csv", "w", encoding="utf-8") as fh:
        fh.write("﻿ID;name;Region;country;Geographic Area;Continent;latitude;longitude;"
                 "Latitude 2;Longitude 2;Latitude 3;Longitude 3\r\n"
                 "1;Louvre;Paris;France;West Europe;Europe;48,86;2,33;;;;\r\n")
    capitals = delimited.read_capitals(spark, f"{root}/cap")
    monuments = delimited.read_monuments(spark, f"{root}/mon")
    hotel = [{"city_trans": "Paris", "hotel_name": h, "min_total_price": p * 7, "currencycode": "EUR",
              "longitude": 2.3, "latitude": 48.8, "review_score": r, "checkin_date": "2024-01-11",
              "import_date": "2024-01-10T08:00:00"} for h, p, r in (("A", 100, 8), ("B", 50, 6))]
    fl = {"time": "10:30:00", "duration": 95, "company": "Air", "price": 99.0, "n_connections": 0,
          "date": "2024-01-11", "import_date": "2024-01-10T08:00:00", "origin": "Vienna",
          "destination": "Paris"}
    hotel_rec = spark.createDataFrame([(json.dumps(x),) for x in hotel], "value string")
    flight_rec = spark.createDataFrame([(json.dumps(fl),)], "value string")
    sinks.append_table(trips.hotels_from_records(hotel_rec), f"{root}/hotelday", ["checkin_date"])
    sinks.append_table(trips.flights_from_records(flight_rec), f"{root}/flight", ["date"])
    report = trips.trip_report_table(capitals, monuments, spark.read.parquet(f"{root}/hotelday"),
                                     spark.read.parquet(f"{root}/flight"), start="2024-01-11", n_days=2)
    rows = {r.day: r for r in report.collect()}
    first = rows[dt.date(2024, 1, 11)]
    assert first.flight == "99.00 EUR with Air, Vienna to Paris, leaves 10:30:00, lands 12:05:00, stops: 0"
    assert first.hotel_1 == "50.00 a night: B (6.0)" and first.hotel_2 == "100.00 a night: A (8.0)"
    assert first.monuments == "1 monuments"
    assert rows[dt.date(2024, 1, 12)].hotel_1 == reports.NO_HOTELS


def _hotel(name, price, rating, hour, **more):
    return {"city_trans": "Paris", "hotel_name": name, "min_total_price": price * 7, "currencycode": "EUR",
            "longitude": 2.3, "latitude": 48.8, "review_score": rating, "checkin_date": "2024-01-10",
            "import_date": f"2024-01-09T{hour:02}:00:00"} | more


def _records(spark, rows):
    return spark.createDataFrame([(x if x is None or isinstance(x, str) else json.dumps(x),) for x in rows], "value string")


def test_new_import_is_not_crowded_out(spark):
    """Cheap hotels of an older import do not take the places of the newest one's."""
    rows = [_hotel(f"old{i}", 10 + i, 9, 8) for i in range(3)] + [_hotel(f"new{i}", 90 + i, 5 + i, 9) for i in range(3)]
    assert sorted(r.name for r in trips.best_of_latest(_records(spark, rows)).collect()) == ["new0", "new1", "new2"]
    per_import = trips.hotels_from_records(_records(spark, rows)).collect()
    assert len(per_import) == 6
    hotelday = spark.createDataFrame(per_import, schemas.HOTELDAY)
    now = trips.current_hotels(hotelday, D0, 1).collect()
    assert sorted(r.name for r in now) == ["new0", "new1", "new2"] and sorted(r["rank"] for r in now) == [1, 2, 3]


def test_rerun_and_score_order(spark):
    """Landing the same batch twice changes nothing, and slots follow the score."""
    from waymark.session import scratch_path
    from waymark.sources import sinks
    from pyspark.sql import functions as F
    rows = [_hotel("fine", 101, 10, 8), _hotel("poor", 100, 1, 8), _hotel("dear", 150, 5, 8)]
    path = scratch_path(spark, "rerun")
    for _ in range(2):
        out = trips.hotels_from_records(_records(spark, rows)).withColumn("batch", F.lit("08h"))
        sinks.overwrite_partitions(out, path, ["checkin_date", "batch"])
    sinks.append_table(out, path, ["checkin_date", "batch"])  # even rows that stand there twice
    capitals = spark.createDataFrame([("France", "Paris", "CDG", -2)], schemas.CAPITAL)
    empty = spark.createDataFrame([], schemas.FLIGHT)
    t = trips.trip_report_table(capitals, spark.createDataFrame([], schemas.MONUMENT), spark.read.parquet(path), empty,
                                D0, n_days=1).first()
    assert [t.hotel_1, t.hotel_2, t.hotel_3] == ["101.00 a night: fine (10.0)", "100.00 a night: poor (1.0)",
                                                 "150.00 a night: dear (5.0)"]


def test_bad_records_are_set_aside(spark):
    """Every record is an offer or a reject; a bad one neither vanishes nor is published."""
    from waymark.streaming.pipeline import split_flights, split_hotels
    rows = [_hotel("ok", 10, 5, 8), "not json", None, _hotel("p", 10, 5, 8, min_total_price="abc"),
            _hotel("q", 10, 5, 8, checkin_date=None), _hotel("r", 10, None, 8)]
    good, bad = split_hotels(_records(spark, rows))
    assert sorted(r.hotel_name for r in good.collect()) == ["ok", "r"]
    assert sorted(r.reject_reason for r in bad.collect()) == ["missing checkin_date", "no value", "undecodable", "undecodable"]
    fl = {"time": "n/a", "duration": 15, "company": "Air", "price": 99.0, "n_connections": 0, "date": "2024-01-10",
          "import_date": "2024-01-09T08:00:00", "origin": "Vienna", "destination": "Paris"}
    good, bad = split_flights(_records(spark, [fl, fl | {"date": None}, "{"]))
    assert [(r.arrival_time, r.arrival_ts) for r in good.collect()] == [(None, None)]
    assert sorted(r.reject_reason for r in bad.collect()) == ["missing date", "undecodable"]


def test_later_import_of_another_currency_hides_nothing(spark):
    """The newest import is the newest with a published offer."""
    rows = [_hotel("a", 10, 9, 8), _hotel("b", 20, 5, 8), _hotel("dollar", 5, 9, 9, currencycode="USD")]
    assert sorted(r.name for r in trips.best_of_latest(_records(spark, rows)).collect()) == ["a", "b"]
    rows.append(_hotel("late", 30, 5, 9))
    assert sorted(r.name for r in trips.best_of_latest(_records(spark, rows)).collect()) == ["late"]


def test_records_are_parsed_once_per_branch(spark):
    """Neither the reject test nor the columns read from a record parse its text again."""
    from waymark.sources.topics import decode_records
    from waymark.streaming.pipeline import split_flights, split_hotels
    records = _records(spark, [_hotel("a", 10, 9, 8)])
    for split in (split_hotels, split_flights):
        for branch in split(records):
            assert branch._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    late = decode_records(records, schemas.HOTEL_OFFER).filter("hotel_name = 'a' AND min_total_price > 1")
    assert late._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1 and late.count() == 1
