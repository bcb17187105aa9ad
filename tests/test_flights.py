import json

import pytest
from pyspark.sql import functions as F

from waymark.functions import timefn
from waymark.operators import flights
from waymark.sources import payloads

ARRIVALS = [  # departure, minutes, right answer, original rule
    ("10:30:00", 20, "10:50:00", "11:50:00"),
    ("10:10:00", 30, "10:40:00", "11:40:00"),
    ("10:00:00", 30, "10:30:00", "10:30:00"),
    ("10:30:00", 150, "13:00:00", "13:00:00"),
    ("23:50:00", 15, "00:05:00", "00:05:00"),
    ("23:00:00", 1500, "00:00:00", "00:00:00"),
    # worked out by hand: the carry hour comes when minute + 2 * (duration mod 60) is over 60
    ("00:00:00", 0, "00:00:00", "00:00:00"),
    ("07:01:00", 29, "07:30:00", "07:30:00"),   # 1 + 58 = 59
    ("07:01:00", 30, "07:31:00", "08:31:00"),   # 1 + 60 = 61
    ("10:00:00", 31, "10:31:00", "11:31:00"),   # 62
    ("13:59:00", 0, "13:59:00", "13:59:00"),    # 59
    ("13:59:00", 1, "14:00:00", "14:00:00"),    # 61
    ("10:31:00", 29, "11:00:00", "11:00:00"),   # 89
    ("23:30:00", 31, "00:01:00", "00:01:00"),   # 92
    ("23:59:00", 60, "00:59:00", "00:59:00"),   # 59
    ("07:30:00", 1441, "07:31:00", "07:31:00"),  # 32
]


def test_clocks_that_are_none(spark):
    """A missing or malformed part gives NULL, not a made-up time and not a failed job."""
    rows = [(None, 10, "2024-01-10"), ("n/a", 10, "2024-01-10"), ("10:30:00", None, "2024-01-10"),
            ("10:30:00", 10, None), ("10:30:00", 10, "2024-01-10")]
    df = spark.createDataFrame(rows, "time string, duration int, date string").withColumns(
        {"date": F.to_date("date"), "dep": timefn.departure_ts(F.to_date("date"), "time")})
    out = flights.arrival_time_compat(flights.arrival_time(df, departure_ts="dep")).collect()
    assert [r.arrival_time for r in out] == [None, None, None, "10:40:00", "10:40:00"]
    assert [r.arrival_time_compat for r in out] == [None, None, None, "10:40:00", "10:40:00"]
    assert [str(r.arrival_ts) for r in out] == ["None"] * 4 + ["2024-01-10 10:40:00"]


def test_arrival_times(spark):
    df = spark.createDataFrame([(d, m) for d, m, _, _ in ARRIVALS], "time string, duration int")
    out = flights.arrival_time_compat(flights.arrival_time(df), "time", "duration").collect()
    got = {(r.time, r.duration): (r.arrival_time, r.arrival_time_compat, r.duration_hours) for r in out}
    for d, m, right, compat in ARRIVALS:
        assert got[(d, m)][:2] == (right, compat)
        assert got[(d, m)][2] == pytest.approx(m / 60)


def test_arrival_ts(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-10 23:50:00' AS dep, '23:50:00' AS time, 15 AS duration")
    r = flights.arrival_time(df, departure_ts="dep").first()
    assert str(r.arrival_ts) == "2024-01-11 00:05:00" and r.arrival_time == "00:05:00"


def _leg(dep="2024-01-10T10:30:00", dur=95, stops=0, carrier="Air"):
    return {"departure": dep, "durationInMinutes": dur, "stopCount": stops,
            "carriers": {"marketing": [{"name": carrier}]}}


def _resp(*buckets):
    return json.dumps({"itineraries": {"buckets": list(buckets)}})


def _best(items):
    return {"id": "Best", "items": items}


ITEM = {"price": {"raw": 123.5}, "legs": [_leg()]}


def _responses(spark, payloads_):
    return spark.createDataFrame([(f"d{i}", p) for i, p in enumerate(payloads_)],
                                 "destination string, payload string")


def test_flight_payload_cases(spark):
    cases = [
        _resp(_best([ITEM])),                              # one row
        _resp(_best([])),                                  # reject: no items
        json.dumps({"message": "quota"}),                  # reject: no itineraries
        _resp({"id": "Cheapest", "items": [ITEM]}),        # nothing, not a reject
        "not json",                                        # reject: unparsable
    ]
    df = _responses(spark, cases)
    rows = payloads.parse_flight_payload(df).collect()
    assert [(r.destination, r.time, r.duration, r.company, r.price, r.n_connections) for r in rows] == \
        [("d0", "10:30:00", 95, "Air", 123.5, 0)]
    rej = {r.destination: r.reject_reason for r in payloads.flight_payload_rejects(df).collect()}
    assert rej == {"d1": "bucket without items", "d2": "missing itineraries", "d4": "unparsable payload"}


def test_flight_duplicate_best_deduped(spark):
    df = _responses(spark, [_resp(_best([ITEM]), _best([ITEM]))])
    assert payloads.parse_flight_payload(df).count() == 1
    assert payloads.parse_flight_payload(df, dedupe=False).count() == 2


def test_hotel_payload(spark):
    result = {"result": [
        {"city_trans": "Paris", "hotel_name": "A", "min_total_price": 700.0, "currencycode": "EUR",
         "longitude": 2.35, "latitude": 48.85, "review_score": 8.5},
        {"city_trans": "Paris", "hotel_name": "B", "min_total_price": 500.0, "currencycode": "EUR",
         "longitude": 2.3, "latitude": 48.8, "review_score": "NaN"},
    ]}
    df = spark.createDataFrame([("2024-01-10", json.dumps(result)), ("2024-01-11", "{}")],
                               "checkin_date string, payload string")
    rows = {r.hotel_name: r for r in payloads.parse_hotel_payload(df).collect()}
    assert set(rows) == {"A", "B"} and rows["A"].checkin_date == "2024-01-10"
    assert rows["B"].review_score is None  # NaN -> NULL (Q5)
    rej = payloads.hotel_payload_rejects(df).collect()
    assert [(r.checkin_date, r.reject_reason) for r in rej] == [("2024-01-11", "missing result")]


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "x")],
                               "k int, o int, v string")
    got = {r.k: r.v for r in flights.first_per_key(df, ["k"], ["o"]).collect()}
    assert got == {1: "a", 2: "x"}


def test_dedup(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "x int, y string")
    assert flights.flight_dedup(df).count() == 2
    assert flights.flight_dedup(df, ["y"]).count() == 1


def test_arrival_property(spark):
    """Arrival clock equals departure + duration modulo 24 h (checked against datetime)."""
    import datetime as dt
    import random
    rnd = random.Random(9)
    cases = [(f"{rnd.randint(0, 23):02}:{rnd.randint(0, 59):02}:{rnd.randint(0, 59):02}",
              rnd.randint(0, 5000)) for _ in range(500)]
    df = spark.createDataFrame(cases, "time string, duration int")
    for r in flights.arrival_time(df).collect():
        dep = dt.datetime.strptime("2024-01-01 " + r.time, "%Y-%m-%d %H:%M:%S").replace(second=0)
        assert r.arrival_time == (dep + dt.timedelta(minutes=r.duration)).strftime("%H:%M:00")


def test_first_per_key_settles_ties(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 3, "a"), (1, 3, "b")], "k int, o int, v string")
    for n in (1, 2, 3):
        assert [r.v for r in flights.first_per_key(df.repartition(n), ["k"], ["o"]).collect()] == ["a"]


def test_first_per_key_descending(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, None, "n"), (1, 2, "b"), (2, None, "x")],
                               "k int, o int, v string")
    got = {r.k: r.v for r in flights.first_per_key(df, ["k"], ["o"], descending=True).collect()}
    assert got == {1: "c", 2: "x"}


def test_hotel_pages_are_bounded(spark):
    rows = spark.createDataFrame([("Paris", "A", 10.0)] * 130, "city string, name string, p double")
    pages = payloads.hotel_payload_of(rows, ["city"], {"city_trans": "city", "hotel_name": "name",
                                                       "min_total_price": "p"}, page_size=50)
    sizes = sorted(len(json.loads(r.payload)["result"]) for r in pages.collect())
    assert sum(sizes) == 130 and max(sizes) <= 50
    assert payloads.parse_hotel_payload(pages).count() == 130


def test_plans_without_shuffle_or_sort_aggregate(spark):
    from conftest import plan_text
    df = _responses(spark, [_resp(_best([ITEM]), _best([ITEM]))])
    assert "Exchange" not in plan_text(payloads.parse_flight_payload(df))  # dedupe inside the response
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    text = plan_text(flights.first_per_key(ev, ["user_id"], ["ts", "event_id"]))
    assert "SortAggregate" not in text and "WindowGroupLimit" in text
