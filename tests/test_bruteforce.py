"""Spark results against a plain-Python brute force on random fixtures."""
import datetime as dt
import math
import random

import pytest

from waymark.operators import hotels, latest

COLS = "city_trans string, hotel_name string, price_per_day double, currencycode string, " \
       "review_score double, checkin_date date"
DAYS = [dt.date(2024, 1, 10), dt.date(2024, 1, 11)]


def random_offers(seed, n=300):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        review = rnd.choice([None, float("nan")] + [float(x) for x in range(5, 10)] * 4)
        price = rnd.choice([None] + [float(x) for x in range(40, 60, 5)] * 5)
        rows.append((rnd.choice(["A", "B", "C", "D", None]), f"h{i}", price,
                     rnd.choice(["EUR"] * 5 + ["USD"]), review, rnd.choice(DAYS)))
    # a group where every review is equal (all scores NULL) and a single-offer group
    rows += [("Flat", f"f{i}", 40.0 + i, "EUR", 7.0, DAYS[0]) for i in range(6)]
    rows += [("Solo", "s0", 50.0, "EUR", 8.0, DAYS[0])]
    return rows


def brute_top3(rows, k=3):
    def clean(x):
        return None if x is None or (isinstance(x, float) and math.isnan(x)) else x
    groups = {}
    for city, name, price, cur, review, day in rows:
        if cur != "EUR" or city is None:
            continue
        groups.setdefault((city, day), []).append((name, clean(price), clean(review)))
    out = {}
    for key, offers in groups.items():
        ps = [p for _, p, _ in offers if p is not None]
        rs = [r for _, _, r in offers if r is not None]
        dp = (max(ps) - min(ps)) if ps else None
        dr = (max(rs) - min(rs)) if rs else None
        scored = []
        for name, p, r in offers:
            pp = 70 - (p - min(ps)) * 70 / dp if p is not None and dp else None
            rp = (r - min(rs)) * 30 / dr if r is not None and dr else None
            scored.append((name, pp + rp if pp is not None and rp is not None else None))
        for name, total in scored:
            if total is None:
                rank = 1 + sum(1 for _, t in scored if t is not None)
            else:
                rank = 1 + sum(1 for _, t in scored if t is not None and t > total)
            if rank <= k:
                out[name] = rank
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_top3_matches_brute_force(spark, seed):
    rows = random_offers(seed)
    df = spark.createDataFrame(rows, COLS)
    expect = brute_top3(rows)
    got = {r.hotel_name: r["rank"] for r in hotels.hotel_top3(df).collect()}
    assert got == expect
    spark.conf.set("waymark.skew.rowsPerTask", "20")
    try:  # hot-group path, broadcast and salted
        levels = {r.hotel_name: r["rank"] for r in hotels.hotel_top3(df).collect()}
        salted = {r.hotel_name: r["rank"] for r in hotels.hotel_top3(df, broadcast_max_bytes=0).collect()}
        unknown = {r.hotel_name: r["rank"] for r in hotels.hotel_top_k(hotels.hotel_score(df)).collect()}
    finally:
        spark.conf.unset("waymark.skew.rowsPerTask")
    assert levels == expect and salted == expect and unknown == expect


def test_latest_matches_brute_force(spark):
    rnd = random.Random(4)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice(["x", "y", None]), rnd.randint(0, 3),
             rnd.choice([None] + [base + dt.timedelta(hours=h) for h in range(5)]), i)
            for i in range(200)]
    df = spark.createDataFrame(rows, "k string, j int, ts timestamp, id int")
    last = {}
    for k, j, ts, _ in rows:
        if k is not None and ts is not None:
            last[(k, j)] = max(last.get((k, j), ts), ts)
    expect = sorted(i for k, j, ts, i in rows if k is not None and ts is not None and ts == last[(k, j)])
    for method in ("join", "window"):
        got = sorted(r.id for r in latest.latest_per_key(df, ["k", "j"], ts="ts", method=method).collect())
        assert got == expect


def test_first_per_key_matches_brute_force(spark):
    from waymark.operators import flights
    rnd = random.Random(8)
    rows = [(rnd.choice(["x", "y", "z", None]), rnd.choice([None, 1.0, 2.0, 3.0]),
             rnd.choice([None, "a", "b"]), i) for i in range(300)]
    rows += [("allnull", None, None, 1000), ("allnull", None, "c", 1001)]
    df = spark.createDataFrame(rows, "k string, p double, t string, id int")

    def key(v):  # ascending, NULLs last
        return (v is None, v)
    expect = {}
    for k, p, t, i in rows:
        cur = expect.get(k)
        cand = (key(p), key(t), key(i))
        if cur is None or cand < cur[0]:
            expect[k] = (cand, i)
    got = {r.k: r.id for r in flights.first_per_key(df, ["k"], ["p", "t", "id"]).collect()}
    assert got == {k: v[1] for k, v in expect.items()}
    spread = flights.first_per_key(df.repartition(5), ["k"], ["p", "t", "id"])
    assert {r.k: r.id for r in spread.collect()} == got


def test_empty_inputs(spark):
    from waymark.operators import flights, reports
    empty = spark.createDataFrame([], COLS)
    assert hotels.hotel_top3(empty).count() == 0
    assert hotels.hotel_top3(empty, broadcast_max_bytes=0).count() == 0
    ev = spark.createDataFrame([], "k string, ts timestamp, v int")
    assert latest.latest_per_key(ev, ["k"], ts="ts").count() == 0
    assert flights.first_per_key(ev, ["k"], ["ts"]).count() == 0
    assert reports.numbered(ev, ["k"], ["ts"]).count() == 0
    assert reports.numbered(ev, ["k"], ["ts"], method="range").count() == 0
    assert reports.price_flags(ev.withColumn("p", ev.v * 1.0), "p", ["k"]).count() == 0
