import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from waymark.operators import hotels
from waymark.plans.strategy import bounded_broadcast

from conftest import plan_text

COLS = "city_trans string, hotel_name string, price_per_day double, currencycode string, " \
       "longitude double, latitude double, review_score double, checkin_date date, " \
       "import_date timestamp"
DAY = dt.date(2024, 1, 10)
T0 = dt.datetime(2024, 1, 9, 8, 0)


def offers(spark, rows):
    return spark.createDataFrame(
        [(c, h, p, cur, 16.3, 48.2, r, DAY, T0) for c, h, p, cur, r in rows], COLS)


GOLDEN = [("Paris", "A", 100.0, "EUR", 8.0), ("Paris", "B", 50.0, "EUR", 6.0),
          ("Paris", "C", 75.0, "EUR", 9.0), ("Paris", "D", 60.0, "EUR", 9.0)]


def top(spark, rows, **kw):
    out = hotels.hotel_top3(offers(spark, rows), **kw).collect()
    return {r.hotel_name: r for r in out}


def test_golden_scores(spark):
    scored = {r.hotel_name: r for r in hotels.hotel_score(offers(spark, GOLDEN)).collect()}
    expect = {"D": (56, 30, 86), "B": (70, 0, 70), "C": (35, 30, 65), "A": (0, 20, 20)}
    for h, (pp, rp, tot) in expect.items():
        assert scored[h].price_points == pytest.approx(pp)
        assert scored[h].review_points == pytest.approx(rp)
        assert scored[h].total_points == pytest.approx(tot)
    t = top(spark, GOLDEN)
    assert {h: r["rank"] for h, r in t.items()} == {"D": 1, "B": 2, "C": 3}


def test_other_currency_ignored(spark):
    assert set(top(spark, GOLDEN + [("Paris", "X", 1.0, "USD", 10.0)])) == {"D", "B", "C"}


def test_single_hotel_kept_with_null_score(spark):
    t = top(spark, [("Rome", "S", 80.0, "EUR", 7.0)])
    assert t["S"]["rank"] == 1 and t["S"].total_points is None and t["S"].price_points is None


def test_equal_reviews_all_null_all_returned(spark):
    rows = [("Oslo", f"H{i}", 50.0 + i, "EUR", 8.0) for i in range(5)]
    t = top(spark, rows)
    assert len(t) == 5 and all(r["rank"] == 1 and r.total_points is None for r in t.values())


def test_tie_at_third_keeps_four(spark):
    # totals 86, 70, 65, 65
    rows = GOLDEN[1:] + [("Paris", "E", 75.0, "EUR", 9.0)] + [GOLDEN[0]]
    t = top(spark, rows)
    assert sorted(r["rank"] for r in t.values()) == [1, 2, 3, 3]


def test_tie_at_first(spark):
    # totals 86, 86, 70, 65 (A dropped by rank 4) -> ranks 1, 1, 3
    rows = GOLDEN + [("Paris", "E", 60.0, "EUR", 9.0)]
    t = top(spark, rows)
    assert sorted(r["rank"] for r in t.values()) == [1, 1, 3]


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_missing_review_only_that_row_null(spark, missing):
    rows = GOLDEN + [("Paris", "M", 55.0, "EUR", missing)]
    scored = {r.hotel_name: r for r in hotels.hotel_score(offers(spark, rows)).collect()}
    assert scored["M"].total_points is None
    assert all(r.total_points is not None and not math.isnan(r.total_points)
               for h, r in scored.items() if h != "M")
    # 4 scored rows >= k, so the unrated one (rank 5) is not kept
    assert "M" not in top(spark, rows)


def test_unrated_row_ranked_last_when_room(spark):
    rows = [("Bern", "X", 50.0, "EUR", 8.0), ("Bern", "Y", 60.0, "EUR", 9.0),
            ("Bern", "Z", 70.0, "EUR", None)]
    t = top(spark, rows)
    assert t["Z"]["rank"] == 3 and {t["X"]["rank"], t["Y"]["rank"]} <= {1, 2}


def test_null_city_dropped(spark):
    assert "N" not in top(spark, GOLDEN + [(None, "N", 10.0, "EUR", 9.0)])


def test_per_import_key(spark):
    later = dt.datetime(2024, 1, 9, 9, 0)
    df = offers(spark, GOLDEN).union(
        offers(spark, GOLDEN).withColumn("import_date", F.lit(later)))
    # Q6: without the import time in the key both imports compete for the same 3 slots
    assert len(hotels.hotel_top3(df).collect()) == 4
    assert len(hotels.hotel_top3(df, per_import="import_date").collect()) == 6


def test_broadcast_and_shuffle_paths_agree(spark):
    df = offers(spark, GOLDEN + [("Rome", f"R{i}", 40.0 + i, "EUR", float(i % 4)) for i in range(20)])
    a = sorted(hotels.hotel_top3(df).collect())
    b = sorted(hotels.hotel_top3(df, broadcast_max_bytes=0).collect())
    assert a == b


def test_bounded_broadcast_refuses_large(spark):
    df = spark.range(1000)
    _, fits = bounded_broadcast(df, max_bytes=1000)
    assert not fits
    _, fits = bounded_broadcast(df, max_bytes=10_000_000)
    assert fits


def test_rank_property(spark):
    """rank <= k  <=>  fewer than k strictly better scores in the group."""
    import random
    rnd = random.Random(7)
    rows = [(f"C{rnd.randint(0, 4)}", f"H{i}", float(rnd.randint(40, 60)), "EUR",
             float(rnd.randint(5, 9))) for i in range(300)]
    scored = hotels.hotel_score(offers(spark, rows)).collect()
    kept = {r.hotel_name for r in hotels.hotel_top3(offers(spark, rows)).collect()}
    for r in scored:
        group = [s for s in scored if s.city_trans == r.city_trans]
        if r.total_points is None:
            better = sum(1 for s in group if s.total_points is not None)
        else:
            better = sum(1 for s in group if s.total_points is not None and s.total_points > r.total_points)
        assert (better < 3) == (r.hotel_name in kept)


def test_plan_shapes(spark):
    """No hot group: one window limited before its exchange. Hot group: the result is a scan
    of the written candidates joined with the broadcast score levels."""
    df = hotels.hotel_top3(offers(spark, GOLDEN))
    text = plan_text(df)
    assert "WindowGroupLimit" in text and "BroadcastHashJoin" in text
    assert "PythonUDF" not in text and "BatchEvalPython" not in text
    spark.conf.set("waymark.skew.rowsPerTask", "2")
    try:
        text = plan_text(hotels.hotel_top3(offers(spark, GOLDEN)))
    finally:
        spark.conf.unset("waymark.skew.rowsPerTask")
    # candidates and score levels were written: what is left is their join, without a window
    assert "BroadcastHashJoin" in text and "Window" not in text


def test_copies_do_not_meet_in_one_task(spark):
    """A third of a hot group is one offer copied: the copies stay in their input pieces."""
    rows = [("Hot", "copy", 40.0, "EUR", 9.0)] * 400 + \
           [("Hot", f"o{i}", 50.0 + i % 30, "EUR", float(i % 9)) for i in range(800)]
    df = offers(spark, rows).repartition(8)
    spark.conf.set("waymark.skew.rowsPerTask", "100")
    try:
        top = hotels.hotel_top3(df).collect()
    finally:
        spark.conf.unset("waymark.skew.rowsPerTask")
    assert len(top) == 400 and {r.hotel_name for r in top} == {"copy"}
    assert {r["rank"] for r in top} == {1}


def test_publish_renames(spark):
    out = hotels.hotelday_publish(hotels.hotel_top3(offers(spark, GOLDEN)))
    assert out.columns == ["checkin_date", "city", "name", "price", "longitude", "latitude",
                           "rating", "import_date", "rank"]
    assert out.count() == 3


def test_salted_path_on_hot_group(spark):
    """Range table over budget + a hot group: salted join and two-stage rank give the same rows."""
    import random
    rnd = random.Random(11)
    rows = [("Hot", f"h{i}", float(rnd.randint(40, 90)), "EUR", float(rnd.randint(1, 9)))
            for i in range(600)]
    rows += [(f"C{i % 9}", f"c{i}", float(rnd.randint(40, 90)), "EUR", float(rnd.randint(1, 9)))
             for i in range(90)]
    rows += [("Flat", f"f{i}", 50.0 + i, "EUR", 7.0) for i in range(30)]  # all-NULL scores
    df = offers(spark, rows)
    expect = sorted(hotels.hotel_top3(df).collect())
    spark.conf.set("waymark.skew.rowsPerTask", "50")
    try:
        scored = hotels.hotel_score(df, broadcast_max_bytes=0)
        assert scored.columns == hotels.hotel_score(df).columns  # the same on every path
        got = sorted(hotels.hotel_top_k(scored).collect())
    finally:
        spark.conf.unset("waymark.skew.rowsPerTask")
    assert got == expect
    assert sum(1 for r in got if r.city_trans == "Flat") == 30


def test_score_properties(spark):
    """Scores lie in [0, 100]; with a positive price range the cheapest offers get 70 price points."""
    import random
    rnd = random.Random(5)
    rows = [(f"C{rnd.randint(0, 6)}", f"H{i}", float(rnd.randint(30, 200)), "EUR",
             float(rnd.randint(1, 10))) for i in range(400)]
    scored = hotels.hotel_score(offers(spark, rows)).collect()
    for r in scored:
        if r.total_points is not None:
            assert -1e-9 <= r.total_points <= 100 + 1e-9
        if r.price_points is not None and r.price_per_day == r.min_price:
            assert r.price_points == pytest.approx(70)
    by_city = {}
    for r in scored:
        by_city.setdefault(r.city_trans, []).append(r)
    for group in by_city.values():
        if group[0].diff_price:
            assert {r.price_per_day for r in group if r.price_points == pytest.approx(70)} == {group[0].min_price}
