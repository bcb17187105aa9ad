import datetime as dt

from waymark.operators import latest

COLS = "origin string, destination string, date date, import_date timestamp, price double"
D = dt.date(2024, 1, 10)


def frame(spark):
    rows = [
        ("Vienna", "Paris", D, dt.datetime(2024, 1, 9, 8), 100.0),
        ("Vienna", "Paris", D, dt.datetime(2024, 1, 9, 9), 110.0),
        ("Vienna", "Paris", D, dt.datetime(2024, 1, 9, 9), 120.0),
        ("Vienna", None, D, dt.datetime(2024, 1, 9, 9), 130.0),
        ("Vienna", "Rome", D, None, 90.0),
    ]
    return spark.createDataFrame(rows, COLS)


def test_latest_join_form(spark):
    out = latest.latest_per_key(frame(spark), ["date", "origin", "destination"]).collect()
    assert sorted(r.price for r in out) == [110.0, 120.0]


def test_latest_window_form_equals_join(spark):
    a = sorted(latest.latest_per_key(frame(spark), ["date", "origin", "destination"]).collect())
    b = sorted(latest.latest_per_key(frame(spark), ["date", "origin", "destination"],
                                     method="window").collect())
    c = sorted(latest.latest_per_key(frame(spark), ["date", "origin", "destination"],
                                     broadcast_max_bytes=0).collect())
    assert a == b == c


def test_date_window(spark):
    days = [(dt.date(2024, 1, d),) for d in range(9, 15)]
    df = spark.createDataFrame(days, "day date")
    kept = [r.day.day for r in latest.date_window(df, "day", "2024-01-10", 4).collect()]
    assert sorted(kept) == [10, 11, 12, 13]


def test_date_window_timestamps_pushed(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = latest.date_window(df, "ts", "2024-01-10", 4)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in text
    assert all(dt.datetime(2024, 1, 10) <= r.ts < dt.datetime(2024, 1, 14) for r in out.collect())


def test_date_window_prunes_partitions(spark):
    from waymark.session import scratch_path
    from waymark.sources import sinks
    path = scratch_path(spark, "flight-history")
    rows = [(dt.date(2024, 1, d), "Paris", float(d)) for d in range(5, 20)]
    sinks.append_table(spark.createDataFrame(rows, "date date, destination string, price double"),
                       path, partition_by=["date"])
    out = latest.date_window(spark.read.parquet(path), "date", "2024-01-10", 4)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text
    assert sorted(r.date.day for r in out.collect()) == [10, 11, 12, 13]


def test_views_and_sql_text(spark):
    from waymark.sources.tables import register_views, sql_table
    register_views(spark, "/root/testdata/sf0.001", ["region", "nation"])
    got = sql_table(spark, "SELECT count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey")
    assert got.first().n == 25
    marked = sql_table(spark, "SELECT count(*) AS n FROM nation WHERE n_name = :name OR n_regionkey = :region",
                       name="x' OR 'a' = 'a", region=1)
    assert marked.first().n == 5


def test_hot_key_semi_join_is_split_by_aqe(spark):
    """Copies sharing one (key, time) on the shuffle path: AQE splits the skewed partition."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        ev = spark.range(100000).select(
            F.when(F.col("id") < 35000, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("k"),
            F.when(F.col("id") < 35000, F.lit(5)).otherwise(F.col("id") % 7).alias("ts"), "id")
        df = latest.latest_per_key(ev, ["k"], ts="ts", broadcast_max_bytes=0)
        rows = df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert sum(1 for r in rows if r.k == 0) == 35000
    assert "SortMergeJoin(skew=true)" in final and "LeftSemi" in final
