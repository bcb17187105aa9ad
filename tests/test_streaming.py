import datetime as dt
import time

from pyspark.sql import functions as F

from waymark.operators import latest
from waymark.session import scratch_path
from waymark.streaming import history, pipeline

COLS = "user_id bigint, event_type string, ts timestamp, value double"


def batch(spark, start, n):
    base = dt.datetime(2024, 1, 1)
    rows = [(i % 7, ["a", "b"][i % 2], base + dt.timedelta(minutes=start + i), float(i))
            for i in range(n)]
    return spark.createDataFrame(rows, COLS)


def test_history_stream_exactly_once(spark):
    src, sink, ckpt = (scratch_path(spark, n) for n in ("src", "sink", "ckpt"))
    b1, b2, b3 = batch(spark, 0, 40), batch(spark, 100, 30), batch(spark, 200, 20)
    b1.write.parquet(f"{src}/part=1")
    b2.write.mode("append").parquet(f"{src}/part=2")
    schema = b1.schema

    def run():
        stream = history.file_stream(spark, f"{src}/*", schema, max_files_per_trigger=1)
        history.start_history(stream, sink, ckpt).awaitTermination()

    run()
    assert spark.read.parquet(sink).count() == 70
    run()  # same checkpoint, nothing new: nothing added
    assert spark.read.parquet(sink).count() == 70
    b3.write.parquet(f"{src}/part=3")
    run()
    hist = spark.read.parquet(sink)
    assert hist.count() == 90
    expect = latest.latest_per_key(b1.union(b2).union(b3), ["user_id", "event_type"], ts="ts")
    got = latest.latest_per_key(hist, ["user_id", "event_type"], ts="ts")
    assert sorted(got.collect()) == sorted(expect.select(*got.columns).collect())


def test_latest_state_matches_batch(spark):
    src = scratch_path(spark, "state-src")
    data = batch(spark, 0, 60)
    data.repartition(3).write.parquet(src)
    stream = history.file_stream(spark, src, data.schema, max_files_per_trigger=1)
    q = (history.latest_state(stream, ["user_id", "event_type"], "ts")
         .writeStream.format("memory").queryName("latest_state_t").outputMode("complete")
         .option("checkpointLocation", scratch_path(spark, "state-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(spark.table("latest_state_t").collect())
    expect = latest.latest_per_key(data, ["user_id", "event_type"], ts="ts")
    assert got == sorted(expect.select(*spark.table("latest_state_t").columns).collect())


def test_score_hotel_batch_is_idempotent(spark):
    """The foreachBatch body, run directly on a bounded batch (twice: same output)."""
    import json
    rows = [{"city_trans": "Paris", "hotel_name": h, "min_total_price": p * 7, "currencycode": "EUR",
             "longitude": 2.3, "latitude": 48.8, "review_score": r, "checkin_date": "2024-01-10",
             "import_date": "2024-01-09T08:00:00"}
            for h, p, r in (("A", 100, 8), ("B", 50, 6), ("C", 75, 9), ("D", 60, 9))]
    records = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    offers = pipeline.decode_hotels(records)
    sink = scratch_path(spark, "hotelday-stream")
    pipeline.score_hotel_batch(offers, 0, sink)
    pipeline.score_hotel_batch(offers, 0, sink)
    out = spark.read.parquet(sink)
    assert sorted(r.name for r in out.collect()) == ["B", "C", "D"]


def test_decode_flights_adds_arrival(spark):
    import json
    rec = {"time": "23:50:00", "duration": 15, "company": "Air", "price": 99.0, "n_connections": 0,
           "date": "2024-01-10", "import_date": "2024-01-09T08:00:00", "origin": "Vienna",
           "destination": "Paris"}
    records = spark.createDataFrame([(json.dumps(rec),)], "value string")
    r = pipeline.decode_flights(records).first()
    assert r.arrival_time == "00:05:00" and r.arrival_ts == dt.datetime(2024, 1, 11, 0, 5)


def test_ntz_cast_for_watermark(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts")
    assert dict(history.ntz_to_timestamp(df, ["ts"]).dtypes)["ts"] == "timestamp"


def test_flight_stream_from_text_records(spark):
    """Flight records arriving as JSON lines (a topic stand-in) stream into the flight table."""
    import json
    import os
    src, sink, ckpt = (scratch_path(spark, n) for n in ("fl-src", "fl-sink", "fl-ckpt"))
    os.makedirs(src, exist_ok=True)
    recs = [{"time": f"{h:02}:30:00", "duration": 95, "company": "Air", "price": 100.0 + h,
             "n_connections": 0, "date": "2024-01-10", "import_date": "2024-01-09T08:00:00",
             "origin": "Vienna", "destination": "Paris"} for h in (8, 22)]
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in recs))
    stream = spark.readStream.format("text").load(src)
    pipeline.start_flight_stream(stream, sink, ckpt).awaitTermination()
    got = sorted((r.time, r.arrival_time, str(r.arrival_ts)) for r in spark.read.parquet(sink).collect())
    assert got == [("08:30:00", "10:05:00", "2024-01-10 10:05:00"),
                   ("22:30:00", "00:05:00", "2024-01-11 00:05:00")]


def test_latest_per_day_with_watermark(spark):
    """Closed days are emitted once and equal the batch result; the open day stays in state."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    src, sink, ckpt = (scratch_path(spark, n) for n in ("wm-src", "wm-sink", "wm-ckpt"))
    base = dt.datetime(2024, 1, 1)
    rows = [(i % 5, "view", base + dt.timedelta(hours=3 * i), float(i)) for i in range(24)]  # 3 days
    data = spark.createDataFrame(rows, COLS)
    for d in (1, 2, 3):  # one file per day, written in event-time order (the source reads oldest first)
        day = data.filter(F.dayofmonth("ts") == d).coalesce(1)
        day.write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = history.file_stream(spark, src, data.schema, max_files_per_trigger=1)
    q = (history.latest_per_day_state(stream, ["user_id", "event_type"], "ts", delay="1 hour")
         .writeStream.format("parquet").outputMode("append").option("path", sink)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(sink)
    days = sorted({r.day for r in got.collect()})
    assert days == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    expect = latest.latest_per_key(data.withColumn("day", F.to_date("ts")),
                                   ["day", "user_id", "event_type"], ts="ts").filter(F.col("day").isin(days))
    assert sorted(got.select(*expect.columns).collect()) == sorted(expect.collect())


def test_flight_and_quarantine_streams(spark):
    """One bad record stops no stream: it lands in the quarantine table, the others by travel date."""
    import json
    import os

    from waymark.session import scratch_path
    from waymark.streaming import pipeline
    fl = {"time": "10:30:00", "duration": 15, "company": "Air", "price": 99.0, "n_connections": 0, "date": "2024-01-10",
          "import_date": "2024-01-09T08:00:00", "origin": "Vienna", "destination": "Paris"}
    rows = [fl, fl | {"date": "2024-01-11"}, fl | {"time": "n/a"}, fl | {"duration": "long"}, "{", None]
    source = scratch_path(spark, "records")
    table = spark.createDataFrame([(r if r is None or isinstance(r, str) else json.dumps(r),) for r in rows], "value string")
    table.repartition(2).write.parquet(source)
    sink, aside = scratch_path(spark, "flight"), scratch_path(spark, "aside")
    for _ in range(2):  # started again from its checkpoint, a stream adds nothing
        records = spark.readStream.schema(table.schema).parquet(source)
        pipeline.start_flight_stream(records, sink, sink + "-ckpt").awaitTermination()
        pipeline.start_reject_stream(records, "flight", aside, aside + "-ckpt").awaitTermination()
    good, bad = spark.read.parquet(sink), spark.read.parquet(aside)
    assert good.count() == 3 and good.filter("arrival_time IS NULL").count() == 1
    assert sorted(r.reject_reason for r in bad.collect()) == ["no value", "undecodable", "undecodable"]
    assert {d for d in os.listdir(sink) if d.startswith("date=")} == {"date=2024-01-10", "date=2024-01-11"}


def test_batches_of_two_checkpoints_stay_apart(spark):
    """Batch 0 of a new checkpoint does not replace batch 0 of an older one; a replay replaces itself."""
    import datetime as dt

    from waymark.session import scratch_path
    from waymark.streaming import pipeline
    cols = ("city_trans string, hotel_name string, price_per_day double, currencycode string, longitude double, "
            "latitude double, review_score double, checkin_date date, import_date timestamp")
    batch = spark.createDataFrame([("Paris", n, p, "EUR", 2.3, 48.8, r, dt.date(2024, 1, 10), dt.datetime(2024, 1, 9, 8))
                                   for n, p, r in (("A", 10.0, 5.0), ("B", 20.0, 6.0))], cols)
    sink = scratch_path(spark, "hotel")
    for run in ("one", "two", "two"):
        pipeline.score_hotel_batch(batch, 0, sink, run=run)
    assert spark.read.parquet(sink).count() == 4
