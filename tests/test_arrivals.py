"""Topics whose fields drift, counts taken on the way, imports scored once, streams run again."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from waymark import schemas
from waymark.operators import latest
from waymark.plans import driver, trips
from waymark.session import scratch_path
from waymark.sources import audit, topics
from waymark.sources.versions import VersionedTable
from waymark.streaming import history, ledger
from waymark.streaming.pipeline import FLIGHT_REQUIRED

VALUES = "value string"


def records(spark, rows):
    return spark.createDataFrame([(r if r is None or isinstance(r, str) else json.dumps(r),) for r in rows], VALUES)


def test_fields_are_the_union_over_all_records(spark):
    rows = [{"a": 1, "b": "x"}, {"a": 2.5, "c d": {"e": 1}}, {"b": 7, "f": None, "g": [1, 2], "it's": True, 'q"t': 1},
            {"x.y": 5, "A": 3, "u\\v": 6, "b\"o'th": 8, "big": 2**62}, {}, "bad", "[1]", "5", None]
    fields = topics.drifting_fields(records(spark, rows))
    assert fields == {"A": "bigint", "a": "double", "b": "string", "b\"o'th": "bigint", "big": "bigint", "c d": "string",
                      "f": "string", "g": "string", "it's": "boolean", 'q"t': "bigint", "u\\v": "bigint", "x.y": "bigint"}
    good, bad = topics.drifting_records(records(spark, rows))
    got = [r.asDict() for r in good.collect()]
    assert len(got) == 5 and sorted(str(r.value) for r in bad.collect()) == ["5", "None", "[1]", "bad"]
    by = {json.dumps(r["a_2"]) + str(r["b"]): r for r in got}  # "A" comes first, and columns do not differ by case
    assert by["1.0x"]["c d"] is None and by["2.5None"]["c d"] == '{"e":1}'
    third = by["null7"]
    assert (third["g"], third["it's"], third['q"t'], third["f"]) == ("[1,2]", True, 1, None)
    fourth = next(r for r in got if r["x.y"] == 5)
    assert (fourth["A"], fourth["u\\v"], fourth["b\"o'th"], fourth["big"]) == (3, 6, 8, 2**62)
    assert topics.drifting_fields(records(spark, [])) == {}
    with pytest.raises(ValueError, match="field names"):
        topics.drifting_fields(records(spark, rows), max_fields=3)


def test_declared_fields_and_kept_columns(spark):
    table = records(spark, [{"a": 1}, {"b": 2}, "x"]).withColumn("key", F.lit("k"))
    good, bad = topics.drifting_records(table, keep=["key"], fields={"a": "bigint", "z": "string", "KEY": "string"})
    assert good.columns == ["key", "a", "z", "KEY_2"]
    assert sorted(map(tuple, good.collect()), key=str) == [("k", 1, None, None), ("k", None, None, None)]
    assert bad.columns == ["value", "key"] and bad.count() == 1
    for df in (good, bad):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


FLIGHT = {"time": "10:30:00", "duration": 15, "company": "Air", "price": 99.0, "n_connections": 0, "date": "2024-01-10",
          "import_date": "2024-01-09T08:00:00", "origin": "Vienna", "destination": "Paris"}


def test_counts_on_the_way(spark):
    table = VersionedTable(spark, scratch_path(spark, "audit"))
    rows = [FLIGHT, FLIGHT, FLIGHT | {"date": None}, "{", None]
    for run in ("one", "two"):
        good, bad = audit.audited_split(records(spark, rows), schemas.FLIGHT_OFFER, run, "flights", table,
                                        required=FLIGHT_REQUIRED)
        assert good.columns == schemas.FLIGHT_OFFER.fieldNames() and good.count() == 2
        assert sorted(r.reject_reason for r in bad.collect()) == ["missing date", "no value", "undecodable"]
    assert sorted(map(tuple, table.read().collect())) == [("one", "flights", 0, 5, 2, 3), ("two", "flights", 0, 5, 2, 3)]
    assert audit.unbalanced(table.read()).count() == 0
    odd = spark.createDataFrame([("x", "t", 0, 5, 2, 2)], audit.AUDIT_SCHEMA)
    assert audit.unbalanced(odd).count() == 1


def test_counts_of_a_stream(spark):
    source, sink, ckpt = (scratch_path(spark, f"audit-{x}") for x in ("src", "out", "ckpt"))
    found = []
    for n in (3, 2):
        records(spark, [FLIGHT] * n + ["{"]).coalesce(1).write.mode("append").parquet(source)
        outcomes = topics.record_outcomes(history.file_stream(spark, source, VALUES), schemas.FLIGHT_OFFER,
                                          required=FLIGHT_REQUIRED)
        query = history.start_history(audit.observed(outcomes), sink, ckpt)
        query.awaitTermination()
        found += audit.stream_audit(query, f"run{n}", "flights")
    assert found == [("run3", "flights", 0, 4, 3, 1), ("run2", "flights", 1, 3, 2, 1)]
    assert spark.read.parquet(sink).count() == 7


def _hotel(name, price, hour):
    return {"city_trans": "Paris", "hotel_name": name, "min_total_price": price * 7, "currencycode": "EUR",
            "longitude": 2.3, "latitude": 48.8, "review_score": 5.0 + price / 100, "checkin_date": "2024-01-10",
            "import_date": f"2024-01-09T{hour:02}:00:00"}


def test_imports_are_scored_once(spark, monkeypatch):
    source, raw, scored, ckpt = (scratch_path(spark, f"led-{x}") for x in ("src", "raw", "scored", "ckpt"))
    done = VersionedTable(spark, scratch_path(spark, "ledger"))
    batches = [[_hotel(f"a{i}", 50 + i, 8) for i in range(5)], [_hotel(f"b{i}", 80 + i, 9) for i in range(2)],
               [_hotel("a9", 10, 8)]]  # the first import grows

    def land(rows):
        records(spark, rows).write.mode("append").parquet(source)
        ledger.start_offer_landing(history.file_stream(spark, source, VALUES), raw, ckpt).awaitTermination()

    land(batches[0])
    assert ledger.score_open_imports(spark, raw, scored, done) == 1
    first = {f for f in spark.read.parquet(scored).inputFiles()}
    assert ledger.score_open_imports(spark, raw, scored, done) == 0
    land(batches[1])
    with monkeypatch.context() as m:  # dies after the scores are written, before the ledger has them
        m.setattr(VersionedTable, "append", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            ledger.score_open_imports(spark, raw, scored, done)
    assert ledger.score_open_imports(spark, raw, scored, done) == 1
    assert first < set(spark.read.parquet(scored).inputFiles())  # the first import's files are as they were
    land(batches[2])
    assert ledger.score_open_imports(spark, raw, scored, done) == 1
    got = spark.read.parquet(scored).select(*schemas.HOTELDAY.fieldNames())
    whole = trips.hotels_from_records(records(spark, sum(batches, [])))
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.select(*got.columns).collect()))
    assert ledger.score_open_imports(spark, raw, scored, done) == 0


def test_state_is_dropped_when_a_day_is_closed(spark):
    """Over many days the state never holds more than the open days' keys."""
    source, sink, ckpt = (scratch_path(spark, f"state-{x}") for x in ("src", "out", "ckpt"))
    cols, base, most, kept = "user_id bigint, ts timestamp, value double", dt.datetime(2024, 1, 1), 0, []
    for day in range(6):
        rows = [(i % 7, base + dt.timedelta(days=day, minutes=11 * i), float(i)) for i in range(120)]
        kept += rows
        spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(source)
        days = history.latest_per_day_state(history.file_stream(spark, source, cols), ["user_id"], "ts")
        query = history.start_history(days, sink, ckpt)
        query.awaitTermination()
        most = max([most, *(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators)])
    assert most <= 2 * 7  # one day open, one being closed
    got = spark.read.parquet(sink)
    every = spark.createDataFrame(kept, cols).withColumn("day", F.to_date("ts"))
    closed = latest.latest_per_key(every, ["day", "user_id"], ts="ts").filter("day < '2024-01-06'")
    assert sorted(map(tuple, got.select(*closed.columns).collect())) == sorted(map(tuple, closed.collect()))


def test_replayed_batch_is_not_written_again(spark):
    source, sink, ckpt = (scratch_path(spark, f"replay-{x}") for x in ("src", "out", "ckpt"))
    for n in range(2):
        spark.range(10 * n, 10 * n + 10).write.mode("append").parquet(source)
        for _ in range(2):
            history.start_history(history.file_stream(spark, source, "id bigint"), sink, ckpt).awaitTermination()
            driver.lose_last_commit(spark, ckpt)
    history.start_history(history.file_stream(spark, source, "id bigint"), sink, ckpt).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == list(range(20))
