import datetime as dt
import math
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark import schemas
from waymark.session import scratch_path
from waymark.sources import delimited, sinks, topics


def test_csv_decimal_comma_and_bom(spark):
    path = scratch_path(spark, "capitals-fixture")
    os.makedirs(path, exist_ok=True)
    text = ("﻿ID;name;Region;country;Geographic Area;Continent;latitude;longitude;"
            "Latitude 2;Longitude 2;Latitude 3;Longitude 3\r\n"
            "1;Schönbrunn;Wien;Austria;Central Europe;Europe;48,1845;16,3122;;;;\r\n"
            "2;Cliffs;-;Ireland;West Europe;Europe;52,9715;-9,4309;53,0;-9,0;;\r\n"
            "3;Bad;-;Ireland;West Europe;Europe;abc;;;;;\r\n")
    with open(os.path.join(path, "m.csv"), "w", encoding="utf-8") as fh:
        fh.write(text)
    df = delimited.read_delimited(spark, path, schemas.MONUMENT_FILE,
                                  columns=["ID", "name", "country", "longitude", "latitude", "Latitude 2"])
    rows = {r.ID: r for r in df.collect()}
    assert rows[1].name == "Schönbrunn" and rows[1].latitude == 48.1845 and rows[1].longitude == 16.3122
    assert rows[2].longitude == -9.4309 and rows[2]["Latitude 2"] == 53.0
    assert rows[1]["Latitude 2"] is None and rows[3].latitude is None
    rej = delimited.conversion_rejects(spark, path, schemas.MONUMENT_FILE).collect()
    assert [r.ID for r in rej] == ["3"]


def test_csv_roundtrip(spark):
    df = spark.createDataFrame([(1, "a", 50.633), (2, "b", -3.0883), (3, None, None)],
                               "id bigint, name string, v double")
    path = scratch_path(spark, "csv-roundtrip")
    delimited.write_delimited(df, path)
    back = delimited.read_delimited(spark, path, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_topic_roundtrip_keeps_nulls_nan_and_micros(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("x", T.DoubleType()),
                           T.StructField("t", T.TimestampNTZType())])
    t = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([("k", 1.5, t), (None, float("nan"), None)], schema)
    enc = topics.encode_records(df)
    values = [r.value for r in enc.collect()]
    assert any('"a":null' in v for v in values)  # NULL fields kept
    back = topics.decode_records(enc.withColumn("timestamp", F.lit(None).cast("timestamp")),
                                 schema).collect()
    got = sorted(back, key=lambda r: r.a or "")
    assert got[0].a is None and math.isnan(got[0].x)
    assert got[1].t == t and got[1].x == 1.5


def test_undecodable_records(spark):
    recs = spark.createDataFrame([("1", '{"k": 1}'), ("2", "nope")], "key string, value string")
    bad = topics.undecodable_records(recs, "k BIGINT")
    assert [r.key for r in bad.collect()] == ["2"]


def test_table_life_cycle(spark):
    path = scratch_path(spark, "hotelday-table")
    sinks.create_table(spark, "hotelday_t", schemas.HOTELDAY, path)
    raw = spark.createDataFrame([("2024-01-10", "Paris", "A", "80.5")],
                                "checkin_date string, city string, name string, price string")
    typed = sinks.conform(raw, schemas.HOTELDAY)
    assert typed.schema == schemas.HOTELDAY
    typed.write.mode("append").insertInto("hotelday_t")
    assert spark.table("hotelday_t").first().price == 80.5
    sinks.drop_tables(spark, ["hotelday_t"])
    assert "hotelday_t" not in [t.name for t in spark.catalog.listTables()]


def test_partition_overwrite_idempotent(spark):
    path = scratch_path(spark, "batches")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "batch_id int, v string")
    sinks.overwrite_partitions(df, path, ["batch_id"])
    sinks.overwrite_partitions(df.filter("batch_id = 2"), path, ["batch_id"])
    assert spark.read.parquet(path).count() == 2


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert [(r.a, r.b, r.n_rows) for r in sinks.key_violations(df, ["a", "b"]).collect()] == [(1, 1, 2)]


def test_catalogue_loaders(spark):
    path = scratch_path(spark, "catalogue")
    os.makedirs(f"{path}/cap", exist_ok=True)
    os.makedirs(f"{path}/mon", exist_ok=True)
    with open(f"{path}/cap/c.csv", "w", encoding="utf-8") as fh:
        fh.write("﻿country;capital;airport_code;dest_id_booking\r\nAustria;Vienna;VIE;-100\r\n"
                 "Portugal;Lisbon;LIS;-200\r\n")
    with open(f"{path}/mon/m.csv", "w", encoding="utf-8") as fh:
        fh.write("﻿ID;name;Region;country;Geographic Area;Continent;latitude;longitude;"
                 "Latitude 2;Longitude 2;Latitude 3;Longitude 3\r\n"
                 "7;Torre;Lisboa ;Portugal;South Europe;Europe;38,6916;-9,216;;;;\r\n")
    caps = delimited.read_capitals(spark, f"{path}/cap").collect()
    assert [(r.country, r.capital, r.dest_id_booking) for r in caps] == [
        ("Austria", "Vienna", -100), ("Portugal", "Lisbon", -200)]
    mons = delimited.read_monuments(spark, f"{path}/mon").collect()
    assert [(r.name, r.country, r.longitude, r.latitude) for r in mons] == [
        ("Torre", "Portugal", -9.216, 38.6916)]


def test_connector_options():
    import pytest
    from waymark.sources.tables import jdbc_options
    o = jdbc_options("jdbc:postgresql://db:5432/x", "flight", user="u", password="p",
                     partition_column="f_id", lower_bound=0, upper_bound=1000, num_partitions=8)
    assert o["partitionColumn"] == "f_id" and o["numPartitions"] == "8" and o["dbtable"] == "flight"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")
    k = topics.kafka_source_options("broker:9092", "hotels")
    assert k["subscribe"] == "hotels" and k["startingOffsets"] == "earliest"


def test_decode_prefers_payload_import_time(spark):
    import json
    rec = {"city_trans": "Paris", "hotel_name": "A", "min_total_price": 700.0, "currencycode": "EUR",
           "longitude": 2.3, "latitude": 48.8, "review_score": 8.0, "checkin_date": "2024-01-10",
           "import_date": "2024-01-09T08:00:00"}
    recs = spark.createDataFrame([(json.dumps(rec), dt.datetime(2024, 1, 9, 9, 30))],
                                 "value string, timestamp timestamp")
    out = topics.decode_records(recs, schemas.HOTEL_OFFER)
    assert out.columns == schemas.HOTEL_OFFER.fieldNames()
    assert out.first().import_date == dt.datetime(2024, 1, 9, 8, 0)
    plain = topics.decode_records(recs, "k BIGINT")
    assert plain.columns == ["k", "import_date"]


def test_small_helpers(spark):
    from waymark.functions.timefn import today
    from waymark.sources.payloads import with_request_columns
    from waymark.sources.tables import scan_columns
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    pruned = scan_columns(df, "o_orderkey", "o_orderdate")
    assert pruned.columns == ["o_orderkey", "o_orderdate"]
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in \
        pruned._jdf.queryExecution().executedPlan().toString()
    req = with_request_columns(spark.range(2), {"origin": "Vienna", "destination": "Paris"})
    assert {(r.origin, r.destination) for r in req.collect()} == {("Vienna", "Paris")}
    assert spark.range(1).select(today().alias("d")).first().d == dt.date.today()


def test_csv_header_and_short_rows(spark):
    """Columns are not taken by position alone, and rows with another number of fields are reported."""
    import os

    import pytest as _pytest

    from waymark import schemas
    from waymark.session import scratch_path
    from waymark.sources import delimited

    def file(text):
        path = scratch_path(spark, "csv")
        os.makedirs(path)
        with open(f"{path}/c.csv", "w", encoding="utf-8") as out:
            out.write(text)
        return path

    good = file("country;capital;airport_code;dest_id_booking\nFrance;Paris;CDG;-2\nSpain;Madrid\nItaly;Rome;FCO;x\n")
    rows = delimited.read_capitals(spark, good).collect()
    assert [r.country for r in rows] == ["France", "Spain", "Italy"]
    rejects = delimited.conversion_rejects(spark, good, schemas.CAPITAL_FILE).collect()
    assert sorted(r.country for r in rejects) == ["Italy", "Spain"]
    swapped = file("capital;country;airport_code;dest_id_booking\nParis;France;CDG;-2\n")
    with _pytest.raises(Exception, match="(?i)header"):
        delimited.read_capitals(spark, swapped).collect()
