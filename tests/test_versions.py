"""Tables swapped whole, updated by key, kept at the latest import, and histories laid out for their joins."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from waymark.operators import hotels, latest
from waymark.plans import histories
from waymark.session import scratch_path
from waymark.sources.versions import PublishConflict, VersionedTable, upsert

from conftest import plan_text

COLS = "id bigint, day date, price double, note string"
D = [dt.date(2024, 1, d) for d in range(1, 11)]


def table(spark, partition_by=()):
    return VersionedTable(spark, scratch_path(spark, "versioned"), partition_by)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_replace_from_itself_and_pinned_readers(spark):
    t = table(spark)
    with pytest.raises(ValueError, match="no version"):
        t.read()
    t.replace(spark.createDataFrame([(1, D[0], 1.0, "a"), (2, D[1], None, None)], COLS))
    before = t.read()
    t.replace(t.read().withColumn("price", F.col("price") + 1))
    t.replace(t.read().filter("id = 1"))
    assert rows(before.fillna("", ["note"]).select("id", "note")) == [(1, "a"), (2, "")]  # still its own version
    assert t.versions() == [1, 2, 3] and rows(t.read()) == [(1, D[0], 2.0, "a")]
    assert t.read(2).count() == 2 and t.read(1).schema == t.read().schema
    assert len(t.vacuum(keep=1)) == 4 and t.versions() == [3] and t.read().count() == 1
    t.replace(t.read().limit(0))
    assert t.read().count() == 0


def test_crash_between_write_and_swap_leaves_the_old_table(spark, monkeypatch):
    t = table(spark)
    t.replace(spark.range(3))

    def dies(*_):
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_publish", dies)
        with pytest.raises(OSError):
            t.replace(spark.range(100))
    again = VersionedTable(spark, t.root)
    assert again.current() == 1 and again.read().count() == 3
    again.replace(spark.range(5))
    assert again.read().count() == 5 and again.read(1).count() == 3


def test_two_writers_of_one_version(spark):
    t = table(spark)
    t.replace(spark.range(3))
    other = VersionedTable(spark, t.root)
    step = other._load(spark.range(9))
    t.replace(spark.range(4))
    with pytest.raises(PublishConflict):
        other._publish(2, {"schema": spark.range(0).schema.jsonValue(), "directories": step, "notes": {}})
    assert t.read().count() == 4 and t.versions() == [1, 2]


def test_append(spark):
    t = table(spark, ["day"])
    t.append(spark.createDataFrame([(1, D[0], 1.0, "a")], COLS), run="x")
    t.append(spark.createDataFrame([(2, D[0], 1.0, "b"), (3, D[1], 1.0, "c")], COLS))
    assert sorted(r.id for r in t.read().collect()) == [1, 2, 3] and t.note("run") == "x" and t.note("other") is None


def test_upsert_is_a_primary_key(spark):
    t = table(spark, ["day"])
    t.replace(spark.createDataFrame([(i, D[i % 5], float(i), "old") for i in range(20)], COLS))
    batch = [(0, D[0], 100.0, "new"), (0, D[0], 101.0, "newer"), (0, D[0], 101.0, "newer"), (77, D[1], 5.0, "more"),
             (77, D[9], 6.0, "same id, other day"), (None, D[2], 1.0, "no key"), (5, None, 1.0, "no day")]
    rejects = upsert(t, spark.createDataFrame(batch, COLS), ["id", "day"], ["price"])
    assert sorted(r.note for r in rejects.collect()) == ["no day", "no key"]
    got = {(r.id, r.day): (r.price, r.note) for r in t.read().collect()}
    assert len(got) == t.read().count() == 22
    assert got[0, D[0]] == (101.0, "newer") and got[77, D[9]][0] == 6.0 and got[5, D[0]] == (5.0, "old")
    with pytest.raises(ValueError, match="part of the key"):
        upsert(t, spark.createDataFrame(batch, COLS), ["id"], ["price"])


def test_upsert_reads_and_writes_the_touched_partitions_only(spark):
    t = table(spark, ["day"])
    t.replace(spark.createDataFrame([(i, D[i % 10], float(i), "old") for i in range(100)], COLS).repartition("day"))
    before = set(t._manifest(1)["directories"])
    seen = []

    def merge(old, new):
        seen.append({f.rsplit("/", 2)[1] for f in old.inputFiles()})
        return old.join(new.select("id", "day"), ["id", "day"], "left_anti").unionByName(new)

    t.rewrite(spark.createDataFrame([(3, D[3], 0.0, "x"), (500, D[4], 0.0, "y")], COLS), merge)
    after = set(t._manifest(2)["directories"])
    assert seen == [{"day=2024-01-04", "day=2024-01-05"}]
    assert len(before & after) == 8 and len(after) == 10 and t.read().count() == 101
    with pytest.raises(ValueError, match="partitions that the batch does not have"):
        t.rewrite(spark.createDataFrame([(3, D[3], 0.0, "x")], COLS), lambda old, new: new.withColumn("day", F.lit(D[7])))
    t.rewrite(spark.createDataFrame([], COLS), lambda old, new: old.unionByName(new))
    assert t.read().count() == 101


def test_latest_kept_batch_by_batch(spark):
    keys = ["id", "day"]
    data = [(i % 4, D[i % 6], float(i % 5), f"r{i}") for i in range(200)] + [(None, D[0], 9.0, "n"), (1, D[1], None, "t")]
    batches = [spark.createDataFrame(data[a:a + 70], COLS) for a in (0, 70, 140)]
    t = table(spark, ["day"])
    for n, b in enumerate([batches[0], batches[1], batches[1], batches[2]]):
        latest.merge_latest(t, b, keys, "price", batch_id=str([0, 1, 1, 2][n]))
    whole = latest.latest_per_key(spark.createDataFrame(data, COLS), keys, ts="price")
    assert rows(t.read()) == rows(whole)
    assert t.current() == 3  # the batch that came twice made no version
    with pytest.raises(ValueError, match="part of the key"):
        latest.merge_latest(t, batches[0], ["id"], "price")


def test_last_batch_does_not_scan_history(spark, monkeypatch):
    t = table(spark, ["day"])
    latest.merge_latest(t, spark.createDataFrame([(i, D[i % 8], 1.0, "h") for i in range(80)], COLS), ["id", "day"], "price")
    read = []
    plain = VersionedTable._read
    monkeypatch.setattr(VersionedTable, "_read", lambda self, dirs, schema: read.append((self.root, len(dirs))) or plain(self, dirs, schema))
    latest.merge_latest(t, spark.createDataFrame([(100, D[2], 2.0, "new")], COLS), ["id", "day"], "price")
    assert [n for root, n in read if root == t.root] == [1]


def test_plan_days_prune_the_history(spark):
    path = scratch_path(spark, "by-day")
    spark.createDataFrame([(i, D[i % 10], float(i), "x") for i in range(100)], COLS).write.partitionBy("day").parquet(path)
    plan = spark.createDataFrame([("A", D[2]), ("B", D[2]), ("A", D[5]), ("A", None)], "country string, day date")
    out = histories.window_of_plan(spark.read.parquet(path), plan, "day")
    assert sorted({r.day for r in out.collect()}) == [D[2], D[5]] and out.count() == 20
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = out._jdf.queryExecution().explainString(mode)
    assert "dynamicpruningexpression(day" in text and "2024-01-03" in text.split("PartitionFilters", 1)[1].split("\n")[0]


OFFERS = "city bigint, day date, price double, review double, currency string, at bigint"


def offers(spark, n=400):
    return spark.createDataFrame([(i % 13, D[i % 7], float(i % 31), float(i % 11), "EUR" if i % 3 else "USD", i % 5)
                                  for i in range(n)], OFFERS)


def test_stored_history_is_not_exchanged(spark):
    stored, bucketed = histories.store_history(offers(spark), scratch_path(spark, "bucketed"), ["city", "day"], 4)
    assert bucketed and stored.count() == 400
    args = dict(currency_col="currency", currency="EUR")
    score = histories.score_in_place(stored, ["city", "day"], "price", "review", **args)
    newest = histories.latest_in_place(stored, ["city", "day"], "at")
    for out in (score, newest):
        out.collect()
        text = plan_text(out)
        assert "Exchange" not in text and "SortMergeJoin" in text
    plain = hotels.hotel_score(offers(spark), ["city", "day"], "price", "review", **args)
    assert sorted(map(str, score.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    expected = latest.latest_per_key(offers(spark), ["city", "day"], ts="at")
    assert rows(newest) == rows(expected)
    report = newest.groupBy("city", "day").agg(F.min("price").alias("low")).join(score, ["city", "day"])
    report.collect()
    assert "Exchange hashpartitioning" not in plan_text(report)  # a small side may be broadcast, the history stays


def test_hot_history_is_stored_without_buckets_and_reruns_replace(spark):
    path = scratch_path(spark, "history")
    one = spark.range(500).select(F.lit(1).cast("long").alias("city"), F.lit(D[0]).alias("day"), F.col("id").cast("double").alias("price"))
    for _ in range(2):
        stored, bucketed = histories.store_history(one, path, ["city", "day"], 4, max_group=100)
        assert not bucketed and stored.count() == 500
    for _ in range(2):
        stored, bucketed = histories.store_history(one, path, ["city", "day"], 4)
        assert bucketed and stored.count() == 500
