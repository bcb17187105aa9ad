from pyspark.sql import types as T

from waymark.plans import strategy


def test_parse_bytes():
    assert strategy._parse_bytes("10MB") == 10 * 1024 ** 2
    assert strategy._parse_bytes("10485760b") == 10485760
    assert strategy._parse_bytes("-1") == -1
    assert strategy._parse_bytes("2g") == 2 * 1024 ** 3


def test_fixed_row_bytes_follow_unsafe_row_layout(spark):
    fixed = T.StructType([T.StructField(f"c{i}", T.DoubleType()) for i in range(10)])
    assert strategy.fixed_row_bytes(fixed) == 8 + 80 + 16
    with_text = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType())])
    assert strategy.fixed_row_bytes(with_text) == 8 + 16 + 8 + 16


def test_measured_size_counts_long_values(spark):
    from pyspark.sql import functions as F
    long_text = spark.range(20).select("id", F.repeat(F.lit("x"), 100_000).alias("t"))  # 2 MB in few rows
    assert strategy.bounded_broadcast(long_text, max_bytes=100_000)[1] is False
    assert strategy.bounded_broadcast(long_text, max_bytes=3_000_000)[1] is True
    arrays = spark.range(20).select("id", F.array_repeat(F.lit(1), 10_000).alias("a"))
    assert strategy.bounded_broadcast(arrays, max_bytes=100_000)[1] is False
    _, stats = strategy.materialize_with_stats(spark.createDataFrame([("é",), (None,)], "s string"))
    assert stats["rows"] == 2 and stats["bytes"] == 2 * (8 + 8 + 8 + 16) + 2


def test_budget_reads_session(spark):
    spark.conf.set("waymark.broadcast.maxBytes", "1MB")
    try:
        assert strategy.broadcast_budget(spark) == 1024 ** 2
        assert strategy.fits_budget(1024 ** 2, None, spark)
        assert not strategy.fits_budget(1024 ** 2 + 1, None, spark)
    finally:
        spark.conf.unset("waymark.broadcast.maxBytes")
    assert not strategy.fits_budget(0, 0, spark)


def test_materialize_observes_stats(spark):
    from pyspark.sql import functions as F
    df = spark.range(100).withColumn("g", F.col("id") % 7)
    side, stats = strategy.materialize_with_stats(df, "probe", biggest=F.max("g"))
    assert stats["rows"] == 100 and stats["biggest"] == 6 and side.count() == 100


def _hot(spark):
    from pyspark.sql import functions as F
    big = spark.range(2000).select(F.when(F.col("id") < 1500, F.lit("hot")).otherwise(
        (F.col("id") % 5).cast("string")).alias("k"), F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id")).alias("v"))
    return big, big.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("w"))


def test_salted_join_spreads_hot_key_and_copies(spark):
    """A hot key whose rows are mostly copies is joined by many tasks, also with broadcasting off."""
    from pyspark.sql import functions as F
    big, per_key = _hot(spark)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = strategy.salted_join(big, per_key, ["k"], "n", hot_rows=100)
        assert out.columns == big.join(per_key, ["k"]).columns  # no salt in the result
        tasks = (out.filter("k = 'hot' AND v = 7").groupBy(F.spark_partition_id().alias("t")).count().collect())
        assert sum(r["count"] for r in tasks) == 1000 and len(tasks) >= 5
        assert max(r["count"] for r in tasks) < 500
        assert sorted(out.collect()) == sorted(big.join(per_key, ["k"]).collect())
        left = strategy.salted_join(big, per_key.filter("k <> '1'"), ["k"], "n", how="left", hot_rows=100)
        assert sorted(map(str, left.collect())) == sorted(map(str, big.join(per_key.filter("k <> '1'"), ["k"], "left").collect()))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_salted_join_has_no_bar(spark):
    """Every key hot: all of them are split, whatever the broadcast budget."""
    from pyspark.sql import functions as F
    big = spark.range(4000).select((F.col("id") % 40).alias("k"), "id")
    per_key = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = strategy.salted_join(big, per_key, ["k"], "n", hot_rows=10)
    assert out.count() == 4000 and out.select("id").distinct().count() == 4000


def test_scratch_is_shared_or_an_error(spark, monkeypatch):
    import pytest
    from waymark import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": master}.get(key, default)

    class Other:
        conf = Conf()

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(Other())
    import os
    with session.scratch_scope(spark):
        side, _ = strategy.materialize(spark.range(5), "gone")
        path = side.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(path)
    assert not os.path.exists(path)
