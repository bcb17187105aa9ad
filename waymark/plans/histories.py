"""Stored histories laid out for the joins that read them.

Two layouts:

* by travel date: one folder per day. ``window_of_plan`` joins such a history with the days of a request plan, and
  Spark reads only the folders of those days, found while the query runs (dynamic partition pruning).
* by (city, day) buckets: rows of a city and day stand in one bucket file, sorted. Ranges, scores, the
  latest import and the report's join all group by (city, day), so none of them moves the history.

A bucket is one task. A history whose largest (city, day) has more rows than a task should take
(measured while it is written) is therefore stored without buckets, and the operators then shuffle
and split it as they do any table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.scoring import price_points, review_points
from waymark.constants import PRICE_MAX_POINTS, REVIEW_MAX_POINTS
from waymark.operators.hotels import hotel_range
from waymark.plans.strategy import fits_budget, materialize_with_stats, rows_per_task


def window_of_plan(history: DataFrame, plan: DataFrame, day: str, plan_day: str = "day") -> DataFrame:
    """Rows of a date-partitioned history on the days that a plan asks for.

    The days are a semi join side of one row a day, with their first and last day as a filter on both sides; within
    it the history's scan is pruned to the partitions of those days while the query runs.
    """
    wanted = plan.select(F.col(plan_day).alias(day)).filter(F.col(day).isNotNull()).distinct()
    days, seen = materialize_with_stats(wanted, "plan-days", first=F.min(day), last=F.max(day))
    if fits_budget(seen["bytes"], None, history.sparkSession):
        days = F.broadcast(days)
    return history.join(days.filter(F.col(day).between(seen["first"], seen["last"])), day, "left_semi")


def store_history(df: DataFrame, path: str, keys: Sequence[str], buckets: int,
                  max_group: int | None = None) -> tuple[DataFrame, bool]:
    """Write ``df`` at ``path`` in buckets of ``keys``; ``(stored, bucketed?)``.

    It is stored without buckets if a key has more rows than ``max_group`` (``waymark.skew.rowsPerTask``). A rerun replaces
    the table as a whole: its catalogue entry carries a name of its own, and the path is overwritten.
    """
    spark, keys = df.sparkSession, list(keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    _, seen = materialize_with_stats(sizes, "history-groups", largest=F.max("n"))
    if int(seen["largest"] or 0) > (max_group or rows_per_task(spark)):
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path), False
    name = f"history_{uuid.uuid4().hex[:12]}"
    # every bucket's rows come from one task, so a bucket is one file and stays sorted
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
       .option("path", path).saveAsTable(name))
    return spark.table(name), True


def latest_in_place(history: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """``latest_per_key`` for a history bucketed by ``keys``: the maximum per key is joined back on the keys alone,
    which is how the rows lie. The time is compared by ``>=``: as an equality it would be a join key, too, and the
    rows would have to move."""
    keys = list(keys)
    clean = history
    for c in [*keys, ts]:
        clean = clean.filter(F.col(c).isNotNull())
    newest = clean.groupBy(*keys).agg(F.max(ts).alias("_newest"))
    return (clean.hint("merge").join(newest, keys).filter(F.col(ts) >= F.col("_newest"))
            .select(*history.columns))


def score_in_place(offers: DataFrame, keys: Sequence[str], price: str, review: str, **currency) -> DataFrame:
    """``hotel_score`` for offers bucketed by ``keys``: ranges and offers meet where the offers lie."""
    keys = list(keys)
    ranges = hotel_range(offers, keys, price, review, **currency)
    rows = offers
    if currency.get("currency_col") and currency.get("currency") is not None:
        rows = rows.filter(F.col(currency["currency_col"]) == currency["currency"])
    return (rows.hint("merge").join(ranges, keys)
            .withColumn("price_points", price_points(price, "min_price", "diff_price", PRICE_MAX_POINTS))
            .withColumn("review_points", review_points(review, "min_review", "diff_review", REVIEW_MAX_POINTS))
            .withColumn("total_points", F.col("price_points") + F.col("review_points")))

