"""Hotel scoring: ranges per (city, day), weighted score, top-k with ties, publish.

Plan shape (see ``explain``):

* ``hotel_range`` is a partial + final hash aggregate, so a hot (city, day)
  group is combined map-side before it shuffles.
* ``hotel_score`` joins every offer with its group's range. The range table is
  materialised and broadcast only under a proven size bound
  (``plans.strategy.bounded_broadcast``); above it the join is a salted
  shuffle join that splits hot groups over several tasks.
* ``hotel_top_k`` ranks with ``rank() <= k``, which Catalyst turns into a
  ``WindowGroupLimit`` applied *before* the exchange: only candidate rows leave
  the map side (on the salted path, rows are first ranked inside their salt
  bucket). Rows whose score is NULL never compete (their rank is fixed by the
  group's count of scored rows, known from the range table), and they are
  spread over ``spread`` window partitions so a group made entirely of NULL
  scores cannot pile up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.constants import CURRENCY, PRICE_MAX_POINTS, REVIEW_MAX_POINTS, TOP_K
from waymark.functions.scoring import nan_to_null, price_points, review_points
from waymark.plans.strategy import (bounded_broadcast, fits_budget, materialize,
                                     materialize_with_stats, rows_per_task, salted_join)

HOTEL_KEYS = ("city_trans", "checkin_date")

RANGE_COLUMNS = ("max_price", "min_price", "max_review", "min_review",
                 "diff_price", "diff_review", "n_rated", "n_offers")


def _prepare(offers: DataFrame, keys: Sequence[str], price: str, review: str,
             currency_col: str | None, currency: str | None) -> DataFrame:
    """Currency filter (P6, pushed to the scan), NULL keys out, NaN → NULL."""
    df = offers
    if currency_col is not None and currency is not None:
        df = df.filter(F.col(currency_col) == F.lit(currency))
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df.withColumns({price: nan_to_null(price), review: nan_to_null(review)})


def hotel_range(offers: DataFrame, keys: Sequence[str] = HOTEL_KEYS,
                price: str = "price_per_day", review: str = "review_score",
                currency_col: str | None = "currencycode", currency: str | None = CURRENCY) -> DataFrame:
    """Min / max price and review per group (A1), their widths (A2) and offer counts."""
    df = _prepare(offers, keys, price, review, currency_col, currency)
    p, r = F.col(price), F.col(review)
    return (df.groupBy(*keys)
            .agg(F.max(p).alias("max_price"), F.min(p).alias("min_price"),
                 F.max(r).alias("max_review"), F.min(r).alias("min_review"),
                 F.count(F.when(p.isNotNull() & r.isNotNull(), F.lit(1))).alias("n_rated"),
                 F.count(F.lit(1)).alias("n_offers"))
            .withColumn("diff_price", F.col("max_price") - F.col("min_price"))
            .withColumn("diff_review", F.col("max_review") - F.col("min_review")))


def _measured_ranges(offers: DataFrame, keys: list[str], price: str, review: str,
                     currency_col: str | None, currency: str | None, ranges: DataFrame | None,
                     broadcast_max_bytes: int | None) -> tuple[DataFrame, bool, int, int]:
    """Write the range table once; return it (hinted if it fits), whether it fits,
    its row count and the largest group's offer count (both observed in the write)."""
    if ranges is None:
        ranges = hotel_range(offers, keys, price, review, currency_col, currency)
    side, stats = materialize_with_stats(ranges, "hotel-ranges", max_group=F.max("n_offers"))
    n_groups, max_group = int(stats["rows"]), int(stats["max_group"] or 0)
    fits = fits_budget(stats["bytes"], broadcast_max_bytes, offers.sparkSession)
    return (F.broadcast(side) if fits else side), fits, n_groups, max_group


def _score(df: DataFrame, side: DataFrame, fits: bool, keys: list[str], price: str, review: str,
           price_max: int, review_max: int) -> DataFrame:
    joined = df.join(side, keys, "inner") if fits else salted_join(df, side, keys, "n_offers")
    return (joined
            .withColumn("price_points", price_points(price, "min_price", "diff_price", price_max))
            .withColumn("review_points", review_points(review, "min_review", "diff_review", review_max))
            .withColumn("total_points", F.col("price_points") + F.col("review_points")))


def hotel_score(offers: DataFrame, keys: Sequence[str] = HOTEL_KEYS,
                price: str = "price_per_day", review: str = "review_score",
                currency_col: str | None = "currencycode", currency: str | None = CURRENCY,
                ranges: DataFrame | None = None,
                price_max: int = PRICE_MAX_POINTS, review_max: int = REVIEW_MAX_POINTS,
                broadcast_max_bytes: int | None = None) -> DataFrame:
    """Every offer of the currency with price, review and total points.

    Under the broadcast budget the range table is broadcast and offers never
    shuffle. Above it, the join is a salted shuffle join: groups with more than
    ``waymark.skew.rowsPerTask`` offers are split over several tasks.
    """
    keys = list(keys)
    df = _prepare(offers, keys, price, review, currency_col, currency)
    side, fits, _, _ = _measured_ranges(offers, keys, price, review, currency_col, currency,
                                        ranges, broadcast_max_bytes)
    return _score(df, side, fits, keys, price, review, price_max, review_max)


def hotel_top_k(scored: DataFrame, keys: Sequence[str] = HOTEL_KEYS, k: int = TOP_K,
                score: str = "total_points",
                group_stats: tuple[int, int] | None = None) -> DataFrame:
    """Rows with ``rank() <= k`` per group by score descending, NULL scores last, ties kept
    (W1, T1, T2, P10).

    ``scored`` must carry ``n_rated``, ``diff_price`` and ``diff_review`` (as
    ``hotel_score`` output does). ``group_stats`` is ``(groups, largest group)``
    as measured when the range table was written (``hotel_top3`` passes it).

    If no group is larger than ``waymark.skew.rowsPerTask``, one window does it:
    ``rank() <= k`` becomes a ``WindowGroupLimit`` before the exchange, so only
    candidates shuffle and no group exceeds a task. Otherwise (or when the
    sizes are unknown) no task ever sees a whole group:

    1. each (group, input partition) piece keeps its own top ``k`` with ties —
       limited before the exchange — so copies of one offer stay spread over the
       partitions they came from (on the salted path: over their salt buckets); the
       candidates are written once;
    2. candidates collapse to distinct score levels with their multiplicities
       (partial + final hash aggregate); a level's rank is 1 + the rows above it,
       and at most ``k`` levels per group can matter;
    3. candidates join their level (broadcast if the measured size fits,
       else a shuffle join salted by multiplicity) and take its rank. A NULL
       score ranks right after the group's scored rows, known from the range table.
    """
    keys = list(keys)
    s = F.col(score)
    base = scored
    cols = base.columns
    spark = scored.sparkSession
    if group_stats is not None and group_stats[1] <= rows_per_task(spark):
        w = Window.partitionBy(*keys).orderBy(s.desc_nulls_last())
        return (base.withColumn("_r", F.rank().over(w)).filter(F.col("_r") <= k)
                    .withColumn("rank", F.col("_r").cast("bigint")).select(*cols, "rank"))
    # scored rows in the group: every fully rated offer, if both ranges are non-zero
    n_scored = F.when((F.col("diff_price") != 0) & (F.col("diff_review") != 0),
                      F.col("n_rated")).otherwise(F.lit(0)).cast("bigint")
    candidates = (base.filter(s.isNotNull() | (n_scored < k))
                      .withColumn("_piece", F.spark_partition_id())
                      .withColumn("_unrated", s.isNull()))
    piece = Window.partitionBy(*keys, "_piece", "_unrated").orderBy(s.desc_nulls_last())
    candidates = (candidates.withColumn("_r", F.rank().over(piece)).filter(F.col("_r") <= k)
                            .select(*cols))
    candidates, _ = materialize(candidates, "top-k-candidates")
    by_score = Window.partitionBy(*keys).orderBy(s.desc())
    above = by_score.rowsBetween(Window.unboundedPreceding, -1)
    levels = (candidates.filter(s.isNotNull()).groupBy(*keys, score).agg(F.count(F.lit(1)).alias("_mult"))
                        .withColumn("_lv", F.row_number().over(by_score)).filter(F.col("_lv") <= k)
                        .withColumn("_rank", F.coalesce(F.sum("_mult").over(above), F.lit(0)) + 1)
                        .filter(F.col("_rank") <= k).drop("_lv"))
    side, fits = bounded_broadcast(levels, name="top-k-levels")
    joined = (candidates.join(side, [*keys, score], "left") if fits
              else salted_join(candidates, side, [*keys, score], "_mult", how="left"))
    return (joined.filter(F.col("_rank").isNotNull() | s.isNull())
                  .withColumn("rank", F.coalesce(F.col("_rank"), n_scored + 1).cast("bigint"))
                  .select(*cols, "rank"))


def hotel_top3(offers: DataFrame, keys: Sequence[str] = HOTEL_KEYS,
               price: str = "price_per_day", review: str = "review_score",
               currency_col: str | None = "currencycode", currency: str | None = CURRENCY,
               k: int = TOP_K, per_import: str | None = None,
               price_max: int = PRICE_MAX_POINTS, review_max: int = REVIEW_MAX_POINTS,
               broadcast_max_bytes: int | None = None) -> DataFrame:
    """Range → score → top-k. ``per_import`` adds the import-time column to the group key."""
    keys = list(keys) + ([per_import] if per_import else [])
    df = _prepare(offers, keys, price, review, currency_col, currency)
    side, fits, n_groups, max_group = _measured_ranges(
        offers, keys, price, review, currency_col, currency, None, broadcast_max_bytes)
    scored = _score(df, side, fits, keys, price, review, price_max, review_max)
    return hotel_top_k(scored, keys, k, group_stats=(n_groups, max_group))


# renames applied when the scored hotels are published as the ``hotelday`` table
HOTELDAY_RENAMES = {
    "checkin_date": "checkin_date",
    "city_trans": "city",
    "hotel_name": "name",
    "price_per_day": "price",
    "longitude": "longitude",
    "latitude": "latitude",
    "review_score": "rating",
    "import_date": "import_date",
    "rank": "rank",
}


def hotelday_publish(top: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename (P2) and project (P1) the scored hotels to the published table's columns (K3)."""
    renames = HOTELDAY_RENAMES if renames is None else renames
    return top.select(*[F.col(src).alias(dst) for src, dst in renames.items()])
