"""Report tables (V1-V4): price flags, midpoints, numbered lists, trip assembly.

Patterns used for scale:

* whole-table extremes are scalar subqueries (``DataFrame.scalar()``), planned
  once and inlined — no single-partition window, no cross join;
* per-group extremes are a partial + final aggregate joined back under a
  proven size bound;
* the trip report aggregates every side to one row per key *before* joining,
  so joins never multiply rows, and top-k slots are limited with a
  ``row_number() <= k`` (``WindowGroupLimit``) before anything is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.constants import TOP_K
from waymark.plans.strategy import bounded_broadcast, materialize, rows_per_task, salted_join

FLAG_MAX, FLAG_MIN, FLAG_OTHER = "max", "min", "other"


def price_flags(df: DataFrame, price: str, group: Sequence[str] | None = None,
                rounded: bool = True, digits: int = 2, flag_col: str = "price_flag") -> DataFrame:
    """Flag each row's price as the (rounded) maximum, minimum or other.

    The flag is a label column (X4) for the price board (V1).

    ``rounded=False`` reproduces the original comparison of the raw price with
    the rounded extreme (quirk Q17), under which an unrounded maximum is never
    flagged.
    """
    if group:
        group = list(group)
        ext = df.groupBy(*group).agg(F.round(F.max(price), digits).alias("_mx"),
                                     F.round(F.min(price), digits).alias("_mn"),
                                     F.count(F.lit(1)).alias("_rows"))
        side, fits = bounded_broadcast(ext, name="price-extremes")
        if fits:
            out = df.join(side, group, "left")
        else:  # many groups: shuffle join, hot groups split over salt buckets
            out = salted_join(df, side, group, "_rows", how="left")
        mx, mn = F.col("_mx"), F.col("_mn")
    else:
        out = df
        mx = df.select(F.round(F.max(price), digits)).scalar()
        mn = df.select(F.round(F.min(price), digits)).scalar()
    p = F.round(F.col(price), digits) if rounded else F.col(price)
    flag = F.when(p == mx, F.lit(FLAG_MAX)).when(p == mn, F.lit(FLAG_MIN)).otherwise(F.lit(FLAG_OTHER))
    out = out.withColumn(flag_col, flag)
    return out.drop("_mx", "_mn", "_rows") if group else out


def geo_midpoint(points: DataFrame, group: Sequence[str], lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Bounding-box centre per group: ``(max + min) / 2`` of longitude and latitude."""
    return points.groupBy(*group).agg(
        ((F.max(lon) + F.min(lon)) / 2).alias("lon_mid"),
        ((F.max(lat) + F.min(lat)) / 2).alias("lat_mid"))


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
             idx_col: str = "idx", method: str = "auto", partitions: int | None = None) -> DataFrame:
    """Number rows 1..n inside each group in a total order.

    The columns not named in ``order`` settle ties, so every method gives equal rows
    equal numbers.

    ``method="auto"`` (default): measure the largest group (a partial + final
    count over the group columns only) and use ``window`` if no group exceeds
    ``waymark.skew.rowsPerTask``, else ``range``.

    ``method="window"``: ``row_number()`` over the group — one exchange, but each
    group is numbered by a single task.

    ``method="range"``: range-partition on (group, order) so a large
    group spans many partitions and number rows inside each (group, partition)
    piece. The pieces are written once under the checkpoint root: the range
    bounds come from a sample, so pinning them guarantees that the piece sizes
    and the local numbers come from the same split, even if a stage reruns.
    The group's offset in a piece is the sum of the sizes of its earlier pieces;
    the offset table (at most ``partitions + groups - 1`` rows) is broadcast
    when its measured size fits the budget, else shuffle-joined on
    (group, partition), which no hot group can skew.
    """
    group = list(group)
    named = {*group, *[c for c in order if isinstance(c, str)]}
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    order_cols += [F.col(c) for c in df.columns if c not in named]
    if method == "auto":
        sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
        largest = sizes.agg(F.max("_n")).first()[0] or 0  # one number to the driver
        method = "window" if largest <= rows_per_task(df.sparkSession) else "range"
    if method == "window":
        w = Window.partitionBy(*group).orderBy(*order_cols)
        return df.withColumn(idx_col, F.row_number().over(w).cast("bigint"))
    if method != "range":
        raise ValueError(f"unknown method {method!r}")
    range_cols = [*[F.col(g) for g in group], *order_cols]
    # without an explicit count AQE may merge adjacent ranges, which keeps them contiguous
    ranged = (df.repartitionByRange(partitions, *range_cols) if partitions
              else df.repartitionByRange(*range_cols)).withColumn("_part", F.spark_partition_id())
    local_w = Window.partitionBy(*group, "_part").orderBy(*order_cols)
    local, _ = materialize(ranged.withColumn("_local", F.row_number().over(local_w)), "numbered")
    pieces = local.groupBy(*group, "_part").agg(F.max("_local").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    side, _ = bounded_broadcast(offsets, name="numbered-offsets")
    return (local.join(side, [*group, "_part"], "inner")
                 .withColumn(idx_col, (F.col("_offset") + F.col("_local")).cast("bigint"))
                 .drop("_part", "_local", "_offset"))


def top_slots(rows: DataFrame, keys: Sequence[str], text: str | Column,
              order: Sequence[str | Column], k: int = TOP_K, prefix: str = "hotel_") -> DataFrame:
    """One row per key with the first ``k`` texts in ``order`` as ``prefix1..prefixk`` (T4).

    Limited with ``row_number() <= k`` before the slots are gathered, so at most
    ``k`` rows per key ever meet in one place; a missing slot is NULL.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c) if isinstance(c, str) else c for c in order])
    t = F.col(text) if isinstance(text, str) else text
    ranked = rows.select(*keys, t.alias("_text"), F.row_number().over(w).alias("_slot")) \
                 .filter(F.col("_slot") <= k)
    return ranked.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_slot") == i, F.col("_text"))).alias(f"{prefix}{i}") for i in range(1, k + 1)])


# what a trip row says where a side is missing
NO_FLIGHT_NEEDED = "at home"
NO_FLIGHTS = "no flight"
NO_HOTELS = "no hotel"
NO_MONUMENTS = "no monument"


def trip_report(plan: DataFrame, keys: Sequence[str], country_col: str, home_country: str,
                flights: DataFrame | None = None, hotels: DataFrame | None = None,
                monuments: DataFrame | None = None, k: int = TOP_K) -> DataFrame:
    """Flight + up to ``k`` hotels + monuments for every row of the plan.

    ``flights`` is ``keys + flight`` (one row per key), ``hotels`` is ``top_slots``
    output, ``monuments`` is ``keys + monuments`` (or the plan already carries a
    ``monuments`` column). A missing side becomes a message; the home country
    needs no flight.
    """
    keys = list(keys)
    out = plan
    for side in (flights, hotels, monuments):
        if side is not None:
            out = out.join(side, keys, "left")
    flight = F.col("flight") if flights is not None else F.lit(None).cast("string")
    out = out.withColumn("flight", F.when(F.col(country_col) == F.lit(home_country), F.lit(NO_FLIGHT_NEEDED))
                         .otherwise(F.coalesce(flight, F.lit(NO_FLIGHTS))))
    first = F.col("hotel_1") if hotels is not None else F.lit(None).cast("string")
    out = out.withColumn("hotel_1", F.coalesce(first, F.lit(NO_HOTELS)))
    for i in range(2, k + 1):
        if hotels is None:
            out = out.withColumn(f"hotel_{i}", F.lit(None).cast("string"))
    mon = F.col("monuments") if "monuments" in out.columns else F.lit(None).cast("string")
    return out.withColumn("monuments", F.coalesce(mon, F.lit(NO_MONUMENTS)))
