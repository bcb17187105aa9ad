"""Flight operators: arrival time (right and compatible forms), dedupe, first item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.timefn import (add_minutes, arrival_clock, arrival_clock_compat,
                                      minutes_to_hours)


def arrival_time(df: DataFrame, clock: str = "time", duration: str = "duration",
                 departure_ts: str | None = None) -> DataFrame:
    """Adds ``arrival_time`` (``HH:mm:00``, F2 F5), ``duration_hours`` (F8) and, when the
    full departure timestamp is known, ``arrival_ts``. Plain columns on the same row, so
    no positional zip (J6) and no row function (X2, X3) is needed."""
    out = df.withColumn("arrival_time", arrival_clock(clock, duration)) \
            .withColumn("duration_hours", minutes_to_hours(duration))
    if departure_ts is not None:
        out = out.withColumn("arrival_ts", add_minutes(departure_ts, duration))
    return out


def arrival_time_compat(df: DataFrame, clock: str = "time", duration: str = "duration") -> DataFrame:
    """Adds ``arrival_time_compat`` computed with the original carry rule."""
    return df.withColumn("arrival_time_compat", arrival_clock_compat(clock, duration))


def flight_dedup(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows (A8): a partial + final aggregate on the row (or ``subset``)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  descending: bool = False) -> DataFrame:
    """First row per key in ``order`` (ascending, or ``descending``), NULLs last.

    The columns not named in ``order`` settle ties, so the choice is unique up to equal
    rows. The input is read once: ``row_number() <= 1`` is limited before its exchange, so
    at most one row per key and input partition shuffles, whatever the key's size.
    """
    keys, order = list(keys), list(order)
    direction = (lambda c: F.col(c).desc_nulls_last()) if descending else (lambda c: F.col(c).asc_nulls_last())
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[direction(c) for c in [*order, *rest]])
    return (df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= 1)
              .drop("_n").select(*keys, *[c for c in df.columns if c not in keys]))
