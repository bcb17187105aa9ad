"""Latest import per key (J2/J3, A3/A4, P13) and the half-open date window.

``latest_per_key`` keeps every row whose import time equals its key's maximum
(ties kept, rows with a NULL key or time dropped, as an SQL equi-join does).

Join form (default): a partial + final ``max`` aggregate, then a *semi* join
on (keys, import time). Because the import time is part of the join key, a hot
key's rows hash across many partitions when the aggregate is too large to
broadcast; under the size bound the aggregate is broadcast and nothing but the
aggregate shuffles.

Landed form: the input is written once under the checkpoint root and the join form runs on that
copy, so an input that is more than a bare table scan is computed once, and both of its uses
see the same rows.

Window form: ``rank() = 1`` by import time, limited before its exchange. All rows of a key's
newest import meet in one task, so it suits keys whose imports are small.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.timefn import date_bounds
from waymark.plans.strategy import bounded_broadcast, materialize
from waymark.sources.versions import VersionedTable


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str = "import_date",
                   method: str = "join", broadcast_max_bytes: int | None = None) -> DataFrame:
    keys = list(keys)
    clean = df
    for c in [*keys, ts]:
        clean = clean.filter(F.col(c).isNotNull())
    if method == "window":
        newest = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(ts).desc()))
        return clean.withColumn("_newest", newest).filter(F.col("_newest") == 1).drop("_newest")
    if method == "landed":
        clean, _ = materialize(clean, "latest-input")
    elif method != "join":
        raise ValueError(f"unknown method {method!r}")
    last = clean.groupBy(*keys).agg(F.max(ts).alias(ts))
    side, _ = bounded_broadcast(last, broadcast_max_bytes)
    return clean.join(side, [*keys, ts], "left_semi").select(*df.columns)


def merge_latest(table: VersionedTable, batch: DataFrame, keys: Sequence[str], ts: str = "import_date",
                 batch_id: str | None = None) -> int:
    """Keep ``table`` at each key's newest import as ``batch`` after ``batch`` arrives; returns its version.

    The table holds what ``latest_per_key`` of all batches so far gives. Only the batch's partitions are
    read and written again: no history is scanned. Partition columns must be among the keys. A
    batch whose ``batch_id`` has been merged changes nothing, so it may be delivered twice.
    """
    outside = [c for c in table.partition_by if c not in keys]
    if outside:
        raise ValueError(f"partition columns must be part of the key: {outside}")
    merged = table.note("batches") or []
    if batch_id is not None and batch_id in merged:
        return table.current()
    notes = {"batches": merged + ([batch_id] if batch_id is not None else [])}
    newest = latest_per_key(batch, keys, ts, method="landed")
    if not table.current():
        return table.replace(newest, **notes)
    return table.rewrite(newest, lambda old, new: latest_per_key(old.unionByName(new), keys, ts), **notes)


def date_window(df: DataFrame, column: str, start: str | _dt.date | Column,
                days: int) -> DataFrame:
    """Rows with ``start <= column < start + days`` (whole days; pushed to the scan)."""
    lo, hi = date_bounds(df.schema[column].dataType, start, days)
    return df.filter((F.col(column) >= lo) & (F.col(column) < hi))
