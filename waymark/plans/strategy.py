"""Join-side sizing.

A side is broadcast only after its size has been proven: it is written once as
a parquet table under ``spark.checkpoint.dir`` (shared storage on a cluster;
this also cuts lineage, so a lost executor never recomputes the aggregate), its
row count and the lengths of its values are observed while it is written, and only a
side whose measured size fits the budget gets the broadcast hint.
A larger side is returned unhinted, so the planner shuffles both sides (sort
merge join, with AQE's skew-join splitting for hot keys).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.session import scratch_path

DEFAULT_BROADCAST_BYTES = 10 * 1024 * 1024

_SIZE_UNITS = {"": 1, "b": 1, "k": 1024, "kb": 1024, "m": 1024 ** 2, "mb": 1024 ** 2,
               "g": 1024 ** 3, "gb": 1024 ** 3, "t": 1024 ** 4, "tb": 1024 ** 4}


def _parse_bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m:
        return DEFAULT_BROADCAST_BYTES
    return int(m.group(1)) * _SIZE_UNITS.get(m.group(2).lower(), 1)


def broadcast_budget(spark: SparkSession) -> int:
    """Bytes a broadcast side may take: ``waymark.broadcast.maxBytes`` or Spark's threshold."""
    own = spark.conf.get("waymark.broadcast.maxBytes", None)
    if own:
        return _parse_bytes(own)
    return _parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))


def _text_bytes(col: Column, dtype: T.DataType) -> Column | None:
    """Bytes of a value's variable-length part (None for fixed-width types)."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.octet_length(col)
    if isinstance(dtype, T.DecimalType):
        return None if dtype.precision <= 18 else F.lit(16)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        # its JSON text, four times over: a generous stand-in for words of eight bytes
        return F.octet_length(F.to_json(F.struct(col))) * 4
    return None


def fixed_row_bytes(schema: T.StructType) -> int:
    """Fixed part of one row in a broadcast hash relation: null bits and one 8-byte slot per
    field, padding of each variable-length value, and 16 bytes of hash-table entry."""
    n = len(schema.fields)
    padded = sum(_text_bytes(F.lit(None), f.dataType) is not None for f in schema.fields)
    return 8 * ((n + 63) // 64) + 8 * n + 8 * padded + 16


def materialize_with_stats(df: DataFrame, name: str = "side",
                           **stats: Column) -> tuple[DataFrame, dict[str, object]]:
    """Write ``df`` once as parquet under the shared checkpoint root and read it back.

    Returns the read-back frame and aggregate ``stats`` observed during the same
    write, so measuring costs no extra pass. Always included: ``rows``, and ``bytes``, the
    table's size as a broadcast relation from the measured lengths of its values.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    seen = Observation(f"stats_{name}")
    lengths = [_text_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    text = F.lit(0)
    for length in lengths:
        if length is not None:
            text = text + F.coalesce(length, F.lit(0))
    exprs = [F.count(F.lit(1)).alias("rows"), F.sum(text.cast("long")).alias("text_bytes")]
    exprs += [c.alias(k) for k, c in stats.items()]
    df.observe(seen, *exprs).write.mode("overwrite").parquet(path)
    found = dict(seen.get)
    found["bytes"] = int(found["rows"]) * fixed_row_bytes(df.schema) + int(found.pop("text_bytes") or 0)
    return spark.read.schema(df.schema).parquet(path), found  # known schema: no inference


def materialize(df: DataFrame, name: str = "side") -> tuple[DataFrame, int]:
    """``materialize_with_stats`` returning just the exact row count."""
    side, stats = materialize_with_stats(df, name)
    return side, int(stats["rows"])


def fits_budget(n_bytes: int, max_bytes: int | None, spark: SparkSession) -> bool:
    """Whether a measured size fits the broadcast budget."""
    budget = broadcast_budget(spark) if max_bytes is None else max_bytes
    return budget > 0 and n_bytes <= budget


def bounded_broadcast(df: DataFrame, max_bytes: int | None = None,
                      name: str = "side") -> tuple[DataFrame, bool]:
    """Materialise ``df`` and hint it for broadcast only if its measured size fits ``max_bytes``.

    Returns ``(side, broadcast?)``. The side is always the materialised copy, so
    the caller never recomputes it.
    """
    side, stats = materialize_with_stats(df, name)
    fits = fits_budget(stats["bytes"], max_bytes, df.sparkSession)
    return (F.broadcast(side) if fits else side), fits


DEFAULT_ROWS_PER_TASK = 1_000_000
#: Slots that keys hash to when the hot ones are marked: bounds what ``salted_join`` broadcasts.
HOT_SLOTS = 1 << 16


def rows_per_task(spark: SparkSession) -> int:
    """Target rows of one key per task before the key counts as hot (``waymark.skew.rowsPerTask``)."""
    return int(spark.conf.get("waymark.skew.rowsPerTask", str(DEFAULT_ROWS_PER_TASK)))


def salted_join(big: DataFrame, per_key: DataFrame, keys: list[str], count_col: str,
                how: str = "inner", hot_rows: int | None = None) -> DataFrame:
    """Shuffle join of ``big`` with a one-row-per-key table whose ``count_col`` holds the
    number of ``big`` rows of the key; hot keys are split over salt buckets.

    Keys hash to ``HOT_SLOTS`` slots. A slot with a key of more than ``hot_rows`` rows gets
    ``ceil(n / hot_rows)`` buckets; all rows of its keys pick a bucket by their number in the input
    partition, so copies of a row spread as well as others, and the keys' ``per_key`` rows are
    repeated once per bucket. Only the hot slots are broadcast: at most ``HOT_SLOTS``
    rows of two integers, however many keys are hot, and whatever the session's broadcast
    threshold. The columns are those of a plain join.
    """
    hot_rows = hot_rows or rows_per_task(big.sparkSession)
    slot = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(HOT_SLOTS)).cast("int")
    hot = (per_key.filter(F.col(count_col) > hot_rows)
           .groupBy(slot.alias("_slot")).agg(F.ceil(F.max(count_col) / F.lit(hot_rows)).cast("int").alias("_buckets")))
    hot = F.broadcast(materialize(hot, "hot-slots")[0])
    buckets = F.coalesce(F.col("_buckets"), F.lit(1))
    salted_big = (big.withColumn("_slot", slot).join(hot, "_slot", "left")
                     .withColumn("_salt", F.pmod(F.monotonically_increasing_id(), buckets).cast("int"))
                     .drop("_slot", "_buckets"))
    salted_keys = (per_key.withColumn("_slot", slot).join(hot, "_slot", "left")
                          .withColumn("_salt", F.explode(F.sequence(F.lit(0), buckets - 1)))
                          .drop("_slot", "_buckets"))
    return salted_big.join(salted_keys, [*keys, "_salt"], how).drop("_salt")
