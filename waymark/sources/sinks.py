"""Table life cycle (K2-K5): typed create, overwrite, partition overwrite, append, drop, key check.

Writes go to parquet locations the caller names (on a cluster: shared storage).
Declared schemas are enforced on write (``conform``), so a table keeps its
column types whatever frame is written to it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order, cast to the declared types (missing → NULL)."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Replace the whole table (K2). Write to a location no input of ``df`` reads."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``: rerunning a batch is idempotent."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Append as history (keep every import; "latest" is a query, not a rewrite)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str,
                 partition_by: Sequence[str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS … USING parquet`` at ``path`` (K4)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part} LOCATION '{path}'")


def drop_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """``DROP TABLE IF EXISTS`` for each name (K5)."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts (the uniqueness check of K4)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))
