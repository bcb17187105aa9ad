"""Table sources: parquet tables by name, views, full and pruned scans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Full scan of one parquet table; column pruning and filters reach the scan lazily."""
    return spark.read.parquet(table_path(base, name))


def register_views(spark: SparkSession, base: str, names: Iterable[str] = DRIVER_TABLES) -> None:
    """Expose tables as temp views so SQL text (``spark.sql``) can query them."""
    for name in names:
        read_table(spark, base, name).createOrReplaceTempView(name)


def scan_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Column-subset scan (the parquet reader only reads these columns)."""
    return df.select(*columns)


def sql_table(spark: SparkSession, text: str, **values) -> DataFrame:
    """Result of SQL text over registered views, as a DataFrame.

    ``values`` fill the text's named markers (``:name``) as literals; they are never put into the text itself.
    """
    return spark.sql(text, args=values)


def jdbc_options(url: str, table: str, *, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower_bound: int | str | None = None, upper_bound: int | str | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Options for a relational table (S5 against a database; credentials come from the caller).

    With ``partition_column`` and bounds the read is split into ``num_partitions``
    parallel range queries instead of one connection pulling the whole table.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            opts[key] = value
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Table from a database through Spark's JDBC source (the driver jar must be on the classpath)."""
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    """Write through Spark's JDBC sink (append keeps history; see ``sinks`` for parquet tables)."""
    df.write.format("jdbc").options(**options).mode(mode).save()
