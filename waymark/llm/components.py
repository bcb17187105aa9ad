"""Connected components of a distributed edge list (alternating large-star and small-star).

Every round rewires each node's neighbours to the smallest node it sees; the edges shrink
to one star per component in a number of rounds that grows with the logarithm of the
component's size. Edges stay in tables under the shared folder; the driver sees only a
count and a checksum per round. The minimum per node is pre-aggregated, and joined back as
plain shuffles that AQE can split at a hot node. A round's tables are written by as many tasks as
its edges need, so that many small rounds do not spend their time on empty tasks and files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import land_with, parts_for

PER_TASK = 250_000  # edges


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that has an edge; ``component`` is the smallest node of its own."""
    stats = {"n": F.count(F.lit(1)), "sum": F.bit_xor(F.xxhash64("u", "v"))}
    e, now = land_with(edges.filter(F.col(a) != F.col(b))
                       .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges", **stats)
    partitions = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def land(df: DataFrame, name: str, **observed) -> tuple[DataFrame, dict]:
        tasks = parts_for(now["n"], PER_TASK, 8)
        return land_with(df.coalesce(tasks) if tasks < partitions else df, name, **(observed or {"n": F.count(F.lit(1))}))

    while now["n"]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low, _ = land(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "lows")
        large, _ = land(both.filter(F.col("v") > F.col("u")).join(low, "u")
                     .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large_star")
        low, _ = land(large.groupBy("u").agg(F.min("v").alias("m")), "lows")
        small = (large.join(low, "u").filter(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        before, (e, now) = now, land(small, "edges", **stats)
        if (now["n"], now["sum"]) == (before["n"], before["sum"]):
            break
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
