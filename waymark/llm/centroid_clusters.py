"""Clustering of integer vectors around centroids, with exact and incremental distances.

``|v - c|**2 = |v|**2 - 2 * v.c + |c|**2``. Each vector keeps its dot product with every centroid, as
exact 64-bit integers, in a table under the shared folder. When centroids have moved, only the
components that changed are looked at: ``v.c`` grows by ``v[j] * change[j]`` for those ``j``, the new
dot products are written, and the nearest centroid is taken anew from them. The first centroids are
a change from zero. Rounds read and write row by row, without a shuffle; the sums per cluster are
pre-aggregated and come to the driver as one row per centroid, their number being a parameter.

Vectors become integers, ``floor(scale * x)`` with x as double. Centroids start as the ``k`` vectors with
the smallest sha-256 of ``1:<id>``, numbered in that order. A round assigns every vector to the nearest
centroid (the smaller number of equally near ones) and replaces each centroid that has vectors by
the exact floor of their mean; one without stays. Vectors are assigned once more at the end.

Defined results: vectors that are null, of another number of components, or hold null, NaN or
infinite components have no row; with fewer vectors than ``k`` there are as many centroids; equal
vectors are centroids of their own, and all go to the smallest number; rows may share an id (of
equal hashes the componentwise smaller vector is first), and a null id comes after all others; an
empty table gives an empty result; only the id and vector columns are read. Distances are 64-bit:
a component of 2**26 or more in size after scaling is an error, as an overflow is in Spark.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.llm.common import land, ship

LARGEST = 1 << 26


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, size: int, scale: int) -> DataFrame:
    """``(id, vec)``: the usable vectors as arrays of integers."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vec").isNotNull() & (F.size("vec") == size) & ~F.coalesce(bad, F.lit(True))
    too_large = F.raise_error(F.lit(f"a component is {LARGEST} or more after scaling"))
    return (rows.filter(F.coalesce(usable, F.lit(False)))
            .select("id", F.transform("vec", lambda x: F.when(
                F.abs(x) * scale < LARGEST, F.floor(x * scale).cast("int")).otherwise(too_large.cast("int"))).alias("vec")))


def first_centroids(vectors: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of their id: one row each, in that order."""
    by_hash = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    picked = vectors.orderBy(by_hash.asc_nulls_last(), "vec").limit(k).select("vec").collect()
    return np.array([r.vec for r in picked], np.int64)


def _rows(lists: pa.ListArray, width: int) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), width)


def moved(state: DataFrame, change: np.ndarray, norms: np.ndarray) -> DataFrame:
    """``(id, vec, dots, cluster, distance)`` after the centroids have changed by ``change``.

    ``norms``: the centroids' own squared lengths after it. ``state`` without ``dots`` starts from zero.
    """
    k, size = change.shape
    parts = [(c, np.flatnonzero(change[c]), change[c][change[c] != 0]) for c in range(k)]
    fresh = "dots" not in state.columns
    state = state.select("id", "vec", *([] if fresh else ["dots"]))

    def update(batches):
        for batch in batches:
            n = batch.num_rows
            vec = _rows(batch.column(1), size)
            dots = np.zeros((n, k), np.int64) if fresh else _rows(batch.column(2), k)
            for c, where, by in parts:
                if len(where):
                    dots[:, c] += vec[:, where] @ by
            far = norms - 2 * dots  # without the vector's own length, which is the same for every centroid
            cluster = far.argmin(axis=1)  # the first of equal ones
            distance = far[np.arange(n), cluster] + (vec * vec).sum(axis=1)
            spots = pa.array(np.arange(0, (n + 1) * k, k, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(spots, pa.array(dots.ravel())),
                 pa.array(cluster.astype(np.int32)), pa.array(distance)],
                names=["id", "vec", "dots", "cluster", "distance"])

    schema = T.StructType([*state.schema.fields[:2], T.StructField("dots", T.ArrayType(T.LongType())),
                           T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    return state.mapInArrow(update, schema)


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floors of the means of each centroid's vectors; a centroid without vectors stays."""
    size = centroids.shape[1]
    sums = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"),
                                        *[F.sum(F.col("vec")[j].cast("long")).alias(f"s{j}") for j in range(size)])
    out = centroids.copy()
    for row in sums.collect():  # one row per centroid at most
        out[row["cluster"]] = [row[f"s{j}"] // row["n"] for j in range(size)]
    return out


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = 16,
                    size: int = 64, scale: int = 64, rounds: int = 3) -> tuple[DataFrame, np.ndarray]:
    """``(id, vec, dots, cluster, distance)`` of every usable vector, and the final centroids."""
    ship(vectors.sparkSession)
    state = land(integer_vectors(vectors, id_col, vec_col, size, scale), "integer_vectors")
    centroids = first_centroids(state, k)
    if not len(centroids):
        empty = moved(state, np.zeros((1, size), np.int64), np.zeros(1, np.int64))
        return empty.withColumnRenamed("id", id_col), centroids
    change = centroids
    for r in range(rounds + 1):
        state = land(moved(state, change, (centroids * centroids).sum(axis=1)), f"dot_products_{r}")
        if r < rounds:
            change = means(state, centroids) - centroids
            centroids = centroids + change
    return state.withColumnRenamed("id", id_col), centroids


def describe_clusters(clustered: DataFrame, centroids: np.ndarray, id_col: str = "vec_id") -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every row of ``cluster_vectors``."""
    own = clustered.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # one row per centroid at most
    total = sum(r.s for r in own)
    rows = [Row(cluster=r.cluster, cluster_inertia=r.s, inertia=total, centroid_sha256=hashlib.sha256(
        ",".join(map(str, centroids[r.cluster].tolist())).encode()).hexdigest()) for r in own]
    per = clustered.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (clustered.select(id_col, "cluster", "distance").join(F.broadcast(per), "cluster")
            .select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
