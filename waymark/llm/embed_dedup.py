"""Near-duplicate vectors by random-hyperplane signs, exact cosines and connected components.

Equal vectors are one class first. Each table cuts space by ``bits`` random hyperplanes; classes
with the same signs in a table share a bucket, where every pair is checked by its cosine
in double precision. ``bits`` grows with the logarithm of the number of classes, so a
bucket of unrelated vectors keeps its size, and the number of tables follows from the
recall asked for at the threshold. A bucket with many classes is dealt out as pairs of
blocks, so no task holds more than two blocks. A pair counts only in the first table whose
bucket it shares. Tasks return one row per class, never the pairs.

Defined results: vectors that are null, empty, zero or hold nulls or non-finite components
link with nothing; vectors of different lengths never link; equal vectors always link;
rows may share an id and each gets its row; a null id names a component only if all its
ids are null; an empty table gives an empty result; only the id and vector columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.bytehash import mix
from waymark.llm.common import land, land_with, parts_for, ship
from waymark.llm.components import connected_components
from waymark.llm.groups import grouped


def tables_for(n: int, threshold: float, recall: float, bucket: int) -> tuple[int, int]:
    """Hyperplanes per table, so that ``n`` unrelated vectors fill buckets of about ``bucket``, and the
    number of tables in which a pair at the threshold meets at least once with probability ``recall``."""
    bits = min(62, max(4, math.ceil(math.log2(max(n, 1) / bucket)) if n > bucket else 4))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - together))


_planes: dict[tuple[int, ...], np.ndarray] = {}


def _hyperplanes(size: int, n: int, seed: int) -> np.ndarray:
    """The worker's hyperplanes for vectors of ``size`` components: the same in every task."""
    key = (size, n, seed)
    if key not in _planes:
        _planes.clear()  # of other runs
        _planes[key] = np.random.default_rng([seed, size]).standard_normal((size, n))
    return _planes[key]


def _signs(x: np.ndarray, bits: int, tables: int, seed: int, first: int | None = None) -> np.ndarray:
    """Signature of each row of ``x`` in each table, or in the ``first`` ones."""
    first = tables if first is None else first
    planes = _hyperplanes(x.shape[1], bits * tables, seed)[:, :bits * first]
    out = np.empty((len(x), first), np.int64)
    weights = np.int64(1) << np.arange(bits, dtype=np.int64)
    for at in range(0, len(x), 4096):
        signs = (x[at:at + 4096] @ planes > 0).reshape(-1, first, bits)
        out[at:at + 4096] = signs @ weights
    return out


def _unit(vectors: list[bytes], kind: type) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position connected to each of ``n`` positions by the pairs ``(a, b)``."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, threshold: float = 0.9,
                    recall: float = 0.9995, bucket: int = 64, block: int = 1024, seed: int = 11) -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every row of ``vectors``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    kind = np.float32 if "float" in rows.schema["vec"].dataType.simpleString() else np.float64
    rows = rows.withColumn("vec", F.col("vec").cast("array<float>" if kind is np.float32 else "array<double>"))
    id_type = rows.schema["id"].dataType.simpleString()
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.col("vec").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda v: v != 0)

    def name(batches):
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + kind(0)  # -0 is 0
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            raw = [flat[at[i]:at[i + 1]].tobytes() for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([xxhash.xxh3_128_digest(x) for x in raw], pa.binary()),
                 pa.array(raw, pa.binary())], names=["id", "cls", "vec"])

    named = land(rows.filter(F.coalesce(usable, F.lit(False))).mapInArrow(name, f"id {id_type}, cls binary, vec binary"),
                 "vectors")
    classes, seen = land_with(named.groupBy("cls").agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies")),
                              "vector_classes", n=F.count(F.lit(1)))
    bits, tables = tables_for(seen["n"], threshold, recall, bucket)

    def sign(batches):
        salt = mix(np.arange(1, tables + 1, dtype=np.uint64))
        for batch in batches:
            raw = batch.column(1).to_pylist()
            keys: list = [None] * len(raw)
            for size in {len(v) for v in raw}:
                mine = [i for i, v in enumerate(raw) if len(v) == size]
                signs = _signs(_unit([raw[i] for i in mine], kind), bits, tables, seed).view(np.uint64)
                for i, k in zip(mine, mix(mix(signs + np.uint64(size)) + salt).view(np.int64), strict=True):
                    keys[i] = k
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["cls", "keys"])

    def check(batches):
        for group in grouped(batches, "grp"):
            t = group.column("t")[0].as_py()
            left = group.column("left").to_numpy()
            copies = group.column("copies").to_numpy()
            raw, names = group.column("vec").to_pylist(), group.column("cls").to_pylist()
            x = _unit(raw, kind)
            across = not left.all()
            a_side = np.flatnonzero(left)
            b_side = np.flatnonzero(~left) if across else a_side
            a, b = np.nonzero(x[a_side] @ x[b_side].T >= threshold)
            a, b = a_side[a], b_side[b]
            if not across:
                a, b = a[a < b], b[a < b]
            if len(a):  # signs of the rows that have a partner, and of no table after this one
                met, place = np.unique(np.concatenate([a, b]), return_inverse=True)
                signs, i, j = _signs(x[met], bits, tables, seed, t + 1), place[:len(a)], place[len(a):]
                now = signs[i, t] == signs[j, t]  # by the signs themselves, not their hash
                for earlier in range(t):
                    now &= signs[i, earlier] != signs[j, earlier]
                a, b = a[now], b[now]
            if len(a):
                links = np.bincount(a, copies[b], len(x)) + np.bincount(b, copies[a], len(x))
                roots = _roots(len(x), a, b)
                met = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in met], pa.binary()), pa.array(links[met].astype(np.int64)),
                     pa.array([names[i] for i in roots[met]], pa.binary())], names=["cls", "links", "root"])

    # buckets without vectors: these join the rows that are not alone in theirs
    placed = land(classes.mapInArrow(sign, "cls binary, keys array<long>")
                  .select("cls", F.posexplode("keys").alias("t", "key")), "buckets")
    sizes = land(placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1), "bucket_sizes")
    k = F.when(F.col("n") > block, F.ceil(F.col("n") / block)).otherwise(1).cast("int")
    mine = F.pmod(F.xxhash64(F.lit(5), "cls"), F.col("k")).cast("int")
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    shared = land(placed.join(sizes, "key"), "shared_buckets")
    dealt = (shared.join(classes, "cls").withColumn("k", k).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
             .select(F.xxhash64("key", low, high).alias("grp"), "t", "cls", "vec", "copies",
                     (F.col("mine") == low).alias("left")))
    n_parts = parts_for(seen["n"] * tables, 200_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = land(dealt.repartition(n_parts, "grp").sortWithinPartitions("grp")
                 .mapInArrow(check, "cls binary, links long, root binary"), "vector_links")
    parts = land(connected_components(found.select(F.col("cls").alias("a"), F.col("root").alias("b"))), "components")
    per_class = (classes.select("cls", "copies").join(found.groupBy("cls").agg(F.sum("links").alias("links")), "cls", "left")
                 .join(parts.withColumnRenamed("node", "cls"), "cls", "left")
                 .select("cls", (F.coalesce("links", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("component", "cls").alias("component")))
    linked = named.select("id", "cls").join(land(per_class, "class_links"), "cls")
    lowest = land(linked.groupBy("component").agg(F.min("id").alias("component_id")), "component_ids")
    alone = rows.filter(~F.coalesce(usable, F.lit(False))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return (linked.join(lowest, "component").select("id", "n_links", "component_id").unionByName(alone)
            .select(F.col("id").alias(id_col), "n_links", "component_id",
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))
