"""N-gram Jaccard join with a token-group matrix.

1. Each text becomes its set of word-shingle hashes; equal sets are one class.
2. Similar classes are partitioned into groups: banded min-hashes bring together any two
   sets at the threshold (see ``miss``), and every class goes to the smallest class it
   shares a band with.
3. A group is opened in one task. There the token-group matrix keeps, for each subgroup of
   already linked classes, the union of its tokens; a query's overlap with the union bounds
   its overlap with every member, and only subgroups whose bound reaches the threshold are
   opened and compared exactly. Links become components.
4. Bands that still join different components meet once more: their classes are dealt to
   tasks of bounded size, large ones as pairs of blocks, so that every pair that shares a
   band and is not yet connected is compared.

Only texts of classes that share a band travel. No pair of a group is emitted: a task
returns at most one edge per class it was given.

Words are told apart by a hash whose bases are drawn for each run, and those of one task, which is
where sets are compared, by their bytes: should two words of a task share a hash, the job stops.

``miss``: two sets at similarity 0.85 agree in a band of 5 min-hashes with probability
0.85**5 and so share none of 45 bands with probability below 4e-12; links are exact.

Defined results: null, empty or wordless text has an empty set and links with nothing;
very long texts are hashed in pieces and kept whole; repeated rows are one class, and each
gets its row; rows may share an id; a null id never names a component unless all its
ids are null; an empty table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.bytehash import Bases, draw_bases, mix
from waymark.llm.common import doc_key, land, land_with, parts_for, ship, text_hash
from waymark.llm.components import connected_components
from waymark.llm.groups import grouped
from waymark.llm.words import column_words

# fixed: what separates words
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _row_shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one row's word hashes."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    take = min(width, n)
    acc = np.full(n - take + 1, np.uint64(take))
    for j in range(take):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + words[j:n - take + 1 + j]
    return np.unique(mix(acc))


def shingle_sets(col: pa.Array, width: int, bases: Bases, compare: bool = False) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a column, in row order.

    ``compare``: words of one hash are compared by their bytes, over the whole column.
    """
    for _, _, hashes, counts in column_words(col, _SPACE, bases, {} if compare else None):
        at = np.concatenate([[0], np.cumsum(counts)])
        for i in range(len(counts)):
            yield _row_shingles(hashes[at[i]:at[i + 1]], width)


def _min_hashes(tokens: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    x = (tokens >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        part = x[at:at + 2048, None] * factors
        part += shifts
        np.minimum(low, part.min(axis=0), out=low)
    return low


def _signatures(docs: DataFrame, width: int, bands: int, rows: int, bases: Bases) -> DataFrame:
    """``(id, th, n_shingles, cls, sigs)``: size and class of each set and its band signatures."""

    def sign(batches):
        rng = np.random.default_rng([7, *bases])
        factors = rng.integers(0, 1 << 31, bands * rows, np.uint32) * np.uint32(2) + np.uint32(1)
        shifts = rng.integers(0, 1 << 32, bands * rows, np.uint32)
        weights = rng.integers(0, 1 << 62, rows, np.uint64) * np.uint64(2) + np.uint64(1)
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            sizes, classes, sigs = [], [], []
            for tokens in shingle_sets(batch.column(2), width, bases):
                sizes.append(len(tokens))
                classes.append(xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None)
                if len(tokens):
                    mins = _min_hashes(tokens, factors, shifts).reshape(bands, rows).astype(np.uint64)
                    sigs.append(mix((mins * weights).sum(axis=1, dtype=np.uint64) + salt).view(np.int64))
                else:
                    sigs.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(sigs, pa.list_(pa.int64()))], names=["id", "th", "n_shingles", "cls", "sigs"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(sign, f"id {kind}, th long, n_shingles long, cls binary, sigs array<long>")


class TokenGroups:
    """The token-group matrix of one task: which subgroups' token unions hold a token."""

    def __init__(self, percent: int):
        self.percent = percent
        self.columns: dict[int, set[int]] = {}
        self.members: list[list[tuple[bytes, np.ndarray]]] = []
        self.known: list[set[bytes]] = []

    def add(self, name: bytes, tokens: np.ndarray, component: bytes | None = None) -> None:
        """Join a query to every subgroup that holds a partner, or a class already known to be connected."""
        overlap: dict[int, int] = {}
        for t in tokens.tolist():
            for g in self.columns.get(t, ()):
                overlap[g] = overlap.get(g, 0) + 1
        met = [g for g, shared in overlap.items()
               # |query & member| <= |query & union|, and a link needs that share of the query at least
               if component in self.known[g] or 100 * shared >= self.percent * len(tokens)
               and any(self._linked(tokens, other) for _, other in reversed(self.members[g]))]
        if not met:
            met = [len(self.members)]
            self.members.append([])
            self.known.append(set())
        home, *others = sorted(met, key=lambda g: -len(self.members[g]))
        for g in others:  # one subgroup from now on
            for x, other in self.members[g]:
                self._hold(home, other, drop=g)
                self.members[home].append((x, other))
            self.known[home] |= self.known[g]
            self.members[g], self.known[g] = [], set()
        self._hold(home, tokens)
        self.members[home].append((name, tokens))
        if component is not None:
            self.known[home].add(component)

    def _hold(self, g: int, tokens: np.ndarray, drop: int | None = None) -> None:
        for t in tokens.tolist():
            held = self.columns.setdefault(t, set())
            held.discard(drop)
            held.add(g)

    def _linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        small, large = sorted((len(a), len(b)))
        if 100 * small < self.percent * large:
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= self.percent * (small + large - both)

    def edges(self) -> Iterator[tuple[bytes, bytes]]:
        for group in filter(None, self.members):
            first = min(x for x, _ in group)
            yield from ((x, first) for x, _ in group if x != first)


def _open_groups(delivered: DataFrame, percent: int, width: int, n_parts: int, bases: Bases) -> DataFrame:
    """Edges ``(a, b)`` found within each group of ``(grp, cls, comp, text)``."""

    def open_all(batches):
        for table in grouped(batches, "grp"):
            names, comps = table.column("cls").to_pylist(), table.column("comp").to_pylist()
            sets = list(shingle_sets(table.column("text").combine_chunks(), width, bases, compare=True))
            matrix, seen = TokenGroups(percent), set()
            for i in sorted(range(len(names)), key=lambda i: (comps[i] or b"", len(sets[i]), names[i])):
                if names[i] not in seen:
                    seen.add(names[i])
                    matrix.add(names[i], sets[i], comps[i])
            found = list(matrix.edges())
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return (delivered.repartition(n_parts, "grp").sortWithinPartitions("grp")
            .mapInArrow(open_all, "a binary, b binary"))


def _with_text(members: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """``(grp, cls, comp, text)`` of ``(grp, cls, comp)``: the text of each class's picked document."""
    return (members.join(classes.select("cls", "pick"), "cls")
            .join(texts, F.col("pick") == F.col("doc")).select("grp", "cls", "comp", "text"))


def _block(col: str, n: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), col), n)


def _components(docs: DataFrame, id_col: str, text_col: str, percent: int, width: int, bands: int, rows: int,
                block: int) -> DataFrame:
    """``(id, th, n_shingles, component, component_id)`` of every row; ``component`` is null for empty sets."""
    ship(docs.sparkSession)
    key = doc_key(id_col, text_col)
    plain = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("th"),
                        F.col(text_col).alias("text"))
    texts = docs.select(key, F.col(text_col).alias("text"))
    bases = draw_bases()
    sets = land(_signatures(plain, width, bands, rows, bases), "shingle_sets")
    classes = land(sets.filter(F.col("cls").isNotNull()).groupBy("cls")
                   .agg(F.min(F.struct("id", "th")).alias("pick"), F.first("sigs").alias("sigs")), "classes")
    in_band = classes.select("cls", F.explode("sigs").alias("sig"))
    leaders = land(in_band.groupBy("sig").agg(F.min("cls").alias("leader"), F.count(F.lit(1)).alias("n"))
                   .filter(F.col("n") > 1).select("sig", "leader"), "band_leaders")
    shared = land(in_band.join(leaders, "sig"), "shared_bands")

    # every class in the group of the smallest class it shares a band with, and that class in its own
    first = land(shared.groupBy("cls").agg(F.min("leader").alias("leader")), "first_leaders")
    # landed, so that both sides of the join are plain shuffles and a large group's can be split
    sizes = land(first.groupBy("leader").agg(F.count(F.lit(1)).alias("n")), "group_sizes")
    subs = F.ceil(F.col("n") / block).cast("int")
    homes, seen = land_with(
        first.join(sizes, "leader")
        .select("cls", "leader", subs.alias("subs"), F.xxhash64("leader", _block("cls", subs)).alias("grp")),
        "homes", n=F.count(F.lit(1)))
    own = (homes.select("leader", "subs").distinct()
           .select(F.col("leader").alias("cls"), F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"))
           .select("cls", F.xxhash64("cls", F.col("sub").cast("long")).alias("grp")))
    n_parts = parts_for(seen["n"], 2048, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    members = homes.select("grp", "cls").unionByName(own).distinct().withColumn("comp", F.lit(None).cast("binary"))
    edges = land(_open_groups(_with_text(members, classes, texts), percent, width, n_parts, bases), "links")
    found = land(connected_components(edges), "components")

    # bands that join components which no task has compared
    at = (homes.select("cls", "grp").join(found.withColumnRenamed("node", "cls"), "cls", "left")
          .select("cls", "grp", F.coalesce("component", "cls").alias("comp")))
    placed = shared.select("sig", "cls").join(at, "cls")
    apart = (placed.groupBy("sig").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.min("grp").alias("g1"),
                                       F.max("grp").alias("g2"), F.min("cls").alias("leader"))
             .filter((F.col("c1") != F.col("c2")) & (F.col("g1") != F.col("g2"))).select("sig", "leader"))
    open_rows, left = land_with(placed.join(land(apart, "open_bands"), "sig").select("leader", "cls", "comp").distinct(),
                                "open_rows", n=F.count(F.lit(1)))
    if left["n"]:
        per = land(open_rows.groupBy("leader").agg(F.count(F.lit(1)).alias("n")), "open_sizes")
        k = F.when(F.col("n") > block, F.ceil(F.col("n") / (block // 2))).otherwise(1).cast("int")
        mine, other = _block("cls", F.col("k")), F.col("other").cast("long")
        dealt = (open_rows.join(per, "leader").withColumn("k", k)
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
                 .select("cls", "comp", F.xxhash64("leader", F.least(mine, other), F.greatest(mine, other))
                         .alias("grp")).distinct())
        more = land(_open_groups(_with_text(dealt, classes, texts), percent, width, n_parts, bases), "links")
        found = land(connected_components(edges.unionByName(more)), "components")

    named = sets.select("id", "th", "n_shingles", "cls").join(found.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.withColumn("component", F.coalesce("component", "cls"))
    low = land(named.filter(F.col("component").isNotNull()).groupBy("component")
               .agg(F.min("id").alias("component_id")), "component_ids")
    return (named.join(low, "component", "left")
            .select("id", "th", "n_shingles", "component",
                    F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 85,
                       width: int = 4, bands: int = 45, rows: int = 5, block: int = 256) -> DataFrame:
    """``(id, n_shingles, component_id)`` of every row.

    Rows link when 100 * intersection >= ``percent`` * union of their ``width``-word shingles;
    ``block`` is how many classes one task compares at most with as many others.
    """
    return _components(docs, id_col, text_col, percent, width, bands, rows, block).select(
        F.col("id").alias(id_col), "n_shingles", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 85, width: int = 4,
             bands: int = 45, rows: int = 5, block: int = 256) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id (a null id comes last),
    and every row without words. Rows equal in id and text are one document."""
    found = _components(docs, id_col, text_col, percent, width, bands, rows, block)
    doc = F.struct("id", "th").alias("doc")
    first = (found.filter(F.col("component").isNotNull()).groupBy("component")
             .agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "th")).alias("first")))
    stay = (first.select(F.struct("first.id", "first.th").alias("doc"))
            .unionByName(found.filter(F.col("component").isNull()).select(doc)).distinct())
    return (docs.select(F.struct("*").alias("row"), doc_key(id_col, text_col)).join(stay, "doc")
            .dropDuplicates(["doc"]).select("row.*"))
