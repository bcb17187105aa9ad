"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens; pieces are dealt to shards of bounded
size, and each shard is evolved on several islands (tasks). An individual is a grouping of the
shard's pieces into bins. Crossover injects whole well-filled bins of one parent into the
other, removes the bins that now hold duplicates, and places the displaced pieces by best
fit; mutation empties the worst-filled bins. After each round every island's elite migrates to the
next one. The best grouping of a shard places its pieces; pieces of bins with room to spare
are dealt anew and evolved again with those of other shards.

What moves is one small row per piece and the elites; nothing is packed on the driver.

Defined results: null or empty text is the closing id alone; documents longer than the capacity
are cut, others never; repeated rows are packed each on their own; rows may share an id;
an empty table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import land, land_with, parts_for, ship
from waymark.llm.tokens import column_tokenizer

PIECE_SCHEMA = "piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocab_path: str | None = None,
                 capacity: int = 2048, closing_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])`` of every piece of every row."""
    import public_tokenizers

    ship(docs.sparkSession)
    vocab_path = vocab_path or public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def cut(batches):
        tokenizer = column_tokenizer(vocab_path)
        for batch in batches:
            row, piece, start, length, crc, all_ids = [], [], [], [], [], []
            for i, ids in enumerate(tokenizer.encode(batch.column(1))):
                ids = np.append(ids, np.uint32(closing_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        all_ids.append(part.astype(np.int32))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(all_ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(cut, f"id {id_type}, {PIECE_SCHEMA}" + ", ids array<int>" * with_ids)


def best_fit(order: list[int], sizes: list[int], free: dict[int, int], capacity: int, next_bin: int) -> dict[int, int]:
    """Place items in the given order, each in the fullest bin with room; returns item → bin.

    Open bins are kept by their free space, and a bit per space says which there are.
    """
    by_space: dict[int, list[int]] = {}
    mask = 0
    for b, space in free.items():
        if space:
            by_space.setdefault(space, []).append(b)
            mask |= 1 << space
    placed = {}
    for item in order:
        size = sizes[item]
        above = mask >> size
        if above:
            space = size + (above & -above).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                mask &= ~(1 << space)
        else:
            space, b, next_bin = capacity, next_bin, next_bin + 1
        placed[item] = b
        if space > size:
            by_space.setdefault(space - size, []).append(b)
            mask |= 1 << space - size
    return placed


class Island:
    """A population of groupings of one shard's pieces."""

    def __init__(self, sizes: np.ndarray, capacity: int, seed: list[int]):
        self.sizes, self.listed, self.capacity = sizes, sizes.tolist(), capacity
        self.rng = np.random.default_rng(seed)
        self.population: list[np.ndarray] = []

    def add(self, grouping: np.ndarray) -> None:
        self.population.append(grouping.astype(np.int64))

    def fresh(self, noise: float) -> None:
        """A grouping by best fit, in decreasing order of slightly disturbed sizes."""
        disturbed = self.sizes * (1 + noise * self.rng.standard_normal(len(self.sizes)))
        placed = best_fit(np.argsort(-disturbed, kind="stable").tolist(), self.listed, {}, self.capacity, 0)
        self.population.append(np.array([placed[i] for i in range(len(self.sizes))], np.int64))

    def fills(self, grouping: np.ndarray) -> np.ndarray:
        return np.bincount(grouping, self.sizes)

    def fitness(self, grouping: np.ndarray) -> tuple[int, float]:
        """Fewer bins first, then fuller ones (the sum of squared fills), smaller is better."""
        fills = self.fills(grouping)
        return int((fills > 0).sum()), -float((fills * fills).sum())

    def _refit(self, grouping: np.ndarray, displaced: np.ndarray) -> np.ndarray:
        """The grouping with the displaced pieces placed by best fit, bins renumbered."""
        order = displaced[np.argsort(-self.sizes[displaced], kind="stable")]
        rest = np.ones(len(grouping), bool)
        rest[displaced] = False
        fills = np.bincount(grouping[rest], self.sizes[rest], minlength=int(grouping.max()) + 1).astype(np.int64)
        bins = np.flatnonzero((fills > 0) & (fills < self.capacity))
        free = dict(zip(bins.tolist(), (self.capacity - fills[bins]).tolist(), strict=True))
        placed = best_fit(order.tolist(), self.listed, free, self.capacity, len(fills))
        out = grouping.copy()
        out[list(placed)] = list(placed.values())
        return np.unique(out, return_inverse=True)[1]

    def crossover(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whole well-filled bins of ``b`` put into ``a``."""
        fills = self.fills(b)
        good = np.flatnonzero(fills >= np.quantile(fills, 0.5))
        chosen = np.zeros(len(fills), bool)
        chosen[good[self.rng.random(len(good)) < 0.3]] = True
        injected = chosen[b]
        hit = np.zeros(int(a.max()) + 1, bool)
        hit[a[injected]] = True
        child = np.where(injected, len(hit) + b, a)
        return self._refit(child, np.flatnonzero(hit[a] & ~injected))

    def mutate(self, a: np.ndarray) -> np.ndarray:
        """The emptiest bins and a few others taken apart."""
        fills = self.fills(a)
        gone = np.zeros(len(fills), bool)
        gone[np.argsort(fills)[:max(1, len(fills) // 50)]] = True
        gone[self.rng.random(len(fills)) < 0.01] = True
        return self._refit(a, np.flatnonzero(gone[a]))

    def evolve(self, generations: int, size: int) -> list[np.ndarray]:
        """The population after some generations, best first."""
        least = -(-int(self.sizes.sum()) // self.capacity)
        ranked = sorted(self.population, key=self.fitness)[:size]
        for _ in range(generations):
            if self.fitness(ranked[0])[0] <= least:
                break  # no grouping has fewer bins
            a, b = self.rng.integers(0, len(ranked), 2)
            children = [self.crossover(ranked[a], ranked[b]), self.crossover(ranked[b], ranked[0]),
                        self.mutate(ranked[int(self.rng.integers(0, len(ranked)))])]
            ranked = sorted([*ranked, *children], key=self.fitness)[:size]
        return ranked


def _evolve_shards(pieces: DataFrame, capacity: int, islands: int, rounds: int, generations: int, size: int) -> DataFrame:
    """Landed ``(shard, island, bins, fit, uids, bin)`` per island: the elite of its last round.

    ``pieces``: (uid, length, shard). ``uids`` and ``bin`` are 64-bit and 32-bit little-endian arrays.
    """
    dealt = pieces.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    out = "shard long, island int, bins long, fit double, uids binary, bin binary"
    names = ["shard", "island", "bins", "fit", "uids", "bin"]

    def step(left: pa.Table, elites: list[np.ndarray], generation: int) -> pa.Table:
        uid, sizes = left.column("uid").to_numpy(), left.column("length").to_numpy()
        by = np.argsort(uid)
        uid, sizes = uid[by], sizes[by].astype(np.int64)
        shard, number = left.column("shard")[0].as_py(), left.column("island")[0].as_py()
        island = Island(sizes, capacity, [shard, number, generation])
        for e in elites:
            island.add(e)
        if not elites:
            island.fresh(0.0)
        island.fresh(0.02 * (1 + number))
        best = island.evolve(generations, size)[0]
        bins, fit = island.fitness(best)
        return pa.table([pa.array([shard], pa.int64()), pa.array([number], pa.int32()), pa.array([bins], pa.int64()),
                         pa.array([fit]), pa.array([uid.astype("<i8").tobytes()], pa.binary()),
                         pa.array([best.astype("<i4").tobytes()], pa.binary())], names=names)

    def meeting(generation: int):
        return lambda left, right: step(left, [np.frombuffer(x, "<i4") for x in right.column("bin").to_pylist()],
                                        generation)

    state = land(dealt.groupBy("shard", "island").applyInArrow(lambda t: step(t, [], 0), out), "islands")
    for r in range(1, rounds):
        # elites move on to the next island of the ring, and stay at home too
        moved = state.withColumn("to", (F.col("island") + 1) % islands).select("shard", F.col("to").alias("island"), "bin")
        elites = state.select("shard", "island", "bin").unionByName(moved).select(
            F.col("shard").alias("e_shard"), F.col("island").alias("e_island"), "bin")

        state = land(dealt.groupBy("shard", "island").cogroup(elites.groupBy("e_shard", "e_island"))
                     .applyInArrow(meeting(r), out), "islands")
    return state


def _places(state: DataFrame, pieces: DataFrame, capacity: int) -> DataFrame:
    """``(uid, shard, bin, offset, fill)`` of the best grouping of each shard."""
    best = (state.groupBy("shard").agg(F.min(F.struct("bins", "fit", "island")).alias("best"))
            .select("shard", F.col("best.island").alias("island")))

    def unfold(batches):
        for batch in batches:
            for shard, uids, bins in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                uid, b = np.frombuffer(uids.as_py(), "<i8"), np.frombuffer(bins.as_py(), "<i4")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(uid), shard.as_py())), pa.array(uid),
                                                  pa.array(b.astype(np.int64))], names=["shard", "uid", "bin"])

    grouping = (state.join(best, ["shard", "island"]).select("shard", "uids", "bin")
                .mapInArrow(unfold, "shard long, uid long, bin long"))
    per_bin = (grouping.join(pieces.select("uid", "length"), "uid").groupBy("shard", "bin")
               .agg(F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("items")))  # a bin's pieces
    ahead = F.transform("items", lambda x, i: F.struct(
        x["uid"].alias("uid"), F.aggregate(F.slice(F.col("items"), 1, i), F.lit(0).cast("long"),
                                           lambda n, y: n + y["length"]).alias("offset")))
    fill = F.aggregate("items", F.lit(0).cast("long"), lambda n, y: n + y["length"])
    return (per_bin.select("shard", "bin", fill.alias("fill"), F.explode(ahead).alias("at"))
            .select("at.uid", "shard", "bin", "at.offset", "fill"))


def pack_pieces(pieces: DataFrame, *, capacity: int = 2048, shard_size: int = 8192, islands: int = 2, rounds: int = 2,
                generations: int = 6, population: int = 5, passes: int = 2, spare: int = 8) -> DataFrame:
    """``pieces`` (any columns, with ``length``) plus ``sequence_id`` and ``offset``.

    ``spare``: bins with more free tokens than this are taken apart and their pieces evolved again with
    those of other shards, ``passes`` - 1 times at most.
    """
    ship(pieces.sparkSession)
    rows, seen = land_with(pieces, "pieces", n=F.count(F.when(F.col("length") < capacity, 1)))
    # a landed table's rows keep their numbers; the number also spreads equal rows
    rows = land(rows.withColumn("uid", F.monotonically_increasing_id()), "numbered_pieces")
    open_ = rows.filter(F.col("length") < capacity).select("uid", "length")
    placed = None
    for p in range(passes):
        shards = parts_for(seen["n"], shard_size)
        dealt = land(open_.withColumn("shard", F.pmod(F.xxhash64(F.lit(p), "uid"), F.lit(shards))), "dealt_pieces")
        places, left = land_with(
            _places(_evolve_shards(dealt, capacity, islands, rounds, generations, population), dealt, capacity),
            "places", n=F.count(F.when(F.col("fill") < capacity - spare, 1)))
        again = p + 1 < passes and shards > 1 and left["n"]
        done = places.filter(F.col("fill") >= capacity - spare) if again else places
        done = done.select("uid", F.struct(F.lit(p).alias("pass"), "shard", "bin").alias("sequence"), "offset")
        placed = done if placed is None else placed.unionByName(done)
        if not again:
            break
        seen = left
        open_ = places.filter(F.col("fill") < capacity - spare).select("uid").join(rows.select("uid", "length"), "uid")
    # full pieces are sequences of their own
    number = (F.shiftleft(F.col("sequence.pass").cast("long"), 58) + F.shiftleft(F.col("sequence.shard"), 20)
              + F.col("sequence.bin"))
    return (rows.join(placed, "uid", "left")
            .withColumn("sequence_id", F.coalesce(number, -1 - F.col("uid")))
            .withColumn("offset", F.coalesce("offset", F.lit(0).cast("long"))).drop("uid", "sequence"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocab_path: str | None = None,
                   capacity: int = 2048, closing_id: int = 0, with_ids: bool = False, **options) -> DataFrame:
    """Pieces and their places: ``(id, piece, start, length, ids_crc32[, ids], sequence_id, offset)``."""
    pieces = token_pieces(docs, id_col, text_col, vocab_path=vocab_path, capacity=capacity, closing_id=closing_id,
                          with_ids=with_ids)
    return pack_pieces(pieces, capacity=capacity, **options).withColumnRenamed("id", id_col)
