"""Exact substring de-duplication with a hash-compared suffix sort.

Removed is every byte under a ``width``-byte string that starts at more than one place of the
corpus. Sorting every suffix of 100 TB is out of reach, so places are first paired up by
anchors, which depend on content alone:

1. Every ``width``-byte window has an anchor: its ``gram``-byte substring of the smallest hash. Equal
   windows have equal anchors at equal offsets, so a repeated window's anchor is repeated
   too. One anchor serves a run of windows, a *segment* of at most ``2 * width - gram`` bytes. A
   row per segment (hash of the anchor, digest of the segment) is all that is shuffled. Equal segments
   that follow each other, as in rules, padding and other periodic text, are compared by their bytes
   and are one row with a count.
2. Anchors that occur once go. Segments of one anchor with the same digest are a class, and all windows
   of a class of two or more are repeated. The digest is 128 bits of BLAKE2b under a key drawn for
   the run: equality of bytes, short of breaking the cipher.
3. Classes of one member whose anchor others share are compared byte-wise: their bytes are
   fetched, and the suffixes at their window starts are sorted. The sort is a merge sort in
   whole-array steps within each (anchor, offset); two suffixes are compared by their longest
   common extension, found by binary search over prefix polynomial hashes. The order of all
   neighbours is then verified byte by byte, so the sort is right whatever the hashes did (a
   bucket that is not sorted is counted by its bytes), and neighbours that agree on ``width``
   bytes are marked.
4. An anchor whose different segments hold more than ``max_windows`` windows or ``max_bytes`` is too
   large for one task; its windows are counted by their digests instead, which are pre-aggregated.

Defined results: null or empty text has no bytes and loses none; matches never cross
documents; very long texts are cut into overlapping pieces, which changes no result;
repeated rows repeat each other's windows; rows may share an id, and ids may be null;
an empty table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.bytehash import QuickHash, draw_odd, mix
from waymark.llm.common import blocks, doc_key, land, land_with, parts_for, ship, text_hash, utf8
from waymark.llm.groups import whole_groups

PIECE = 1 << 20
_POS = np.uint64((1 << 23) - 1)  # positions within a piece


def _pieces(col: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, bytes before, bytes, row offsets)``; a long row comes in overlapping pieces."""
    for first, end in blocks(col, PIECE):
        flat, off = utf8(col.slice(first, end - first))
        if len(flat) <= PIECE:
            yield first, 0, flat, off
        else:
            for at in range(0, len(flat) - width + 1, PIECE - width):
                part = flat[at:at + PIECE - 1]
                yield first, at, part, np.array([0, len(part)])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours: prefix and suffix minima of blocks of ``w``."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    table = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def segments(flat: np.ndarray, off: np.ndarray, width: int, gram: int, base: int):
    """``(row, lo, at, n, reps, key)`` of the segments: windows ``lo .. lo + n - 1`` whose anchor is ``lo + at``.

    ``reps``: how many segments with the same bytes stand here, each ``n`` bytes after the one before it.
    """
    none = np.zeros(0, np.int64)
    if len(flat) < width:
        return none, none, none, none, none, none
    sums = QuickHash(flat, base)
    keys = mix(sums.windows(gram))
    low = _sliding_min((keys & ~_POS) | np.arange(len(keys), dtype=np.uint64), width - gram + 1)
    anchor = (low & _POS).astype(np.int64)
    valid = np.zeros(len(anchor) + 1, bool)  # one more: ends the last run
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        if b - a >= width:
            valid[a:b - width + 1] = True
    edge = np.empty(len(anchor) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(anchor[1:], anchor[:-1], out=edge[1:-1])
    edge[1:] |= valid[1:] != valid[:-1]
    cuts = np.flatnonzero(edge)
    lo, n = cuts[:-1], np.diff(cuts)
    lo, n = lo[valid[lo]], n[valid[lo]]
    at = anchor[lo] - lo
    row = np.searchsorted(off, lo, "right") - 1
    key = keys[lo + at]
    whole = sums.of(lo, lo + n - 1 + width)
    more = np.zeros(len(lo), bool)  # the segment before it over again
    more[1:] = ((row[1:] == row[:-1]) & (lo[1:] == lo[:-1] + n[:-1]) & (n[1:] == n[:-1]) & (at[1:] == at[:-1])
                & (key[1:] == key[:-1]) & (whole[1:] == whole[:-1]))
    heads = np.flatnonzero(~more)
    reps = np.diff(np.append(heads, len(lo)))
    for h, r in zip(heads[reps > 1].tolist(), reps[reps > 1].tolist(), strict=True):
        start, step, end = lo[h], n[h], lo[h] + r * n[h] - 1 + width
        if not np.array_equal(flat[start:end - step], flat[start + step:end]):  # hashes collided: as they are
            more[h:h + r] = False
    heads = np.flatnonzero(~more)
    reps = np.diff(np.append(heads, len(lo)))
    return row[heads], (lo - off[row])[heads], at[heads], n[heads], reps, key[heads].view(np.int64)


class SuffixSorter:
    """Sorts suffixes of one byte array, compared on ``width`` bytes by prefix hashes."""

    def __init__(self, flat: np.ndarray, width: int, base: int):
        self.flat, self.width, self.sums = flat, width, QuickHash(flat, base)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at ``a`` and ``b``, up to ``width``."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.width)
        same = self.sums.of(a, a + self.width) == self.sums.of(b, b + self.width)
        low[same] = self.width
        open_ = np.flatnonzero(~same)
        high[open_] -= 1
        for _ in range(self.width.bit_length()):
            open_ = open_[low[open_] < high[open_]]
            if not len(open_):
                break
            mid = (low[open_] + high[open_] + 1) >> 1
            x, y = a[open_], b[open_]
            same = self.sums.of(x, x + mid) == self.sums.of(y, y + mid)
            low[open_] = np.where(same, mid, low[open_])
            high[open_] = np.where(same, high[open_], mid - 1)
        return low

    def order(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sign of the comparison of the suffixes at ``a`` and ``b``; 0 if they agree on ``width`` bytes."""
        n = self.common(a, b)
        differ = n < self.width
        k = np.where(differ, n, 0)
        return np.where(differ, np.sign(self.flat[a + k].astype(np.int64) - self.flat[b + k]), 0)

    def sort(self, pos: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Merge sort of ``pos`` within buckets; ``start`` and ``size`` give each element's bucket.

        All pairs of runs are merged at once: an element's place is its own rank plus the
        number of elements of the sibling run before it, found by binary search.
        """
        slot, pos, run = np.arange(len(pos)), pos.copy(), 1
        while run < (size.max() if len(size) else 0):
            rank = slot - start
            pair = rank // (2 * run) * (2 * run)
            is_left = rank - pair < run
            low = np.where(is_left, pair + run, pair)
            high = np.where(is_left, np.minimum(pair + 2 * run, size), pair + run)
            moving = np.flatnonzero((low < size) & (pair + run < size))
            low, high, left = low[moving], high[moving], is_left[moving]
            base, mine, own = start[moving], pos[moving], rank[moving] - pair[moving]
            first = low.copy()
            while True:
                todo = np.flatnonzero(low < high)
                if not len(todo):
                    break
                mid = (low[todo] + high[todo]) >> 1
                sign = self.order(pos[base[todo] + mid], mine[todo])
                before = np.where(left[todo], sign < 0, sign <= 0)
                low[todo] = np.where(before, mid + 1, low[todo])
                high[todo] = np.where(before, high[todo], mid)
            out = pos.copy()
            out[base + pair[moving] + np.where(left, own, own - run) + low - first] = mine
            pos, run = out, run * 2
        return pos

    def verified(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By the bytes themselves: whether the suffixes at ``a`` and ``b`` agree on ``width`` bytes, and whether ``a``'s
        does not come after ``b``'s."""
        view = np.lib.stride_tricks.sliding_window_view(self.flat, self.width)
        same, in_order = np.empty(len(a), bool), np.empty(len(a), bool)
        for at in range(0, len(a), 2048):
            x, y = view[a[at:at + 2048]], view[b[at:at + 2048]]
            differ = x != y
            first = differ.argmax(axis=1)
            row = np.arange(len(x))
            same[at:at + 2048] = ~differ[row, first]
            in_order[at:at + 2048] = x[row, first] <= y[row, first]
        return same, in_order


def repeated_windows(flat: np.ndarray, off: np.ndarray, at: np.ndarray, n: np.ndarray, key: np.ndarray,
                     width: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """``(segment, window)`` of each window that stands in another segment of its key too."""
    seg = np.repeat(np.arange(len(n)), n)
    window = np.arange(len(seg)) - np.repeat(np.cumsum(n) - n, n)
    pos = off[seg] + window
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
    bucket = group[seg] * width + (at[seg] - window)
    by = np.argsort(bucket, kind="stable")
    bucket, pos, at_pos = bucket[by], pos[by], np.empty(int(off[-1]), np.int64)
    at_pos[pos] = by
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.concatenate([heads, [len(bucket)]]))
    many = np.repeat(sizes > 1, sizes)  # a window alone at its offset is compared with nothing
    pos, bucket = pos[many], bucket[many]
    sizes = sizes[sizes > 1]
    heads = np.cumsum(sizes) - sizes
    sorter = SuffixSorter(flat, width, base)
    unsorted, pos = pos, sorter.sort(pos, np.repeat(heads, sizes), np.repeat(sizes, sizes))
    there = np.zeros(len(flat), bool)
    there[pos] = True
    lost = np.isin(bucket, bucket[~there[unsorted]])  # colliding hashes can make an order in which a merge loses places
    pos[lost] = unsorted[lost]
    near = np.flatnonzero(bucket[1:] == bucket[:-1])
    same, in_order = sorter.verified(pos[near], pos[near + 1])
    marked = np.zeros(len(pos), bool)
    marked[near[same]] = marked[near[same] + 1] = True
    wrong = np.concatenate([bucket[near[~in_order]], bucket[lost]])
    for b in np.unique(wrong).tolist():  # not sorted, as hashes collided: that bucket by its bytes
        mine = np.flatnonzero(bucket == b)
        texts = [flat[p:p + width].tobytes() for p in pos[mine].tolist()]
        counts: dict[bytes, int] = {}
        for x in texts:
            counts[x] = counts.get(x, 0) + 1
        marked[mine] = [counts[x] > 1 for x in texts]
    hit = at_pos[pos[marked]]
    return seg[hit], window[hit]


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as sorted maximal runs."""
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate(end[by])
    first = np.concatenate([[True], start[1:] > end[:-1]])
    last = np.concatenate([first[1:], [True]])
    return start[first], end[last]


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 400,
                    gram: int = 128, max_windows: int = 1 << 20, max_bytes: int = 8 << 20) -> DataFrame:
    """``(doc, start, end)``: byte ranges that cover the repeated ``width``-byte strings of each document.

    ``max_windows`` and ``max_bytes``: what the different segments of one anchor may hold to be sorted in one task.
    """
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("th"),
                        F.col(text_col).alias("text"))
    id_type = plain.schema["id"].dataType.simpleString()
    base, secret = draw_odd(), secrets.token_bytes(32)

    def anchor(batches):
        for batch in batches:
            for first, before, flat, off in _pieces(batch.column(2), width):
                row, lo, at, n, reps, key = segments(flat, off, width, gram, base)
                if len(row):
                    begin, view = off[row] + lo, memoryview(flat)
                    digests = b"".join([blake2b(view[a:b], digest_size=16, key=secret).digest()
                                        for a, b in zip(begin.tolist(), (begin + n - 1 + width).tolist(), strict=True)])
                    prints, rows = np.frombuffer(digests, np.int64), pa.array(row + first)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(key), pa.array(prints[::2]),
                         pa.array(prints[1::2]), *[pa.array(x.astype(np.int32)) for x in (lo + before, at, n, reps)]],
                        names=["id", "th", "key", "p1", "p2", "lo", "at", "n", "reps"])

    layout = "lo int, at int, n int"
    anchors = land(plain.mapInArrow(anchor, f"id {id_type}, th long, key long, p1 long, p2 long, {layout}, reps int"),
                   "anchors")
    copies = F.sum("reps").alias("copies")
    keys = land(anchors.groupBy("key").agg(copies).filter(F.col("copies") > 1).select("key"), "keys")
    repeated = land(anchors.join(keys, "key")
                    .select(F.struct("id", "th").alias("doc"), "key", "p1", "p2", "lo", "at", "n", "reps"),
                    "repeated_anchors")
    classes = land(repeated.groupBy("key", "p1", "p2").agg(copies, F.first(F.struct("doc", "lo", "at", "n")).alias("pick")),
                   "segment_classes")
    whole = (repeated.join(classes.filter(F.col("copies") > 1).select("key", "p1", "p2"), ["key", "p1", "p2"])
             .select("doc", F.col("lo").alias("start"),
                     (F.col("lo") + F.col("reps") * F.col("n") - 1 + width).alias("end")))

    mixed = land(classes.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum(F.when(F.col("copies") == 1, 1))
                                            .alias("single"), F.sum("pick.n").alias("windows"))
                 .filter((F.col("m") > 1) & F.col("single").isNotNull())
                 .select("key", ((F.col("windows") > max_windows) | (F.col("windows") + F.col("m") * width > max_bytes))
                         .alias("hot")), "mixed_keys")
    wanted = (classes.join(mixed, "key")
              .select(F.col("pick.doc").alias("doc"),
                      F.struct("key", F.col("pick.lo").alias("lo"), F.col("pick.at").alias("at"),
                               F.col("pick.n").alias("n"), (F.col("copies") == 1).alias("single"), "hot").alias("seg"))
              .groupBy("doc").agg(F.collect_list("seg").alias("segs")))  # bounded by the document's length
    texts = docs.select(doc_key(id_col, text_col), F.col(text_col).alias("text"))

    def fetch(batches):
        for batch in batches:
            data = batch.column(2).cast(pa.binary()).to_pylist()
            out: dict[str, list] = {c: [] for c in ("row", "key", "lo", "at", "n", "single", "hot", "seg")}
            for i, segs in enumerate(batch.column(3).to_pylist()):
                for s in segs:
                    out["row"].append(i)
                    out["seg"].append(data[i][s["lo"]:s["lo"] + s["n"] - 1 + width])
                    for c in ("key", "lo", "at", "n", "single", "hot"):
                        out[c].append(s[c])
            rows = pa.array(out.pop("row"), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(out["key"], pa.int64()),
                 *[pa.array(out[c], pa.int32()) for c in ("lo", "at", "n")], pa.array(out["single"], pa.bool_()),
                 pa.array(out["hot"], pa.bool_()), pa.array(out["seg"], pa.binary())],
                names=["id", "th", "key", "lo", "at", "n", "single", "hot", "seg"])

    segs, seen = land_with(
        texts.join(wanted, "doc").select("doc.id", "doc.th", "text", "segs")
        .mapInArrow(fetch, f"id {id_type}, th long, key long, {layout}, single boolean, hot boolean, seg binary"),
        "segments", n=F.count(F.lit(1)), hot=F.count(F.when(F.col("hot"), 1)))

    def sort(batches):
        for table in whole_groups(batches, "key", 2048):
            flat, off = utf8(table.column("seg"))
            at, n, lo = (table.column(c).to_numpy().astype(np.int64) for c in ("at", "n", "lo"))
            seg, window = repeated_windows(flat, off, at, n, table.column("key").to_numpy(), width, base)
            single = table.column("single").to_numpy(zero_copy_only=False)
            keep = single[seg]  # the others are whole classes already
            start = np.unique(seg[keep] * (4 * width) + window[keep])
            if len(start):
                seg, window = start // (4 * width), start % (4 * width)
                first = np.concatenate([[True], np.diff(start) != 1])
                last = np.concatenate([first[1:], [True]])
                rows = pa.array(seg[first])
                begin = lo[seg[first]] + window[first]
                yield pa.RecordBatch.from_arrays(
                    [table.column("id").combine_chunks().take(rows), table.column("th").combine_chunks().take(rows),
                     pa.array(begin.astype(np.int32)),
                     pa.array((lo[seg[last]] + window[last] + width).astype(np.int32))],
                    names=["id", "th", "start", "end"])

    n_parts = parts_for(seen["n"], 50_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = (segs.filter(~F.col("hot")).repartition(n_parts, "key").sortWithinPartitions("key")
             .mapInArrow(sort, f"id {id_type}, th long, start int, end int")
             .select(F.struct("id", "th").alias("doc"), "start", "end"))
    ranges = whole.unionByName(parts)
    if seen["hot"]:
        def windows(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    seg, n = memoryview(batch.column(8)[i].as_py()), batch.column(5)[i].as_py()
                    digests = [blake2b(seg[j:j + width], digest_size=16, key=secret).digest() for j in range(n)]
                    rows = pa.array(np.full(n, i))
                    start = np.arange(n, dtype=np.int32) + np.int32(batch.column(3)[i].as_py())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(rows), batch.column(1).take(rows), batch.column(6).take(rows),
                         pa.array(start), pa.array(digests, pa.binary())],
                        names=["id", "th", "single", "start", "digest"])

        every = land(segs.filter("hot").mapInArrow(
            windows, f"id {id_type}, th long, single boolean, start int, digest binary"), "hot_windows")
        twice = land(every.groupBy("digest").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
                     .select("digest"), "hot_repeats")
        ranges = ranges.unionByName(every.filter("single").join(twice, "digest").select(
            F.struct("id", "th").alias("doc"), "start", (F.col("start") + width).alias("end")))
    return ranges


def remove_ranges(docs: DataFrame, ranges: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, spans, kept)``: maximal removed runs and the remaining bytes of every row."""
    ship(docs.sparkSession)
    per_doc = ranges.groupBy("doc").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    texts = docs.select(doc_key(id_col, text_col), F.col(text_col).alias("text"))
    joined = texts.join(per_doc, "doc", "left").select("doc.id", "text", "starts", "ends")
    id_type = joined.schema["id"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            data = batch.column(1).cast(pa.binary())
            sizes, spans, kept = [], [], []
            for text, starts, ends in zip(data, batch.column(2), batch.column(3), strict=True):
                raw = text.as_py() or b""
                sizes.append(len(raw))
                if not starts.is_valid:
                    spans.append([])
                    kept.append(raw)
                    continue
                a, b = _merged(starts.values.to_numpy().astype(np.int64), ends.values.to_numpy().astype(np.int64))
                spans.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
                view = memoryview(raw)
                kept.append(b"".join(view[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(cut, f"id {id_type}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
                             ).withColumnRenamed("id", id_col)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Ranges found and removed: ``(id, n_bytes, spans, kept)``."""
    return remove_ranges(docs, repeated_ranges(docs, id_col, text_col, **options), id_col, text_col)
