"""Benchmark decontamination with a distributed positional inverted index.

The index is cut by documents: a shard holds half a million words of them or a little more, and one
row per (shard, term) stores the term's postings, its word positions in the shard. A
benchmark item's windows of ``width`` words are looked up rarest term first: the rarest
term of a window, by its postings over the whole corpus, says which shards the window is sent to.
There the lists are intersected, each shifted by its term's offset, from the rarest term
on; a start that survives all of them is an exact phrase. The few rarest terms of a
window, by the whole corpus and of those it has, that stand close to the rarest in any order
are a proximity match, whatever became of the window's other words. Shards do not matter to either.

Nothing is broadcast by hand: terms, windows and postings meet in joins. A shard's postings of
benchmark terms meet its windows in one task: half a million words or one text of documents, and at
most the benchmark's windows, ten numbers each.

Defined results: null, empty or wordless text has no words and no hits; items without words
have no windows, and items of fewer than ``width`` words are one window; items with a null
id mark words but are not listed; repeated items are listed once; repeated rows each get
their row; very long texts are a shard of their own; empty tables give no rows (documents)
or no hits (benchmark); only the id and text columns of both are read. Words are told apart
by 62 bits of a hash whose bases are drawn for each run: two words of 200 bytes agree with a
probability below 1e-14, and texts cannot be written to collide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.bytehash import Bases, draw_bases
from waymark.llm.common import doc_key, land, ship
from waymark.llm.words import column_words

# fixed: ASCII characters that are no letter or digit separate words
_SEPARATES = np.zeros(256, bool)
_SEPARATES[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
_SEPARATES[65:91] = False  # lower-cased before
SHARD_WORDS = 500_000
_AT = np.uint64(32)  # a posting's key: term number above, position below


def _deltas(positions: np.ndarray, heads: np.ndarray) -> np.ndarray:
    out = np.diff(positions, prepend=0)
    out[heads] = positions[heads]
    return out.astype(np.int32)


def _shards(col: pa.Array, bases: Bases):
    """``(first row, end row, word hashes, words per row)`` of runs of rows with ``SHARD_WORDS`` words or more."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    start = end = 0
    for _, end, words, counts in column_words(col, _SEPARATES, bases):
        held.append((words, counts))
        if sum(len(w) for w, _ in held) >= SHARD_WORDS:
            yield start, end, *map(np.concatenate, zip(*held, strict=True))
            held, start = [], end
    if held:
        yield start, end, *map(np.concatenate, zip(*held, strict=True))


def build_index(docs: DataFrame, bases: Bases, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Landed ``(shard, term, n, postings, ids)``.

    ``bases``: what words are hashed with, here and in ``find_items``. ``postings``: little-endian 32-bit steps between positions. The row with a null term has a
    shard's documents: ``ids`` in order, and their numbers of words as ``postings``.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def index(batches):
        shard = TaskContext.get().partitionId() << 32  # the same in every attempt
        for batch in batches:
            for first, end, words, counts in _shards(batch.column(1), bases):
                by = np.argsort(words, kind="stable")
                terms = words[by]
                heads = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else by
                sizes = np.diff(np.concatenate([heads, [len(terms)]]))
                data = pa.py_buffer(np.concatenate([_deltas(by, heads), counts.astype(np.int32)]).tobytes())
                ends = np.concatenate([heads, [len(terms), len(terms) + len(counts)]]).astype(np.int32) * 4
                postings = pa.Array.from_buffers(pa.binary(), len(heads) + 1, [None, pa.py_buffer(ends.tobytes()), data])
                ids = batch.column(0).slice(first, end - first)
                spots = np.concatenate([np.zeros(len(heads) + 1, np.int32), [len(ids)]]).astype(np.int32)
                term = np.concatenate([terms[heads].view(np.int64), [0]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(term), shard)), pa.array(term, mask=np.arange(len(term)) == len(heads)),
                     pa.array(np.concatenate([sizes, [0]])), postings,
                     pa.ListArray.from_arrays(pa.array(spots), ids)], names=["shard", "term", "n", "postings", "ids"])
                shard += 1

    return land(rows.mapInArrow(index, f"shard long, term long, n long, postings binary, ids array<{id_type}>"),
                "positional_index")


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, width: int, bases: Bases) -> DataFrame:
    """Landed ``(item, nr, terms)``: the windows of every item, in order."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))

    def cut(batches):
        for batch in batches:
            for first, end, words, counts in column_words(batch.column(1), _SEPARATES, bases):
                at = np.concatenate([[0], np.cumsum(counts)])
                item, nr, terms = [], [], []
                for i in range(end - first):
                    own = words[at[i]:at[i + 1]].view(np.int64)
                    n = max(1, len(own) - width + 1) if len(own) else 0
                    item += [first + i] * n
                    nr += range(n)
                    terms += [own[j:j + width] for j in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(item, pa.int64())), pa.array(nr, pa.int64()),
                     pa.array(terms, pa.list_(pa.int64()))], names=["item", "nr", "terms"])

    return land(rows.mapInArrow(cut, "item string, nr long, terms array<long>").distinct(), "windows")


class Shard:
    """One shard's postings of benchmark terms, as sorted (term, position) keys."""

    def __init__(self, terms: np.ndarray, steps: list[bytes], words: np.ndarray):
        self.ends = np.cumsum(words)
        by = np.argsort(terms)
        self.terms = terms[by]
        self.sizes = np.array([len(steps[i]) // 4 for i in by], np.int64)
        self.heads = np.cumsum(self.sizes) - self.sizes
        flat = np.cumsum(np.frombuffer(b"".join(steps[i] for i in by), np.int32), dtype=np.int64)
        before = np.concatenate([[0], flat])[self.heads]
        self.positions = flat - np.repeat(before, self.sizes)
        numbers = np.repeat(np.arange(len(self.terms), dtype=np.uint64), self.sizes)
        self.keys = (numbers << _AT) | self.positions.astype(np.uint64)

    def numbers(self, terms: np.ndarray) -> np.ndarray:
        """Term numbers; -1 where the shard has no such term."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def holds(self, number: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = (number.astype(np.uint64) << _AT) | position.astype(np.uint64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return self.keys[at] == key

    def starts(self, rarest: np.ndarray):
        """``(window, position)`` of the postings of each window's term in ``rarest``, in bounded chunks."""
        total = np.cumsum(self.sizes[rarest])
        at = 0
        while at < len(rarest):
            done = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, done + (1 << 20), "right")))
            window = np.repeat(np.arange(at, end), self.sizes[rarest[at:end]])
            inside = np.arange(len(window)) - np.repeat(total[at:end] - self.sizes[rarest[at:end]] - done,
                                                        self.sizes[rarest[at:end]])
            yield window, self.positions[self.heads[rarest[window]] + inside]
            at = end

    def phrases(self, numbers: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(window, start)`` of every exact occurrence within one document."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        sizes = np.where(numbers >= 0, self.sizes[numbers], np.iinfo(np.int64).max)
        rarity = np.argsort(sizes, axis=1, kind="stable")
        for window, position in self.starts(numbers[np.arange(len(numbers)), rarity[:, 0]]):
            start = position - rarity[window, 0]
            end = start + lengths[window]
            doc_end = self.ends[np.minimum(np.searchsorted(self.ends, position, "right"), len(self.ends) - 1)]
            fits = (start >= 0) & (end <= doc_end)
            fits[fits] &= np.searchsorted(self.ends, start[fits], "right") == np.searchsorted(
                self.ends, position[fits], "right")
            window, start = window[fits], start[fits]
            for j in range(1, numbers.shape[1]):  # from the next rarest on
                place = rarity[window, j]
                more = place < lengths[window]
                more[more] = ~self.holds(numbers[window[more], place[more]], start[more] + place[more])
                window, start = window[~more], start[~more]
            found.append((window, start))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def near(self, numbers: np.ndarray, lengths: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """``(window, position)`` of the first word where all words stand within ``slop`` words of it in a document."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for window, position in self.starts(numbers[:, 0]):
            for j in range(1, numbers.shape[1]):
                number = numbers[window, np.minimum(j, lengths[window] - 1)]
                doc = np.searchsorted(self.ends, position, "right")
                low = np.maximum(position - slop, np.where(doc > 0, self.ends[doc - 1], 0))
                high = np.minimum(position + slop, self.ends[doc] - 1)
                key = number.astype(np.uint64) << _AT
                ok = (j >= lengths[window]) | (
                    np.searchsorted(self.keys, key | low.astype(np.uint64))
                    < np.searchsorted(self.keys, key | high.astype(np.uint64), "right"))
                window, position = window[ok], position[ok]
            found.append((window, position))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _per_doc(ends: np.ndarray, position: np.ndarray, names: np.ndarray, n_docs: int) -> list[list[str]]:
    """Sorted distinct item names found in each document."""
    out: list[list[str]] = [[] for _ in range(n_docs)]
    doc = np.searchsorted(ends, position, "right")
    for d, name in sorted(set(zip(doc.tolist(), names.tolist(), strict=True)), key=lambda x: (x[0], x[1] or "")):
        if name is not None:
            out[d].append(name)
    return out


def find_items(index: DataFrame, benchmark: DataFrame, bases: Bases, item_col: str = "item_id", text_col: str = "text", *,
               width: int = 10, near_terms: int = 3, slop: int = 15) -> DataFrame:
    """``(id, n_words, n_hit, spans, items, near_items)``, one row per indexed document.

    ``spans``: word ranges under exact windows; ``items``: items with such a window; ``near_items``:
    items with a window whose ``near_terms`` rarest words stand within ``slop`` words of the rarest. They
    are the rarest of the window's distinct words that the corpus has (of equally rare ones the first); a window with fewer of them than
    ``near_terms`` matches only if these are all its words.
    """
    ship(index.sparkSession)
    windows = item_windows(benchmark, item_col, text_col, width, bases)
    terms = windows.select(F.explode("terms").alias("term")).distinct()
    hits = land(index.filter(F.col("term").isNotNull()).join(terms, "term").select("shard", "term", "n", "postings"),
                "benchmark_postings")
    counts = land(hits.groupBy("term").agg(F.sum("n").alias("count")), "term_counts")
    # the words of a window that some document has, rarest first, the first of equally rare ones: at most ``width``
    distinct = F.size(F.array_distinct("terms"))
    routed = (windows.select("item", "nr", "terms", F.posexplode(F.array_distinct("terms")).alias("place", "term"))
              .join(counts, "term").groupBy("item", "nr", "terms")
              .agg(F.sort_array(F.collect_list(F.struct("count", "place", "term")))["term"].alias("known"))
              .filter(F.size("known") >= F.least(F.lit(near_terms), distinct))
              # a window with a word that no document has is nowhere as a phrase
              .select("item", F.when(F.size("known") == distinct, F.col("terms")).alias("terms"),
                      F.slice("known", 1, near_terms).alias("rare"), F.col("known")[0].alias("term")))
    sent = hits.select("shard", "term").join(routed, "term").select(F.col("shard").alias("to"), "item", "terms", "rare")
    shards = hits.select("shard", "term", "postings").unionByName(
        index.filter(F.col("term").isNull()).select("shard", "term", "postings"))
    ids = index.filter(F.col("term").isNull()).select("shard", "ids")
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    out = {"shard": pa.int64(), "doc": pa.int32(), "n_words": pa.int64(), "n_hit": pa.int64(), "spans": pa.list_(span),
           "items": pa.list_(pa.string()), "near_items": pa.list_(pa.string())}

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        term = left.column("term")
        is_docs = term.is_null().to_numpy(zero_copy_only=False)
        steps = left.column("postings").to_pylist()
        words = np.frombuffer(steps[int(np.flatnonzero(is_docs)[0])], np.int32).astype(np.int64)
        own = np.flatnonzero(~is_docs)
        shard = Shard(term.fill_null(0).to_numpy()[own], [steps[i] for i in own], words)
        n, total = len(words), int(words.sum())
        every = np.array(right.column("item").to_pylist(), object)

        def held(column: str):
            """Term numbers, lengths and items of the windows all of whose words the shard has."""
            lists = right.column(column).combine_chunks()
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            table = np.zeros((len(lengths), max(1, lengths.max(initial=0))), np.int64)
            table[np.arange(table.shape[1]) < lengths[:, None]] = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
            numbers = np.where(np.arange(table.shape[1]) < lengths[:, None], shard.numbers(table), -1)
            here = (lengths > 0) & ((numbers >= 0).sum(axis=1) == lengths)
            return numbers[here], lengths[here], every[here]

        spans: list[list] = [[] for _ in range(n)]
        hit_words = np.zeros(n, np.int64)
        items = near = spans
        numbers, lengths, names = held("terms")
        if len(names):
            window, start = shard.phrases(numbers, lengths)
            change = np.zeros(total + 1, np.int64)
            np.add.at(change, start, 1)
            np.add.at(change, start + lengths[window], -1)
            hit = np.concatenate([np.cumsum(change)[:total] > 0, [False]])
            begins = shard.ends - words
            edges = np.zeros(total + 1, bool)
            edges[begins[begins < total]] = True
            first = np.flatnonzero(hit & (np.concatenate([[True], ~hit[:-1]]) | edges))
            last = np.flatnonzero(hit[:-1] & (~hit[1:] | edges[1:])) + 1
            doc = np.searchsorted(shard.ends, first, "right")
            np.add.at(hit_words, doc, last - first)
            for d, a, b in zip(doc.tolist(), (first - begins[doc]).tolist(), (last - begins[doc]).tolist(), strict=True):
                spans[d].append({"start": a, "end": b})
            items = _per_doc(shard.ends, start, names[window], n)
        numbers, lengths, names = held("rare")
        if len(names):
            window, position = shard.near(numbers, lengths, slop)
            near = _per_doc(shard.ends, position, names[window], n)
        return pa.table({"shard": pa.array(np.full(n, left.column("shard")[0].as_py()), pa.int64()),
                         "doc": pa.array(np.arange(n), pa.int32()), "n_words": pa.array(words),
                         "n_hit": pa.array(hit_words), "spans": pa.array(spans, out["spans"]),
                         "items": pa.array(items, out["items"]), "near_items": pa.array(near, out["near_items"])})

    kind = ("shard long, doc int, n_words long, n_hit long, spans array<struct<start:long,end:long>>, "
            "items array<string>, near_items array<string>")
    found = shards.groupBy("shard").cogroup(sent.groupBy("to")).applyInArrow(search, kind)
    return (found.join(ids, "shard").select(F.element_at("ids", F.col("doc") + 1).alias("id"), "n_words", "n_hit",
                                            "spans", "items", "near_items"))


def scan_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", **options) -> DataFrame:
    """Index built and searched: one row per row of ``docs``."""
    bases = draw_bases()
    return find_items(build_index(docs, bases, id_col, text_col), benchmark, bases, item_col, item_text_col,
                      **options).withColumnRenamed("id", id_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without an exact benchmark window."""
    keyed = docs.select(doc_key(id_col, text_col), F.col(text_col).alias("text"))
    hit = (scan_contamination(keyed, benchmark, "doc", "text", item_col, item_text_col, **options)
           .filter(F.col("n_hit") > 0).select("doc").distinct())
    rows = docs.select(F.struct("*").alias("row"), doc_key(id_col, text_col))
    return rows.join(land(hit, "contaminated"), "doc", "left_anti").select("row.*")
