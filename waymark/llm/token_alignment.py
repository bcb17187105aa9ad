"""Token alignment of two tokenizers by diagonal run skipping.

Both tokenizers cut the same bytes, so their tokens are compared by the byte offsets where they
end. While tokens match one to one, the offset of token ``i`` of A is that of token ``i + shift`` of
B: stretches of 1, 2, 4, ... offsets at that shift are compared whole, and the first that differs is
halved down to the end of the run, which is jumped. What follows is a group of several tokens on
one side; it is walked token by token to the next common offset, which sets the new shift.
Groups end at common offsets; two tokens are linked where their bytes overlap.

Counting id pairs over the corpus moves pairs, not links: texts are aligned in blocks of about
two megabytes, each block lists its distinct id pairs once, the lists are summed per pair and every
pair's sum, and whether it is the highest of its B id, goes back to the blocks that named it. There
the links of each text are looked up by their place in the block's list. The highest count per B
id has at most a row per id of the B vocabulary, which is what is broadcast.

A text longer than a block is aligned in parts, cut before a single space between visible
characters: no token of either vocabulary spans that place.

Defined results: null and empty text, and text that one of the tokenizers does not give back byte for
byte, has no tokens; repeated rows each get their row and count each; rows may share an id or have
none; strings of special tokens are plain text; an empty table gives an empty result; only the id
and text columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import land, ship
from waymark.llm.token_counts import byte_symbols

BLOCK = 2 << 20  # bytes of text aligned at once
_CACHE = 1 << 18  # words of B remembered
_B_BITS = 16  # a pair's number: A's id above, B's id below
#: Characters outside those that every Unicode version splits alike: such texts go to A's file itself.
_ODD = regex.compile(r"[^\t\n\r\x20-\x7E¡-ͯΑ-ѿ‐-‧]")
_BLANKS = regex.compile(r"\s{1000}")
_SAFE = regex.compile(r"\S(?= \S)")  # before a single space between visible characters


class Vocabulary:
    """What one tokenizer's ids stand for: the bytes of each, and their number."""

    def __init__(self, pieces: list[bytes]):
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self._flat = np.frombuffer(b"".join(pieces), np.uint8)
        self._starts = np.cumsum(self.sizes) - self.sizes

    def spelled(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids, joined."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self._flat[np.arange(ends[-1] if len(ids) else 0) + np.repeat(self._starts[ids] - ends + sizes, sizes)].tobytes()


class ByteLevelSide(Vocabulary):
    """A: a byte-level vocabulary file; ``ranks_path`` names the same vocabulary as ranks, which encodes faster."""

    def __init__(self, path: str, ranks_path: str | None, pattern: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        names = [self.whole.id_to_token(i) for i in range(self.whole.get_vocab_size())]
        pieces = [bytes(byte_of.get(c, 0) for c in name) for name in names]
        super().__init__(pieces)
        self.ranks = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
            if all(pieces[r] == t for t, r in ranks.items()):
                self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _by_ranks(self, text: str) -> bool:
        """Whether the rank form splits the text as the file does, and in good time (long runs take it the square)."""
        if self.ranks is None or not text.isascii() and _ODD.search(text):
            return False
        words = list(map(len, text.split()))
        return max(words, default=0) < 1000 and (
            len(text) - sum(words) - len(words) < 1000 or not _BLANKS.search(text))

    def encode(self, spaced: str) -> np.ndarray:
        if self._by_ranks(spaced):
            return self.ranks.encode_to_numpy(spaced, disallowed_special=()).astype(np.int32)
        return np.array(self.whole.encode(spaced, add_special_tokens=False).ids, np.int32)


class PieceSide(Vocabulary):
    """B: a sentence-piece model that adds a space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        super().__init__([bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
                          for i, n in enumerate(names)])
        # no piece has a space after something else, so no merge crosses the place before a word's spaces
        self.cuts = not any(" " in n.replace("▁", " ").lstrip(" ") for n in names)

    def encode(self, spaced: str) -> np.ndarray:
        return np.array(self.model.encode(spaced[1:]), np.int32)


_sides: dict[tuple, tuple[ByteLevelSide, PieceSide]] = {}


def sides(a_path: str, b_path: str, ranks_path: str | None = None,
          pattern: str | None = None) -> tuple[ByteLevelSide, PieceSide]:
    """The worker's two tokenizers."""
    key = (a_path, b_path, ranks_path, pattern)
    if key not in _sides:
        _sides[key] = ByteLevelSide(a_path, ranks_path, pattern), PieceSide(b_path)
    return _sides[key]


def align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links of two arrays of end offsets whose last one is the same.

    ``(a_ends, b_ends, link_a, link_b)``: how many tokens of either side the groups reach to, and the linked tokens.
    """
    a, b = a.tolist(), b.tolist()
    run_a, run_b, sizes = [], [], []
    a_ends, b_ends, link_a, link_b = [], [], [], []  # of irregular groups
    i = j = 0
    n = len(a)
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            shift, end, step = j - i, i + 1, 2
            while end < n and a[end:end + step] == b[end + shift:end + shift + step]:
                end += step  # the stretch matches: probe one of twice the length
                step *= 2
            end = min(end, n)
            while step > 1 and end < n:  # the run ends in this stretch: halve it
                step >>= 1
                if a[end:end + step] == b[end + shift:end + shift + step]:
                    end += step
            run_a.append(i)
            run_b.append(j)
            sizes.append(end - i)
            i, j = end, end + shift
            continue
        while x != y:  # one group, up to the next common end
            link_a.append(i)
            link_b.append(j)
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        link_a.append(i)
        link_b.append(j)
        i, j = i + 1, j + 1
        a_ends.append(i)
        b_ends.append(j)
    sizes = np.array(sizes, np.int64)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    one_a, one_b = (np.repeat(np.array(x, np.int64), sizes) + within for x in (run_a, run_b))
    link_a, link_b = np.concatenate([one_a, link_a]).astype(np.int64), np.concatenate([one_b, link_b]).astype(np.int64)
    by = np.argsort(link_a + link_b, kind="stable")  # grows with every link
    ends = (np.sort(np.concatenate([x + 1, y]).astype(np.int64), kind="stable") for x, y in ((one_a, a_ends), (one_b, b_ends)))
    return *ends, link_a[by], link_b[by]


class GroupText:
    """``a1,a2|b1;a3|b2,b3`` of aligned ids: every id with the sign that follows it, laid in order and joined."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        self.names = [f"{i}{sign}" for n, signs in ((n_a, ",|"), (n_b, ",;")) for sign in signs for i in range(n)]

    def of(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> str:
        """Text of whole groups, ending in ``;``."""
        a_code, b_code = a.copy(), b + 2 * self.n_a
        a_code[a_ends - 1] += self.n_a
        b_code[b_ends - 1] += self.n_b
        code = np.empty(len(a) + len(b), np.int64)
        a_sizes, b_sizes = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
        code[np.arange(len(a)) + np.repeat(b_ends - b_sizes, a_sizes)] = a_code
        code[np.arange(len(b)) + np.repeat(a_ends, b_sizes)] = b_code
        return "".join(map(self.names.__getitem__, code.tolist()))


def _parts(text: str) -> Iterator[str]:
    """A text in parts of half a block or a little more."""
    at = 0
    while len(text) - at > BLOCK:
        found = _SAFE.search(text, at + BLOCK // 2)
        if not found:
            break
        yield text[at:found.end()]
        at = found.end()
    yield text[at:]


def _encoded(raw: bytes, a_side: ByteLevelSide, b_side: PieceSide) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids of both sides for each part of a text; none if a side does not give the text back."""
    out, text = [], " " + raw.decode()
    for part in _parts(text) if b_side.cuts else [text]:
        whole, a, b = part.encode(), a_side.encode(part), b_side.encode(part)
        if a_side.spelled(a) != whole or b_side.spelled(b) != whole:
            return []
        out.append((a, b))
    return out


def packed(links: np.ndarray) -> bytes:
    """Numbers in ascending order, as steps whose low bytes come first, compressed."""
    steps = np.diff(np.sort(links), prepend=0).astype(np.uint32)
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.int64)


class Block:
    """Parts of texts that are aligned together."""

    def __init__(self, number: int, a_side: Vocabulary, b_side: Vocabulary, names: GroupText):
        self.number, self.a_side, self.b_side, self.names = number, a_side, b_side, names
        self.rows: list = []  # (row number, part of the text's ids)
        self.bytes = 0

    def add(self, uid: int, a: np.ndarray, b: np.ndarray) -> None:
        self.rows.append((uid, a, b))
        self.bytes += int(self.a_side.sizes[a].sum())

    def aligned(self):
        """Id pairs of the block with their numbers of links, and ``(uid, n_a, n_b, n_groups, links, text)`` per row."""
        a = np.concatenate([r[1] for r in self.rows]).astype(np.int64)
        b = np.concatenate([r[2] for r in self.rows]).astype(np.int64)
        a_ends, b_ends, link_a, link_b = align(np.cumsum(self.a_side.sizes[a]), np.cumsum(self.b_side.sizes[b]))
        links, pairs = pd.factorize((a[link_a] << _B_BITS) | b[link_b])
        counts = np.bincount(links, minlength=len(pairs))
        a_cut = np.cumsum([0, *(len(r[1]) for r in self.rows)])  # rows end where both sides do
        b_cut = np.cumsum([0, *(len(r[2]) for r in self.rows)])
        group_cut, link_cut = np.searchsorted(a_ends, a_cut, "right"), np.searchsorted(link_a, a_cut)
        per_row = []
        for k, (uid, own_a, own_b) in enumerate(self.rows):
            g = slice(group_cut[k], group_cut[k + 1])
            text = self.names.of(own_a.astype(np.int64), own_b.astype(np.int64), a_ends[g] - a_cut[k], b_ends[g] - b_cut[k])
            per_row.append((uid, len(own_a), len(own_b), g.stop - g.start,
                            packed(links[link_cut[k]:link_cut[k + 1]]), text))
        return pairs, counts, per_row


_TOKENS = "n_a long, n_b long, n_groups long"


def align_blocks(docs: DataFrame, id_col: str, text_col: str, a_path: str, b_path: str, ranks_path: str | None,
                 pattern: str | None) -> DataFrame:
    """Landed rows of three kinds.

    Texts ``(uid, id, sha)``; their aligned parts ``(uid, block, n_a, n_b, n_groups, links)``, where ``links`` are
    packed places in the block's list; and blocks ``(block, pairs, counts)``.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = (f"uid long, id {id_type}, sha string, block long, {_TOKENS}, links binary, pairs array<long>, "
              "counts array<long>")
    columns = {"uid": pa.int64(), "sha": pa.string(), "block": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(),
               "n_groups": pa.int64(), "links": pa.binary(), "pairs": pa.list_(pa.int64()), "counts": pa.list_(pa.int64())}

    def table(id_kind: pa.DataType, **have) -> pa.RecordBatch:
        n = len(next(iter(have.values())))
        arrays = {"uid": None, "id": have.pop("id", None), **dict.fromkeys(list(columns)[1:])}
        arrays = {c: have.get(c, v) for c, v in arrays.items()}
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, columns.get(c, id_kind)) if v is None else v if isinstance(v, pa.Array) else pa.array(v, columns[c])
             for c, v in arrays.items()], names=list(arrays))

    def run(batches):
        a_side, b_side = sides(a_path, b_path, ranks_path, pattern)
        names = GroupText(len(a_side.sizes), len(b_side.sizes))
        first = TaskContext.get().partitionId() << 36  # the same in every attempt
        uid, block = first, Block(first, a_side, b_side, names)
        open_texts: dict[int, hashlib._Hash] = {}

        def close(kind):
            nonlocal block
            pairs, counts, per_row = block.aligned()
            for u, *_, text in per_row:
                raw = text.encode()
                if u in open_texts:
                    open_texts[u].update(b";" + raw[:-1])  # a part before this one
                else:
                    open_texts[u] = hashlib.sha256(raw[:-1])
            uids, n_a, n_b, n_groups, links, _ = zip(*per_row, strict=True)
            yield table(kind, uid=uids, block=[block.number] * len(uids), n_a=n_a, n_b=n_b, n_groups=n_groups, links=links)
            spots = pa.array([0, len(pairs)], pa.int32())
            yield table(kind, block=[block.number], pairs=pa.ListArray.from_arrays(spots, pa.array(pairs)),
                        counts=pa.ListArray.from_arrays(spots, pa.array(counts)))
            block = Block(block.number + 1, a_side, b_side, names)

        for batch in batches:
            kind = batch.column(0).type
            at = uid
            for text in batch.column(1).cast(pa.binary()):
                raw = text.as_py()
                for a, b in _encoded(raw, a_side, b_side) if raw else ():
                    block.add(uid, a, b)
                    if block.bytes >= BLOCK:
                        yield from close(kind)
                uid += 1
            if block.rows:
                yield from close(kind)
            shas = [open_texts[u].hexdigest() if u in open_texts else "" for u in range(at, uid)]
            open_texts.clear()
            yield table(kind, uid=list(range(at, uid)), id=batch.column(0), sha=shas)

    return land(rows.mapInArrow(run, schema), "aligned_blocks")


def align_tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", *,
                 ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row.

    The files must be readable on the executors; ``ranks_path`` and ``pattern`` may name A's vocabulary as ranks and
    the pattern that splits text for it. ``n_best``: links whose id pair is linked as often over the corpus as its B id is
    with any; ``count_sum``: how often the pairs of the links are linked over the corpus, summed over the links.
    """
    ship(docs.sparkSession)
    rows = align_blocks(docs, id_col, text_col, a_path, b_path, ranks_path, pattern)
    named = land(rows.filter(F.col("pairs").isNotNull())
                 .select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "p"))
                 .select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n")), "id_pairs")
    totals = land(named.groupBy("pair").agg(F.sum("n").alias("total")), "pair_counts")
    b_id = F.col("pair").bitwiseAND((1 << _B_BITS) - 1).alias("b")
    highest = totals.groupBy(b_id).agg(F.max("total").alias("most"))  # a row per id of B's vocabulary at most
    scored = land(totals.withColumn("b", b_id).join(F.broadcast(highest), "b")
                  .select("pair", "total", (F.col("total") == F.col("most")).alias("best")), "scored_pairs")
    back = named.join(scored, "pair").select(F.col("block").alias("to"), "place", "total", "best")
    parts = rows.filter(F.col("links").isNotNull()).select("block", "uid", "n_a", "n_b", "n_groups", "links")

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        total, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
        total[place] = right.column("total").to_numpy()
        best[place] = right.column("best").to_numpy(zero_copy_only=False)
        n_links, n_best, sums = [], [], []
        for blob in left.column("links"):
            links = unpacked(blob.as_py())
            n_links.append(len(links))
            n_best.append(int(best[links].sum()))
            sums.append(int(total[links].sum()))
        return pa.table({"uid": left.column("uid"), "n_a": left.column("n_a"), "n_b": left.column("n_b"),
                         "n_groups": left.column("n_groups"), "n_links": pa.array(n_links, pa.int64()),
                         "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(sums, pa.int64())})

    found = parts.groupBy("block").cogroup(back.groupBy("to")).applyInArrow(
        look_up, f"uid long, {_TOKENS}, n_links long, n_best long, count_sum long")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    texts = rows.filter(F.col("sha").isNotNull()).select(
        "uid", "id", "sha", *[F.lit(0).cast("long").alias(c) for c in numbers])
    every = texts.unionByName(found.select("uid", *numbers), allowMissingColumns=True)
    # ``uid`` is one row's own, so a group is a text and its parts
    return (every.groupBy("uid").agg(F.max("id").alias(id_col), *[F.sum(c).alias(c) for c in numbers],
                                     F.max("sha").alias("groups_sha256")).drop("uid"))
