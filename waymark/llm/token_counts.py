"""Token counts by byte-pair merging on a heap and a linked list; no token id is made.

A text's pieces are found as the vocabulary file says (special strings first, then normal form,
lower case and the piece pattern). Each distinct piece is merged once per worker: its bytes are
the first symbols, kept in a doubly linked list; a heap holds the adjacent pairs that can merge,
and the pair of the lowest rank (the leftmost of equal ones) is popped until none is left. A popped
pair whose symbols have changed since is stale and passed over. Every merge joins two symbols, so a
piece has as many tokens as it has bytes, less its merges. A piece of n bytes costs n log n, also
one of a megabyte.

Texts are independent, so nothing is shuffled, and a lost executor costs its own tasks.

Defined results: null or empty text has no bytes and no tokens; texts of special tokens count as
one each, as the library has it; very long texts are cut at spaces, which no piece spans; repeated
rows each get their row, and rows may share an id or have none; an empty table gives an empty
result; only the id and text columns are read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import ship

#: Texts of these characters alone are their own normal form once lower-cased, and what is a letter or a number
#: among them is the same in every Unicode version; others go through the library's own normalizer and splitter.
_ODD = regex.compile(r"[^\t\n\r\x20-\x7E¡-įı-ňŊ-ſ‐-‧]")
_PART = 1 << 20  # characters of a long text handled at once
_CACHE = 1 << 19  # pieces remembered


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class MergeTable:
    """Symbols and ranked merges of a byte-level vocabulary file with word ends."""

    def __init__(self, vocab: dict[str, int], merges: list, word_end: str):
        chars = byte_symbols()
        self.first = [vocab[c] for c in chars]
        self.last = [vocab[c + word_end] for c in chars]
        self.width = 1 + max(vocab.values())
        #: (left symbol, right symbol) as one number -> (rank, joined symbol)
        self.ranked = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranked.setdefault(vocab[left] * self.width + vocab[right], (rank, vocab[left + right]))

    def count(self, piece: bytes) -> int:
        """Tokens of one piece: its bytes less the merges."""
        n = len(piece)
        if n < 2:
            return n
        symbol = [self.first[b] for b in piece]
        symbol[-1] = self.last[piece[-1]]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))  # n ends the list
        ranked, width, merges = self.ranked, self.width, 0
        heap = []
        for i in range(n - 1):
            found = ranked.get(symbol[i] * width + symbol[i + 1])
            if found:
                heap.append((found[0], i))
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i] if symbol[i] >= 0 else n
            found = ranked.get(symbol[i] * width + symbol[j]) if j < n else None
            if not found or found[0] != rank:  # stale: one of the two has merged since
                continue
            symbol[i], symbol[j] = found[1], -1
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                right = ranked.get(symbol[i] * width + symbol[k])
                if right:
                    heappush(heap, (right[0], i))
            k = before[i]
            if k >= 0:
                left = ranked.get(symbol[k] * width + symbol[i])
                if left:
                    heappush(heap, (left[0], k))
        return n - merges


class TokenCounter(dict):
    """Counts the tokens of texts; remembers the count of each piece it has merged."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        whole = Tokenizer.from_file(path)
        self.normalizer, self.splitter = whole.normalizer, whole.pre_tokenizer
        self.merges = MergeTable(spec["model"]["vocab"], spec["model"]["merges"], spec["model"]["end_of_word_suffix"])
        pattern = next(s["pattern"]["Regex"] for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")
        self.pieces = regex.compile(pattern).findall
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))))

    def __missing__(self, piece: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        self[piece] = n = self.merges.count(piece.encode())
        return n

    def _split(self, text: str) -> list[str]:
        if not _ODD.search(text):
            return self.pieces(text.lower())
        text = self.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def count(self, text: str) -> int:
        total, at = 0, 0
        for found in self.special.finditer(text):
            total += 1 + self._plain(text[at:found.start()])
            at = found.end()
        return total + self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> int:
        total, at = 0, 0
        while at < len(text):
            end = len(text) if len(text) - at <= _PART else text.rfind(" ", at, at + _PART) + 1
            if end <= at:  # no space: on to the next one
                end = text.find(" ", at + _PART) + 1 or len(text)
            total += sum(map(self.__getitem__, self._split(text[at:end])))
            at = end
        return total


_counters: dict[str, TokenCounter] = {}


def token_counter(path: str) -> TokenCounter:
    """The worker's counter for a vocabulary file."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *,
                 limit: int = 2048) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row under the vocabulary file at ``path``.

    ``path`` must be readable on the executors. ``over_limit``: more than ``limit`` tokens.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(path)
        for batch in batches:
            sizes, counts = [], []
            for text in batch.column(1).cast(pa.binary()):
                raw = text.as_py() or b""
                sizes.append(len(raw))
                counts.append(counter.count(raw.decode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                names=["id", "n_bytes", "n_tokens"])

    return (rows.mapInArrow(count, f"id {id_type}, n_bytes long, n_tokens long")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
