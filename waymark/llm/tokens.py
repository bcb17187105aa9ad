"""Token ids of text columns under a word-level BPE file, each distinct word encoded once.

The vocabulary's pre-tokenizer splits a normalised text into pieces that are encoded one by
one, so a piece's ids do not depend on its neighbours. Pieces are found, hashed and compared in
whole-array steps and remembered by their text; only pieces not seen before go to the tokenizer. Texts with characters
outside the plain alphabet below go to it whole, so the ids are the tokenizer's in every case.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from waymark.llm.bytehash import QuickHash, draw_odd, mix, same_slices
from waymark.llm.common import blocks, utf8

_SPACE, _LETTER, _NUMBER, _OTHER, _FOREIGN = range(5)
_PLAIN = 0x180  # Latin letters up to here are their own composed form
_CACHE = 1 << 19  # pieces remembered
_PART, _LONG = 1 << 20, 4 << 20  # bytes of the parts of a long text, and of texts that are long


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.full(_PLAIN + 1, _OTHER, np.uint8)
    lower = np.arange(_PLAIN + 1, dtype=np.uint32)
    for c in range(_PLAIN):
        category, small = unicodedata.category(chr(c)), chr(c).lower()
        if category[0] in "LN":
            kind[c] = _LETTER if category[0] == "L" else _NUMBER
        if len(small) > 1 or unicodedata.normalize("NFC", chr(c)) != chr(c):
            kind[c] = _FOREIGN
        else:
            lower[c] = ord(small)
    kind[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = _SPACE
    kind[[*range(0x1C, 0x20), _PLAIN]] = _FOREIGN
    return kind, lower


_KIND, _LOWER = _tables()


def _cut(raw: bytes) -> Iterator[str]:
    """A long text in parts cut at spaces, which no piece and no special token spans."""
    at = 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= _PART else raw.rfind(b" ", at, at + _PART) + 1
        if end <= at:  # no space: on to the next one
            end = raw.find(b" ", at + _PART) + 1 or len(raw)
        yield raw[at:end].decode()
        at = end


class ColumnTokenizer:
    """Encodes string columns; lives as long as the worker, and so does what it has seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.base = draw_odd()
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.starts, self.ids, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32), 0

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces, many in one text: a space between two changes neither."""
        for at in range(0, len(pieces), 20_000):
            part = pieces[at:at + 20_000]
            encoded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids, sizes = np.array(encoded.ids, np.uint32), np.bincount(encoded.word_ids, minlength=len(part))
            if len(sizes) != len(part):
                raise ValueError("the tokenizer does not split pieces at white space")
            first = len(self.slot)
            while first + len(part) + 1 > len(self.starts):
                self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.starts[first + 1:first + 1 + len(part)] = self.used + np.cumsum(sizes)
            self.ids[self.used:self.used + len(ids)] = ids
            self.used += len(ids)
            self.slot.update(zip(part, range(first, first + len(part)), strict=True))

    def _plain(self, text: str, points: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts laid end to end, and the number of ids of each."""
        kind, n = _KIND[points], len(points)
        edge = np.ones(n + 1, bool)
        edge[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        edge[off] = True
        lower = _LOWER[points]
        self._contractions(lower, kind, edge, off)
        cuts = np.flatnonzero(edge)
        solid = kind[cuts[:-1]] != _SPACE
        start, end = cuts[:-1][solid], cuts[1:][solid]
        first, which = self._alike(lower, start, end)
        folded = text.lower()  # of these characters each has one lower-case form
        names = [folded[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        if len(self.slot) > _CACHE:
            self._forget()
        slots = list(map(self.slot.get, names))
        new = [i for i, s in enumerate(slots) if s is None]
        if new:
            self._learn([names[i] for i in new])
            for i in new:
                slots[i] = self.slot[names[i]]
        slots = np.array(slots, np.int64)
        begin, size = self.starts[slots], self.starts[slots + 1] - self.starts[slots]
        begin, size = begin[which], size[which]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(total[-1]) + np.repeat(begin - total[:-1], size)]
        return ids, np.diff(total[np.searchsorted(start, off)])

    def _alike(self, lower: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place of each distinct piece, and which of them each piece is: by hash, then by its characters."""
        sizes = end - start
        hashes = mix(QuickHash(lower, self.base).of(start, end) + sizes.astype(np.uint64))
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if (sizes == sizes[first][which]).all() and same_slices(lower, start, start[first][which], sizes).all():
            return first, which
        seen: dict[bytes, int] = {}  # two pieces share a hash: these by their characters alone
        which = np.array([seen.setdefault(lower[a:b].tobytes(), len(seen)) for a, b in zip(start, end, strict=True)], np.int64)
        return np.unique(which, return_index=True)[1], which

    @staticmethod
    def _contractions(lower: np.ndarray, kind: np.ndarray, edge: np.ndarray, off: np.ndarray) -> None:
        """An apostrophe on its own takes the s, t, m, d, re, ve or ll after it in its text."""
        quotes = np.flatnonzero(lower == 39)
        quotes = quotes[quotes + 1 < len(kind)]
        quotes = quotes[edge[quotes] & (kind[quotes + 1] == _LETTER) & ~np.isin(quotes + 1, off)]
        for i in quotes.tolist():
            rest = "".join(map(chr, lower[i + 1:i + 3].tolist()))
            take = 1 if rest[0] in "stmd" else 2 if rest in ("re", "ve", "ll") and not edge[i + 2] else 0
            if take:
                edge[i + 1] = False
                edge[i + 1 + take] = True

    def encode(self, col: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a column, in row order (null: none)."""
        for first, end in blocks(col):
            part = col.slice(first, end - first)
            flat, off = utf8(part)
            if end - first == 1 and len(flat) > _LONG:
                ids = [next(self._block(pa.array([t]), *utf8(pa.array([t])))) for t in _cut(flat.tobytes())]
                yield np.concatenate(ids)
            else:
                yield from self._block(part, flat, off)

    def _block(self, part: pa.Array, flat: np.ndarray, off: np.ndarray) -> Iterator[np.ndarray]:
        n = len(part)
        if not len(flat):
            yield from (np.zeros(0, np.uint32) for _ in range(n))
            return
        off_points = np.concatenate([[0], np.cumsum((flat & 0xC0) != 0x80)])[off]
        text = flat.tobytes().decode()
        points = np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), _PLAIN)
        foreign = _KIND[points] == _FOREIGN
        foreign[:-1] |= (points[:-1] == 60) & (points[1:] == 124)  # "<|" may begin a special token
        plain = np.diff(np.concatenate([[0], np.cumsum(foreign)])[off_points]) == 0
        keep = np.repeat(plain, np.diff(off_points))
        if not keep.all():
            points = points[keep]
            text = "".join(text[a:b] for a, b, ok in zip(off_points[:-1], off_points[1:], plain, strict=True) if ok)
        own = np.concatenate([[0], np.cumsum(np.diff(off_points)[plain])])
        ids, counts = (self._plain(text, points, own) if len(points)
                       else (np.zeros(0, np.uint32), np.zeros(int(plain.sum()), np.int64)))
        at = iter(np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else [])
        for i in range(n):
            yield next(at) if plain[i] else np.array(
                self.tokenizer.encode(part[i].as_py(), add_special_tokens=False).ids, np.uint32)


_tokenizers: dict[str, ColumnTokenizer] = {}


def column_tokenizer(path: str) -> ColumnTokenizer:
    """The worker's tokenizer for a vocabulary file."""
    if path not in _tokenizers:
        _tokenizers[path] = ColumnTokenizer(path)
    return _tokenizers[path]
