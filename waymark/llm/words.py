"""Word hashes of whole text columns, from their bytes.

A table says which bytes separate words; every byte of a multi-byte character is part of a
word. A-Z are lower-cased first. The hashes' bases are drawn anew for every run (``bytehash.draw_bases``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from waymark.llm.bytehash import Bases, PrefixHash, mix, same_slices
from waymark.llm.common import blocks, utf8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PIECE = 4 << 20  # bytes of one text hashed at once
_STEP = 1 << 16


class WordCollision(RuntimeError):
    """Two different words have one hash at this run's bases; another run draws others."""


def word_hashes(flat: np.ndarray, off: np.ndarray, separates: np.ndarray, bases: Bases,
                known: dict[int, bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the number of words of each row.

    ``known``: the word of each hash met so far. Words are compared with it by their bytes and added to it;
    ``WordCollision`` if two of one hash differ.
    """
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(len(off) - 1, np.int64)
    flat = _LOWER[flat]
    solid = ~separates[flat]
    cut = np.zeros(len(flat) + 1, bool)
    cut[off] = True  # words end at row ends
    starts, ends = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1] | cut[1:-1]
    ends[:-1] &= ~solid[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    counts = np.diff(np.searchsorted(starts, off))
    hashes = mix(PrefixHash(flat, bases).of(starts, ends) + (ends - starts).astype(np.uint64))
    if known is not None:
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        like, sizes = starts[first], ends - starts
        same = (sizes == sizes[first][which]).all() and same_slices(flat, starts, like[which], sizes).all()
        raw = flat.tobytes()
        names = (raw[a:b] for a, b in zip(like.tolist(), ends[first].tolist(), strict=True))
        if not same or not all(known.setdefault(h, w) == w for h, w in zip(distinct.tolist(), names, strict=True)):
            raise WordCollision("two words of a task have one hash: run again")
    return hashes, counts


def _one_long(flat: np.ndarray, separates: np.ndarray, bases: Bases, known: dict[int, bytes] | None) -> np.ndarray:
    """Word hashes of one long text, piece by piece, cut where words are separated."""
    out, at = [], 0
    while at < len(flat):
        end = min(at + _PIECE, len(flat))
        while end < len(flat):
            gaps = np.flatnonzero(separates[flat[end - _STEP:end]])
            if len(gaps):
                end += int(gaps[-1]) + 1 - _STEP
                break
            end = min(end + _STEP, len(flat))
        out.append(word_hashes(flat[at:end], np.array([0, end - at]), separates, bases, known)[0])
        at = end
    return np.concatenate(out)


def column_words(col: pa.Array, separates: np.ndarray, bases: Bases,
                 known: dict[int, bytes] | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, word hashes, words per row)`` of blocks of a text column; ``known`` as in ``word_hashes``."""
    for first, end in blocks(col):
        flat, off = utf8(col.slice(first, end - first))
        if end - first == 1 and len(flat) > _PIECE:
            hashes = _one_long(flat, separates, bases, known)
            yield first, end, hashes, np.array([len(hashes)])
        else:
            yield first, end, *word_hashes(flat, off, separates, bases, known)
