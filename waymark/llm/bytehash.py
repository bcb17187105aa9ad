"""Polynomial hashes over byte arrays, in whole-array NumPy operations.

Modulo the prime ``P = 2**31 - 1``, at two bases: ``S[i] = sum(c[j] * B**j for j < i)``, so the hash of any slice
is ``(S[end] - S[start]) * B**-start`` and equal slices have equal hashes wherever they start. Two
different slices of n symbols agree at a random base with probability below ``n / P``, at both below its
square. The bases are drawn anew for every run (``draw_bases``), so nobody can write texts that
collide; what a result rests on is compared by content beside that.

``QuickHash`` is the same modulo 2**64 at one base, at a quarter of the cost. Texts can be written to collide
under it, so it serves only where every outcome is compared by content, or where equal contents
must agree and others may.
"""

from __future__ import annotations

import secrets

import numpy as np

P = (1 << 31) - 1
_BITS = np.uint64(31)
_LOW = np.uint64(P)

Bases = tuple[int, int]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def draw_bases() -> Bases:
    """Two bases for one run; the driver draws them and hands them to its tasks."""
    first = secrets.randbelow(P - (1 << 21)) + (1 << 20)
    second = first
    while second == first:
        second = secrets.randbelow(P - (1 << 21)) + (1 << 20)
    return first, second


def _mod(x: np.ndarray) -> np.ndarray:
    """``x`` modulo P, for any 64-bit values."""
    x = (x & _LOW) + (x >> _BITS)
    x = (x & _LOW) + (x >> _BITS)
    x = (x & _LOW) + (x >> _BITS)
    return np.where(x >= _LOW, x - _LOW, x)


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint32)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have:have + more] = _mod(out[:more].astype(np.uint64) * np.uint64(pow(base, have, P)))
        have += more
    return out


def _grown(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, at least ``n`` of each."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        if have is None and len(_powers) >= 4:
            _powers.clear()  # of runs that are over
        size = max(n, 1 << 16)
        have = _powers[base] = (_power_table(base, size), _power_table(pow(base, -1, P), size))
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(29)
    return x


class PrefixHash:
    """Slice hashes of one array of symbols below 2**21."""

    def __init__(self, symbols: np.ndarray, bases: Bases):
        n = len(symbols)
        symbols = symbols.astype(np.uint64)
        symbols += np.uint64(1)
        exact = n * (int(symbols.max()) if n else 0) < 1 << 32  # the sums of products stay below 2**63
        self.sides = []
        for base in bases:
            up, down = _grown(base, n + 1)
            sums = np.zeros(n + 1, np.uint64)
            terms = symbols * up[:n]
            if exact:
                np.cumsum(terms, out=sums[1:])
            else:
                terms = _mod(terms)
                np.cumsum(terms, out=sums[1:])  # below 2**31 * n
            self.sides.append((sums, down))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of ``symbols[start:end]``, elementwise: 62 bits."""
        (a, down_a), (b, down_b) = self.sides
        return (_mod(_mod(a[end] - a[start]) * down_a[start]) << _BITS) | _mod(_mod(b[end] - b[start]) * down_b[start])

    def windows(self, width: int) -> np.ndarray:
        """Hash of every slice of ``width`` symbols."""
        (a, down_a), (b, down_b) = self.sides
        n = len(a) - width
        return ((_mod(_mod(a[width:] - a[:n]) * down_a[:n]) << _BITS)
                | _mod(_mod(b[width:] - b[:n]) * down_b[:n]))


def draw_odd() -> int:
    """A base of ``QuickHash`` for one run."""
    return secrets.randbits(64) | 1


_odd_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class QuickHash:
    """Slice hashes of one array, modulo 2**64."""

    def __init__(self, symbols: np.ndarray, base: int):
        n = len(symbols)
        have = _odd_powers.get(base)
        if have is None or len(have[0]) < n + 1:
            if have is None and len(_odd_powers) >= 2:
                _odd_powers.clear()  # of runs that are over
            size = max(n + 1, 1 << 16)
            steps = [np.full(size, b, np.uint64) for b in (base, pow(base, -1, 1 << 64))]
            for x in steps:
                x[0] = 1
            have = _odd_powers[base] = tuple(np.multiply.accumulate(x) for x in steps)
        self.up, self.down = have
        self.sums = np.zeros(n + 1, np.uint64)
        terms = symbols.astype(np.uint64)
        terms += np.uint64(1)
        terms *= self.up[:n]
        np.cumsum(terms, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of ``symbols[start:end]``, elementwise."""
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def windows(self, width: int) -> np.ndarray:
        """Hash of every slice of ``width`` symbols."""
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:n]) * self.down[:n]


def same_slices(flat: np.ndarray, start: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``flat[start:start + size]`` and ``flat[other:other + size]`` are the same, elementwise."""
    differ = np.zeros(len(size), bool)
    for k in range(0, len(size), 1 << 16):
        n = size[k:k + (1 << 16)]
        ends = np.cumsum(n)
        within = np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n, n)
        row = np.repeat(np.arange(len(n)), n)
        wrong = flat[start[k:k + (1 << 16)][row] + within] != flat[other[k:k + (1 << 16)][row] + within]
        differ[k + np.unique(row[wrong])] = True
    return ~differ
