"""Texts written to collide: their difference vanishes modulo 2**64 at every odd base."""

import random

import numpy as np
import pyarrow as pa
import pytest
from test_packing import VOCAB
from tokenizers import Tokenizer

from waymark.llm import bytehash, decontaminate, jaccard_join, suffix_dedup, tokens, words

N = 2048


def _pair(alphabet: str = "bcdefghijklmnopqrstuvwx"):
    """Two texts that differ by one at every place, with the signs of the product of all ``x**(2**i) - 1``."""
    rng = random.Random(1)
    codes = [ord(rng.choice(alphabet)) for _ in range(N)]
    odd = [bin(i).count("1") % 2 for i in range(N)]
    return "".join(chr(c + o) for c, o in zip(codes, odd, strict=True)), "".join(
        chr(c + 1 - o) for c, o in zip(codes, odd, strict=True))


ONE, TWO = _pair()


def _polynomial(text: str, base: int) -> int:
    return sum(ord(c) * pow(base, i, 1 << 64) for i, c in enumerate(text)) % (1 << 64)


def test_the_texts_collide_modulo_a_power_of_two():
    assert ONE != TWO
    for base in (3, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        assert _polynomial(ONE, base) == _polynomial(TWO, base)


def test_slices_are_hashed_alike_wherever_they_start():
    rng = np.random.default_rng(2)
    for top in (256, 1 << 21):
        flat = rng.integers(0, top, 5000)
        flat[3000:3500] = flat[100:600]
        sums = bytehash.PrefixHash(flat, bytehash.draw_bases())
        a, b = np.array([100, 100, 0, 7]), np.array([600, 599, 0, 8])
        assert (sums.of(a, b) == sums.of(a + 2900, b + 2900))[[0, 1, 2]].all()
        assert len(np.unique(sums.windows(3))) > 4400
        assert (sums.windows(40) == sums.of(np.arange(4961), np.arange(40, 5001))).all()


def test_hash_is_the_polynomial():
    bases = bytehash.draw_bases()
    text = np.frombuffer((ONE + TWO).encode(), np.uint8)
    whole = bytehash.PrefixHash(text, bases).of(np.array([5]), np.array([4000]))[0]
    sides = [sum((int(c) + 1) * pow(b, i, bytehash.P) for i, c in enumerate(text[5:4000])) % bytehash.P for b in bases]
    assert int(whole) == (sides[0] << 31) | sides[1]


def test_many_symbols_do_not_overflow():
    flat = np.full(1 << 21, (1 << 21) - 1, np.uint32)
    sums = bytehash.PrefixHash(flat, bytehash.draw_bases())
    a = np.array([0, 1, 12345, (1 << 21) - 500])
    assert len(set(sums.of(a, a + 500).tolist())) == 1


@pytest.mark.parametrize("bits", [0, 3, 8])
def test_suffixes_whose_hashes_agree(monkeypatch, bits):
    """However badly prefixes collide, repeated windows are those whose bytes are repeated."""
    plain = suffix_dedup.QuickHash.of
    monkeypatch.setattr(suffix_dedup.QuickHash, "of", lambda self, a, b: plain(self, a, b) & np.uint64((1 << bits) - 1))
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 99, 30).astype(np.uint8) for _ in range(6)]
    texts = [texts[i] for i in rng.integers(0, 6, 40)]
    flat, off = np.concatenate(texts), np.arange(41) * 30
    n, at = np.full(40, 15), np.full(40, 14)
    seg, window = suffix_dedup.repeated_windows(flat, off, at, n, np.zeros(40, np.int64), 16, 3)
    where = {}
    for s in range(40):
        for w in range(15):
            where.setdefault((w, flat[s * 30 + w:s * 30 + w + 16].tobytes()), []).append((s, w))
    assert sorted(zip(seg.tolist(), window.tolist(), strict=True)) == sorted(x for xs in where.values() if len(xs) > 1 for x in xs)


def test_suffix_dedup(spark):
    docs = spark.createDataFrame([(1, ONE), (2, TWO)], "doc_id long, text string")
    out = suffix_dedup.dedup_substrings(docs).collect()
    assert [r.spans for r in out] == [[], []]


def test_tokens():
    plain = Tokenizer.from_file(VOCAB)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in (ONE, TWO, f"{ONE} {TWO}")]
    assert [x.tolist() for x in tokens.ColumnTokenizer(VOCAB).encode(pa.array([ONE, TWO, f"{ONE} {TWO}"]))] == expected


def test_tokens_whose_hashes_agree(monkeypatch):
    """Even if the hash says that two words are one, each gets its own ids."""
    monkeypatch.setattr(tokens.QuickHash, "of", lambda self, a, b: np.zeros(np.shape(a), np.uint64))
    plain = Tokenizer.from_file(VOCAB)
    rows = ["one two six ten", "two one", "éa ab", None, "six", ONE]
    expected = [plain.encode(t or "", add_special_tokens=False).ids for t in rows]
    assert [x.tolist() for x in tokens.ColumnTokenizer(VOCAB).encode(pa.array(rows))] == expected


def test_decontamination(spark):
    docs = spark.createDataFrame([(1, f"two {ONE} four"), (2, f"two {TWO} four")], "doc_id long, text string")
    bench = spark.createDataFrame([("i", f"two {TWO} four")], "item_id string, text string")
    out = {r.doc_id: r for r in decontaminate.scan_contamination(docs, bench).collect()}
    assert (out[1].n_hit, out[1].items, out[2].n_hit, out[2].items) == (0, [], 3, ["i"])


def test_jaccard(spark):
    docs = spark.createDataFrame([(1, ONE), (2, TWO), (3, ONE)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_words_of_one_hash_are_compared(monkeypatch):
    bases = bytehash.draw_bases()
    for rows in (["one two", "two six"], ["one", "x" * (1 << 20), "six"]):  # in one block, in several
        known: dict = {}
        list(words.column_words(pa.array(rows), jaccard_join._SPACE, bases, known))
        assert set(known.values()) == {w.encode() for r in rows for w in r.split()}
    monkeypatch.setattr(words.PrefixHash, "of", lambda self, a, b: np.zeros(np.shape(a), np.uint64))
    for rows in (["one two", "two six"], ["one", "x" * (1 << 20), "six"]):
        with pytest.raises(words.WordCollision):
            list(words.column_words(pa.array(rows), jaccard_join._SPACE, bases, {}))
