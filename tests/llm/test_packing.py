"""Tokenizer and packing."""

import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import counted, documents, texts
from tokenizers import Tokenizer

from waymark.llm import bin_packing, tokens

VOCAB = public_tokenizers.path("word_bpe_49k.json")
ODD = ["don't we'll they've I'm he'd it's 'tis rock'n'roll x''s y'S 'RE ''ll a'", "'s", "'", "don'", "a'", "'r",
       "'ve", "İstanbul ΣΑΣ ǅ", "é é ﬁ", "日本語 text 12 3.14 ½ ²", "", None, "\x1c a\x1fb", "<|endoftext|> hi <|x|>",
       "a b\u0085c\x0bd", "ŉ ß Å ÿ ſ", "x'", "'ll", "we'l", "’s it’s", "naïve café's", "re", "ve", "'", "s"]


def test_ids_are_the_tokenizers():
    plain = Tokenizer.from_file(VOCAB)
    rows = ODD + [t for _, t in texts()]
    expected = [plain.encode(t or "", add_special_tokens=False).ids for t in rows]
    cached = tokens.ColumnTokenizer(VOCAB)
    for _ in range(2):  # unknown, then known words
        assert [x.tolist() for x in cached.encode(pa.array(rows, pa.string()))] == expected
    assert [x.tolist() for x in cached.encode(pa.chunked_array([rows[5:9]]).combine_chunks().slice(1, 2))] == expected[6:8]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "_CACHE", 5)
    rows = [t for _, t in texts()][:20]
    small, plain = tokens.ColumnTokenizer(VOCAB), Tokenizer.from_file(VOCAB)
    for t in rows:
        assert next(iter(small.encode(pa.array([t], pa.string())))).tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(tokens, "_PART", 50)
    monkeypatch.setattr(tokens, "_LONG", 120)
    plain, cached = Tokenizer.from_file(VOCAB), tokens.ColumnTokenizer(VOCAB)
    for t in ["don't we'll  " * 30 + "x" * 200 + " é end " * 20, "日本 <|endoftext|> é " * 40, "y" * 500, " " * 300]:
        assert [x.tolist() for x in cached.encode(pa.array([t]))] == [plain.encode(t, add_special_tokens=False).ids]


def _pieces(rows, capacity):
    plain, out = Tokenizer.from_file(VOCAB), []
    for i, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4")
            out.append((i, k, at, len(part), zlib.crc32(part.tobytes())))
    return out


def _check_packed(out, capacity):
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("options", [{}, {"shard_size": 8, "passes": 3}], ids=["", "shards"])
def test_packing(spark, options):
    rows = texts() + [(500 + k, t) for k, t in enumerate(ODD)] + [(9, "equal row")] * 40
    out = bin_packing.pack_documents(documents(spark, rows), capacity=256, **options).collect()
    assert counted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == counted(_pieces(rows, 256))
    used = _check_packed(out, 256)
    total = sum(r.length for r in out)
    assert used <= math.ceil(total / 256 * (1.03 if options else 1.0)) + 1  # shards of eight pieces waste some


def test_piece_ids_round_trip(spark):
    rows = texts()[:12]
    out = bin_packing.pack_documents(documents(spark, rows), capacity=64, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in out)
    plain = Tokenizer.from_file(VOCAB)
    whole = {}
    for r in sorted(out, key=lambda r: r.start):
        whole.setdefault((r.doc_id, r.sequence_id if r.doc_id in (8, None) else 0), []).extend(r.ids)
    assert whole[5, 0] == [*plain.encode("one two three", add_special_tokens=False).ids, 0]


def test_packing_nothing(spark):
    assert bin_packing.pack_documents(documents(spark).limit(0)).collect() == []


def test_best_fit_takes_the_fullest_bin():
    assert bin_packing.best_fit([0, 1, 2, 3], [60, 50, 40, 50], {}, 100, 0) == {0: 0, 1: 1, 2: 0, 3: 1}
    assert bin_packing.best_fit([0], [30], {7: 31, 8: 30, 9: 90}, 100, 10) == {0: 8}


@pytest.mark.parametrize("seed", range(4))
def test_operators_keep_every_piece(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 100, 300)
    island = bin_packing.Island(sizes, 100, [seed])
    island.fresh(0.3)
    island.fresh(0.3)
    for child in (island.crossover(*island.population), island.mutate(island.population[0])):
        assert child.shape == sizes.shape and island.fills(child).max() <= 100 and island.fills(child).min() > 0
    first = min(map(island.fitness, island.population))
    best = island.evolve(20, 6)[0]
    assert island.fitness(best) <= first
    assert island.fitness(best)[0] >= math.ceil(sizes.sum() / 100)
