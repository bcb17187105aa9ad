"""Token counts and token alignment against the libraries, and centroid clustering against plain integers."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from cases import CLASHING, counted, documents, texts
from test_packing import ODD
from tokenizers import Tokenizer

from waymark.llm import centroid_clusters, token_alignment, token_counts
from waymark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
RANKS = {"ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}
LONG = ["a" * 50_000, "ab" * 40_000, "=" * 30_000, " " * 5_000, "x \n" * 3_000, "word " * 400_000]


def noise(n: int, seed: int = 5) -> list[str]:
    rng = random.Random(seed)
    alphabet = "abcXYZ'’ \t\n12½²éÉßŉªº­·<|>endoftext\u0085  日本ǅİ́\x1c\x00—▁ﬁЖж🙂 "
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


# --- token counts

def test_counts_are_the_librarys():
    plain, own = Tokenizer.from_file(WORDS), token_counts.TokenCounter(WORDS)
    rows = ODD + [t for _, t in texts()] + noise(3_000) + LONG[:5] + ["<|endoftext|>a<|startoftext|><|endoftext|>"]
    expected = [len(plain.encode(t or "", add_special_tokens=False).ids) for t in rows]
    assert [own.count(t or "") for t in rows] == expected


def test_counts_in_parts_and_after_forgetting(monkeypatch):
    monkeypatch.setattr(token_counts, "_PART", 40)
    monkeypatch.setattr(token_counts, "_CACHE", 7)
    plain, own = Tokenizer.from_file(WORDS), token_counts.TokenCounter(WORDS)
    for t in [t or "" for _, t in texts()][:25] + noise(200, 9):
        assert own.count(t) == len(plain.encode(t, add_special_tokens=False).ids)


def test_lowest_rank_first_and_leftmost_of_equal_ones():
    vocab = {c: i for i, c in enumerate([*token_counts.byte_symbols(), *(c + "." for c in token_counts.byte_symbols())])}
    vocab |= {"bc": 512, "ab": 513, "aa": 514, "aaa": 515}
    table = token_counts.MergeTable(vocab, ["b c", ["a", "b"], "a a", "aa a"], ".")
    assert table.count(b"abcx") == 3  # a bc x., not ab c x.
    assert table.count(b"aaaax") == 3  # aa aa x.
    assert table.count(b"aaax") == 2  # aaa x.
    assert table.count(b"") == 0 and table.count(b"q") == 1


def test_token_counts(spark):
    rows = texts() + [(700 + i, t) for i, t in enumerate(ODD + LONG)]
    plain = Tokenizer.from_file(WORDS)
    ids = [len(plain.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    got = token_counts.count_tokens(documents(spark, rows), WORDS).collect()
    assert counted(map(tuple, got)) == counted(
        (i, len((t or "").encode()), n, n > 2048) for (i, t), n in zip(rows, ids, strict=True))
    assert token_counts.count_tokens(documents(spark).limit(0), WORDS).collect() == []


def test_token_counts_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    plain = Tokenizer.from_file(WORDS)
    sizes = [len(e.ids) for e in plain.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    assert counted(map(tuple, QUERIES["op13_token_counts"](spark, SMALL).collect())) == counted(
        (i, len((t or "").encode()), n, n > 2048) for (i, t), n in zip(rows, sizes, strict=True))


# --- token alignment

class Plain:
    """Alignment by every offset and every pair, with the libraries' own ids."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}

    def tokens(self, text):
        """``[(id, start, end)]`` of both sides, or none."""
        if not text:
            return [], []
        whole = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        out = []
        for ids, spell in ((a, lambda i: bytes(self.byte[c] for c in self.a.id_to_token(i))), (b, self._piece)):
            at, row = 0, []
            for i in ids:
                row.append((i, at, at + len(spell(i))))
                at = row[-1][2]
            if b"".join(map(spell, ids)) != whole:
                return [], []
            out.append(row)
        return out

    def _piece(self, i):
        name = self.b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()

    def rows(self, table):
        cut = [self.tokens(t) for _, t in table]
        links = []
        for a, b in cut:
            own, first = [], 0
            for i, s, e in a:
                while first < len(b) and b[first][2] <= s:
                    first += 1
                k = first
                while k < len(b) and b[k][1] < e:
                    own.append((i, b[k][0]))
                    k += 1
            links.append(own)
        count, most = {}, {}
        for pair in (p for own in links for p in own):
            count[pair] = count.get(pair, 0) + 1
        for (_, j), n in count.items():
            most[j] = max(most.get(j, 0), n)
        out = []
        for (doc, _), (a, b), own in zip(table, cut, links, strict=True):
            ends = sorted({e for *_, e in a} & {e for *_, e in b})
            groups, start = [], 0
            a_at = b_at = 0
            for end in ends:
                g = ([], [])
                while a_at < len(a) and a[a_at][2] <= end:
                    g[0].append(a[a_at][0])
                    a_at += 1
                while b_at < len(b) and b[b_at][2] <= end:
                    g[1].append(b[b_at][0])
                    b_at += 1
                groups.append("|".join(",".join(map(str, x)) for x in g))
                start = end
            sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
            out.append((doc, len(a), len(b), len(groups), len(own), sum(count[p] == most[p[1]] for p in own),
                        sum(count[p] for p in own), sha))
        return out


def test_ranks_give_the_files_ids():
    side, plain = token_alignment.ByteLevelSide(A, **{"ranks_path": RANKS["ranks_path"], "pattern": RANKS["pattern"]}), Plain()
    rows = [t for _, t in texts() if t] + [t for t in ODD if t] + noise(2_000) + LONG[:5]
    assert side.ranks is not None
    for t in rows:
        assert side.encode(" " + t).tolist() == plain.a.encode(" " + t, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(30))
def test_runs_are_jumped_and_groups_resolved(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 400))
    common = np.unique(rng.integers(1, 4 * n, n))
    extra = [rng.integers(1, 4 * n, int(rng.integers(0, n // (1 + seed % 5) + 1))) for _ in range(2)]
    a, b = (np.unique(np.concatenate([common, x, [4 * n]])) for x in extra)
    a_ends, b_ends, link_a, link_b = token_alignment.align(a, b)
    both = np.intersect1d(a, b)
    assert a[a_ends - 1].tolist() == both.tolist() == b[b_ends - 1].tolist()
    starts = [np.concatenate([[0], x[:-1]]) for x in (a, b)]
    overlap = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < b[j] and starts[1][j] < a[i]]
    assert list(zip(link_a.tolist(), link_b.tolist(), strict=True)) == overlap


def test_packed_links_round_trip():
    for x in ([], [5], [0, 0, 3, 70_000, 2**31 - 1, 9]):
        assert token_alignment.unpacked(token_alignment.packed(np.array(x, np.int64))).tolist() == sorted(x)


@pytest.mark.parametrize("block", [None, 3_000], ids=["", "small blocks"])
def test_token_alignment(spark, block, monkeypatch):
    rows = texts() + [(700 + i, t) for i, t in enumerate(ODD + noise(100) + LONG[:5] + ["<s>▁</s> <|endoftext|>", "\x00 <0x41>"])]
    plain = Plain().rows(rows)
    if block:  # parts and blocks far smaller than the texts: their rows come from a worker of this process
        monkeypatch.setattr(token_alignment, "BLOCK", block)
        raw = rows[28][1].encode()
        a_side, b_side = token_alignment.sides(A, B, **RANKS)
        parts = token_alignment._encoded(raw, a_side, b_side)
        assert len(parts) > 10
        whole = Plain().tokens(rows[28][1])
        assert [int(i) for a, _ in parts for i in a] == [i for i, *_ in whole[0]]
        assert [int(i) for _, b in parts for i in b] == [i for i, *_ in whole[1]]
        return
    got = token_alignment.align_tokens(documents(spark, rows), A, B, **RANKS)
    assert counted(map(tuple, got.collect())) == counted(plain)
    by_file = token_alignment.align_tokens(documents(spark, rows[:20]), A, B).collect()
    assert counted(map(tuple, by_file)) == counted(Plain().rows(rows[:20]))
    assert token_alignment.align_tokens(documents(spark).limit(0), A, B, **RANKS).collect() == []


def test_long_texts_in_blocks(spark):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdefghij é") for _ in range(rng.randrange(1, 9))) for _ in range(3_000)]
    rows = [(1, " ".join(rng.choice(vocabulary) for _ in range(900_000))), (2, "short"), (3, None), (1, "short")]
    assert len(rows[0][1]) > 2 * token_alignment.BLOCK
    got = token_alignment.align_tokens(documents(spark, rows), A, B, **RANKS).collect()
    assert counted(map(tuple, got)) == counted(Plain().rows(rows))


def test_token_alignment_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = QUERIES["op11_token_alignment"](spark, SMALL).collect()
    assert counted(map(tuple, got)) == counted(Plain().rows(rows))


# --- centroid clustering

def _clusters(rows, k, rounds=3):
    kept = [(i, [int(np.floor(64 * np.float64(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [[v for _, v in kept if nearest(v)[1] == n] for n in range(len(centroids))]
        centroids = [[sum(x) // len(m) for x in zip(*m, strict=True)] if m else c for m, c in zip(own, centroids, strict=True)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    per = {}
    for _, n, d in found:
        per[n] = per.get(n, 0) + d
    return [(i, n, d, per[n], sum(per.values()),
             hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, n, d in found]


def _vectors(spark, rows):
    extra = ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(i, v, *CLASHING) for i, v in rows], f"vec_id long, embedding array<double>, {extra}"
                                 ).repartition(3)


def test_centroid_clustering(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=64)]) for i in range(60)]
    same = [0.5] * 64
    rows += [(100 + i, same) for i in range(25)] + [(7, same), (7, rows[3][1]), (None, same), (None, rows[5][1])]
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [None] + [1.0] * 63), (204, [float("nan")] * 64),
             (205, [float("inf")] + [1.0] * 63), (206, [0.0] * 64), (207, [-0.0] * 64), (208, [1e5] + [-1e5] * 63)]
    for k in (16, 3, 500):
        got = centroid_clusters.describe_clusters(*centroid_clusters.cluster_vectors(_vectors(spark, rows), k=k)).collect()
        assert counted(map(tuple, got)) == counted(_clusters(rows, k))


def test_only_changed_components_are_read(spark):
    rows = [(i, [float(i % 5)] + [0.0] * 63) for i in range(20)]
    state = centroid_clusters.integer_vectors(_vectors(spark, rows), "vec_id", "embedding", 64, 64)
    first = np.zeros((2, 64), np.int64)
    first[1, 0] = 64
    step = np.zeros((2, 64), np.int64)
    step[1, 0] = 128
    once = centroid_clusters.moved(state, first, (first * first).sum(axis=1))
    twice = centroid_clusters.moved(once, step, ((first + step) ** 2).sum(axis=1))
    for r in twice.collect():
        assert r.dots == [0, r.vec[0] * 192] and r.distance == min(r.vec[0] ** 2, (r.vec[0] - 192) ** 2)


def test_clustering_nothing_and_too_much(spark):
    empty = centroid_clusters.cluster_vectors(_vectors(spark, [(1, None)]))
    assert centroid_clusters.describe_clusters(*empty).collect() == []
    with pytest.raises(Exception, match="after scaling"):
        centroid_clusters.cluster_vectors(_vectors(spark, [(1, [1e9] * 64)]))


def test_arrow_types():
    assert centroid_clusters._rows(pa.array([[1, 2], [3, 4]], pa.list_(pa.int32())), 2).tolist() == [[1, 2], [3, 4]]
