"""Suffix-array dedup, line dedup, embedding near-dedup, Jaccard join, components."""

import math
import random
import re

import numpy as np
import pytest
from cases import LOWER, counted, documents, roots, texts

from waymark.llm import embed_dedup, jaccard_join, line_dedup, suffix_dedup
from waymark.llm.bytehash import draw_odd
from waymark.llm.common import blocks
from waymark.llm.components import connected_components

BASE = draw_odd()


# -- suffix-array dedup ----------------------------------------------------------------

def _substrings(rows, width=400):
    seen = {}
    data = [(t or "").encode() for _, t in rows]
    for raw in data:
        for p in range(len(raw) - width + 1):
            seen[raw[p:p + width]] = seen.get(raw[p:p + width], 0) + 1
    out = []
    for (i, _), raw in zip(rows, data, strict=True):
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - width + 1):
            if seen[raw[p:p + width]] > 1:
                gone[p:p + width] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(raw), int(gone.sum()), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
    return out


def _removed(out):
    return counted((r.doc_id, r.n_bytes, sum(s["end"] - s["start"] for s in r.spans), len(r.spans), bytes(r.kept))
                   for r in out)


@pytest.mark.parametrize("options", [{}, {"max_windows": 1}, {"width": 60, "gram": 20}], ids=["", "hot", "short"])
def test_substrings(spark, options):
    rows = texts()
    out = suffix_dedup.dedup_substrings(documents(spark, rows), **options).collect()
    assert _removed(out) == counted(_substrings(rows, options.get("width", 400)))


def test_long_text_in_pieces(spark, monkeypatch):
    rng = random.Random(3)
    part = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    rows = [(1, part + "x" + part[:1700] + "y" * 900), (2, part[500:1200]), (3, "z" + part[2500:])]
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    flat = np.frombuffer(rows[0][1].encode(), np.uint8)
    import pyarrow as pa
    cut = list(suffix_dedup._pieces(pa.array([rows[0][1]]), 400))
    starts = sorted(p + before for _, before, f, off in cut
                    for _, lo, _, n, reps, _ in zip(*suffix_dedup.segments(f, off, 400, 128, BASE), strict=True)
                    for p in range(lo, lo + n * reps))
    assert starts == list(range(len(flat) - 399))  # every window once
    out = suffix_dedup.dedup_substrings(documents(spark, rows)).collect()
    assert _removed(out) == counted(_substrings(rows))


@pytest.mark.parametrize("period", ["a", "ab = ", "0123456789abcdefghijklmnopqrstuvwxyz" * 30])
def test_periodic_text_is_a_few_rows(spark, period):
    """A megabyte of one letter or of a short period makes a few segments, not one per byte."""
    rng = random.Random(8)
    prose = "".join(rng.choice("jklmnop ") for _ in range(3000))
    flat = np.frombuffer((prose + period * (1_000_000 // len(period))).encode(), np.uint8)
    out = suffix_dedup.segments(flat, np.array([0, len(flat)]), 400, 128, BASE)
    assert len(out[0]) < 200 and int((out[3] * out[4]).sum()) == len(flat) - 399
    rows = [(1, prose[:900] + period * (4_000 // len(period) + 1)), (2, period * (2_000 // len(period) + 1) + prose), (3, period * 3)]
    got = suffix_dedup.dedup_substrings(documents(spark, rows)).collect()
    assert _removed(got) == counted(_substrings(rows))


def test_megabyte_of_one_letter(spark):
    docs = spark.createDataFrame([(1, "x" * 1_500_000), (2, "y" * 399), (3, "y" * 400)], "doc_id long, text string")
    out = {r.doc_id: r for r in suffix_dedup.dedup_substrings(docs).collect()}
    assert [(s.start, s.end) for s in out[1].spans] == [(0, 1_500_000)]
    assert out[2].spans == out[3].spans == []  # each of its strings stands once


def test_long_text_after_empty_rows(spark):
    """An empty text directly before one that comes in pieces keeps its own row."""
    import pyarrow as pa
    rng = random.Random(4)
    part = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    body = "".join(rng.choices("ijklmnop ", k=2 << 20))
    long = part + body[:1 << 20] + part[:1700] + body[1 << 20:]
    column = pa.array(["", None, long, None, "", part])
    assert list(blocks(column, suffix_dedup.PIECE)) == [(0, 2), (2, 3), (3, 6)]
    assert {first for first, before, _, _ in suffix_dedup._pieces(column, 400) if before} == {2}
    rows = [(1, ""), (2, None), (3, long), (4, None), (5, ""), (6, part)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = {r.doc_id: r for r in suffix_dedup.dedup_substrings(docs).collect()}
    assert [(s.start, s.end) for s in out[3].spans] == [(0, 3000), (3000 + (1 << 20), 4700 + (1 << 20))]
    assert out[3].n_bytes == len(long) and bytes(out[3].kept).decode() == body
    assert [(s.start, s.end) for s in out[6].spans] == [(0, 3000)] and bytes(out[6].kept) == b""
    assert all(out[i].spans == [] and out[i].n_bytes == 0 for i in (1, 2, 4, 5))


def test_suffix_sorter_orders_like_bytes():
    rng = np.random.default_rng(5)
    flat = rng.integers(97, 99, 4000).astype(np.uint8)
    flat[1000:1500] = flat[:500]
    flat[2000:2600] = 97
    sorter = suffix_dedup.SuffixSorter(flat, 40, BASE)
    pos = rng.permutation(np.arange(0, 3900))[:1200]
    sizes = np.array([1, 2, 500, 697])
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    got = sorter.sort(pos, start, np.repeat(sizes, sizes))
    for a, n in zip(np.cumsum(sizes) - sizes, sizes, strict=True):
        key = [flat[p:p + 40].tobytes() for p in got[a:a + n]]
        assert key == sorted(flat[p:p + 40].tobytes() for p in pos[a:a + n])
    a, b = pos[:-1], pos[1:]
    slow = [next((k for k in range(40) if flat[x + k] != flat[y + k]), 40) for x, y in zip(a, b, strict=True)]
    assert sorter.common(a, b).tolist() == slow


def test_colliding_hashes_are_verified(monkeypatch):
    rng = np.random.default_rng(6)
    one, two = rng.integers(97, 123, 500).astype(np.uint8), rng.integers(97, 123, 500).astype(np.uint8)
    flat = np.concatenate([one, two, one])
    monkeypatch.setattr(suffix_dedup.QuickHash, "of", lambda self, a, b: np.zeros(np.shape(a), np.uint64))
    seg, window = suffix_dedup.repeated_windows(flat, np.array([0, 500, 1000, 1500]), np.array([50, 50, 50]),
                                                np.array([101, 101, 101]), np.array([9, 9, 9]), 400, BASE)
    assert sorted(zip(seg.tolist(), window.tolist(), strict=True)) == [(s, w) for s in (0, 2) for w in range(101)]


def test_substrings_of_nothing(spark):
    assert suffix_dedup.dedup_substrings(documents(spark).limit(0)).collect() == []


# -- line dedup ------------------------------------------------------------------------

def _lines(rows, least=20, docs=3):
    key = lambda s: s.strip("\x20\t\n\x0b\x0c\r").translate(LOWER)
    holders = {}
    for i, t in rows:
        for s in (t or "").split("\n"):
            if len(key(s)) >= least:
                holders.setdefault(key(s), set()).add(i)
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        keep = [s for s in ls if len(holders.get(key(s), ())) < docs
                or i == max(x for x in holders[key(s)] if x is not None)]
        out.append((i, len(ls), len(ls) - len(keep), "\n".join(keep)))
    return out


def test_lines(spark):
    rows = texts() + [(70 + k, "\n".join(f"line number {j} is long enough here" for j in range(200))) for k in range(4)]
    rows += [(90, "Ünder twenty chars é"), (91, "Ünder twenty chars é"), (92, "Ünder twenty chars é\r"),
             (93, "ünder twenty chars é")]
    out = line_dedup.dedup_lines(documents(spark, rows)).collect()
    assert counted((r.row.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out) == counted(_lines(rows))


def test_bitmaps_are_small_and_only_where_lines_go(spark):
    rows = [(k, "\n".join(f"line number {j} is long enough here" for j in range(k, 130))) for k in range(3)]
    maps = {r.id: r.keep for r in line_dedup.keep_bitmaps(documents(spark, rows)).collect()}
    assert set(maps) == {0, 1} and len(maps[0]) == 3  # 130 lines: three words
    kept = [j for j in range(130) if maps[0][j // 64] >> (j % 64) & 1]
    assert kept == [0, 1]  # lines that fewer than three documents hold


def test_lines_of_nothing(spark):
    assert line_dedup.dedup_lines(documents(spark).limit(0)).collect() == []


# -- Jaccard join ----------------------------------------------------------------------

def _sets(rows, width=4):
    out = []
    for _, t in rows:
        w = (t or "").translate(LOWER)
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", w) if x]
        out.append({tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    return out


def _similar(rows):
    sets = _sets(rows)
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    root = roots(len(rows), links)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root[k]] = min(i, low.get(root[k], i))
    return [(i, len(s), low.get(r) if s else i) for (i, _), s, r in zip(rows, sets, root, strict=True)], root, sets


@pytest.mark.parametrize("block", [256, 2], ids=["", "blocks"])
def test_jaccard(spark, block):
    rng = random.Random(2)
    rows = texts()
    chain = rows[8][1].split(" ")
    for k in range(25):  # a chain whose ends are far apart
        chain = list(chain)
        chain[6 * k % len(chain)] = f"step{k}"
        rows.append((400 + k, " ".join(chain)))
    rng.shuffle(rows)
    expected, root, sets = _similar(rows)
    out = jaccard_join.jaccard_components(documents(spark, rows), block=block).collect()
    assert counted((r.doc_id, r.n_shingles, r.component_id) for r in out) == counted(expected)


def test_one_of_each_group_stays(spark):
    rows = texts()
    expected, root, sets = _similar(rows)
    kept = jaccard_join.keep_one(documents(spark, rows)).collect()
    assert set(documents(spark, rows).columns) == set(kept[0].asDict())
    groups = {r for r, s in zip(root, sets, strict=True) if s}
    wordless = {(i, t) for (i, t), s in zip(rows, sets, strict=True) if not s}
    assert len(kept) == len(groups) + len(wordless)
    of = {}
    for (i, t), r, s in zip(rows, root, sets, strict=True):
        of[i, t] = r if s else ("alone", i, t)
    assert len({of[r.doc_id, r.text] for r in kept}) == len(kept)


def test_jaccard_of_nothing(spark):
    assert jaccard_join.jaccard_components(documents(spark).limit(0)).collect() == []
    rows = [(1, None), (2, ""), (None, " ")]
    out = jaccard_join.jaccard_components(documents(spark, rows)).collect()
    assert counted((r.doc_id, r.n_shingles, r.component_id) for r in out) == counted([(1, 0, 1), (2, 0, 2), (None, 0, None)])


def test_token_groups_lose_no_link():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(12):
        base = rng.choice(5000, 80, replace=False)
        for _ in range(6):
            s = base.copy()
            s[rng.integers(0, 80, rng.integers(0, 9))] = rng.integers(5000, 9000)
            sets.append(np.unique(s).astype(np.uint64))
    matrix = jaccard_join.TokenGroups(85)
    for k in rng.permutation(len(sets)).tolist():
        matrix.add(bytes([k]), sets[k])
    got = roots(len(sets), [(a[0], b[0]) for a, b in matrix.edges()])
    links = [(a, b) for a in range(len(sets)) for b in range(a)
             if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))]
    assert got == roots(len(sets), links)


def test_first_occurrences_stream_from_sorted_ranges(spark):
    """The plan range-partitions once and sorts each range by hash, document and position."""
    rows = [(h, 7, i, p) for h in range(5) for i in (None, *range(40)) for p in (9, 2, 5)] * 2
    lines = spark.createDataFrame(rows, "h1 long, h2 long, id long, pos int")
    out = line_dedup.first_occurrences(lines)
    assert sorted((r.h1, r.id if r.id is not None else -1, r.pos) for r in out.collect()) == sorted(
        (h, i, 2) for h in range(5) for i in range(-1, 40))
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange ") == 1 and "rangepartitioning(h1" in plan
    assert re.search(r"Sort \[h1#\d+L? ASC NULLS FIRST, h2#\d+L? ASC NULLS FIRST, id#\d+L? ASC NULLS FIRST, pos#\d+ ASC", plan)
    assert "Window [row_number()" in plan


# -- embeddings ------------------------------------------------------------------------

def _vectors(seed=0, n=300, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dims))
    rows = [(k, (centres[k % 12] + 0.3 * rng.standard_normal(dims)).astype(np.float32).tolist()) for k in range(n)]
    rows += [(500, rows[0][1]), (500, rows[0][1]), (None, rows[1][1]), (501, [-x for x in rows[2][1]]), (502, None),
             (503, []), (504, [0.0] * dims), (505, [None] * dims), (506, [math.nan] * dims), (507, [math.inf] + [1.0] * (dims - 1)),
             (508, rows[3][1][:8]), (509, [x * 4.0 for x in rows[4][1]]), (510, [1e-38] * dims), (511, [3e38] * dims)]
    return rows


def _linked(rows, threshold=0.9):
    usable = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = {}
    for k in usable:
        x = np.array(rows[k][1], np.float32).astype(np.float64)
        x = x / np.abs(x).max()
        unit[k] = x / np.linalg.norm(x)
    links = [(a, b) for a in usable for b in usable if b < a and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]
    n = [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    root = roots(len(rows), links)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[root[k]] = min(i, low.get(root[k], i))
    return [(i, n[k], low.get(root[k]), i == low.get(root[k])) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("block", [1024, 16], ids=["", "blocks"])
def test_embeddings(spark, block):
    rows = _vectors()
    table = spark.createDataFrame([(i, v, k, "x") for k, (i, v) in enumerate(rows)],
                                  "vec_id long, embedding array<float>, label int, key string").repartition(3)
    out = embed_dedup.near_duplicates(table, block=block, recall=1 - 1e-9).collect()
    assert counted((r.vec_id, r.n_links, r.component_id, r.kept) for r in out) == counted(_linked(rows))


def test_embeddings_of_nothing(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embed_dedup.near_duplicates(table).collect() == []
    alone = spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in embed_dedup.near_duplicates(alone).collect()] == [(1, 0, 1, True)]


def test_recall_against_brute_force():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 32))
    y = x + 0.42 * rng.standard_normal(x.shape)
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    close = (x * y).sum(axis=1) >= 0.9
    bits, tables = embed_dedup.tables_for(1_000_000, 0.9, 0.999, 64)
    meet = (embed_dedup._signs(x, bits, tables, 1) == embed_dedup._signs(y, bits, tables, 1)).any(axis=1)
    assert close.sum() > 500 and meet[close].mean() >= 0.998


# -- components ------------------------------------------------------------------------

def test_components(spark):
    rng = random.Random(8)
    links = [(k, k + 1) for k in range(0, 200)]  # a long path
    links += [(300, 301 + k) for k in range(300)]  # a star
    links += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)] + [(5, 5), (7, 6)]
    nodes = sorted({x for e in links for x in e})
    at = {x: k for k, x in enumerate(nodes)}
    root = roots(len(nodes), [(at[a], at[b]) for a, b in links])
    expected = {x: nodes[root[at[x]]] for x in nodes if any(x in e and e[0] != e[1] for e in links)}
    out = connected_components(spark.createDataFrame(links, "a long, b long").repartition(4))
    assert {r.node: r.component for r in out.collect()} == expected
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
