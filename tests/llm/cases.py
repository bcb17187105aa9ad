"""Rows that the training-data operators must take without crashing, and brute-force helpers."""

from __future__ import annotations

import random
import re

# extra columns whose names the operators use inside
CLASHING = ("id", "th", "doc", "row", "words", "spans", "key", "keep", "cls", "grp", "uid", "shard", "length", "p",
            "kept", "pos", "line", "sig", "component", "item", "tokens", "size", "features", "flagged", "term")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sentence(rng: random.Random, n: int) -> str:
    words = ("the of and amber kettle river stone quiet Élan über niño market window seven copper lamp harbour "
             "orchard velvet signal meadow thunder pilot garden silver notebook").split()
    return " ".join(rng.choice(words) + rng.choice(["", "", ",", "."]) for _ in range(n))


def texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """``(doc_id, text)``: null and empty texts, null and shared ids, equal rows, copies, and a long text."""
    rng = random.Random(seed)
    base = [sentence(rng, 160) for _ in range(6)]
    shared = "This Line stands in many documents, word for word."
    passage = sentence(rng, 120)
    rows: list[tuple[int | None, str | None]] = [
        (0, None), (1, ""), (2, " \t\n"), (3, "\n\n"), (4, "one"), (5, "one two three"), (6, "ONE  two\tthree"),
        (7, "!!! ... ???"), (None, base[0]), (None, None), (8, base[0]), (8, base[0]), (9, base[1]), (9, base[2]),
        (10, base[0] + " end"), (11, base[3].replace("amber", "AMBER")), (12, base[3]),
        (13, shared + "\n" + base[4]), (14, "  " + shared.upper() + "\t\n" + base[5]), (15, shared), (16, shared),
        (17, base[4] + "\n" + passage), (18, passage + "\nand more"), (19, "x " + passage), (20, passage[3:]),
        (21, "a" * 1500), (22, "ab" * 700), (23, "\U0001f600é" * 200), (24, sentence(rng, 30_000)),
    ]
    near = base[1].split(" ")
    for i in range(12):
        words = list(near)
        words[rng.randrange(len(words))] = f"changed{i}"
        rows.append((30 + i, " ".join(words)))
    rows.append((60, "\n".join([shared] * 5 + ["short", "short"])))
    return rows


def documents(spark, rows=None):
    """The rows as a table of several partitions with clashing extra columns."""
    rows = texts() if rows is None else rows
    extra = ", ".join(f"{c} string" for c in CLASHING)
    wide = [(i, t, *[None if k % 3 == 0 else f"{c}{k}" for c in CLASHING]) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(wide, f"doc_id long, text string, {extra}").repartition(3)


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def roots(n: int, links) -> list[int]:
    """Smallest position connected to each of ``n`` by the links."""
    low = list(range(n))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        low[y] = x
    return [root(i) for i in range(n)]


def counted(rows) -> dict:
    """Rows as a multiset."""
    out: dict = {}
    for r in rows:
        out[r] = out.get(r, 0) + 1
    return out
