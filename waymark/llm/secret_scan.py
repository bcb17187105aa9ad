"""Secret scan by token efficiency.

A trained vocabulary covers natural text with few, long tokens; a random key has no
such tokens and needs one for every one or two characters. In a long run of key
characters every token scores by how far it falls short of the ratio's limit; the stretches of
the largest score, taken to whole parts between separators, are where a key stands, however
many words are joined to it by ``/``, ``=``, ``_`` or ``-``. A stretch of low
characters-per-token ratio is reported, unless it is a digest of a known length or an identifier
(UUID, number, words joined by case or punctuation that the vocabulary covers with few tokens
word by word). Three fixed patterns (assignments,
access keys, hex runs) are reported beside it.

Work per row only: no shuffle. A batch is screened on its raw bytes first, so Python's
patterns run on the few texts that can hold a match.

Defined results: null or empty text has no spans; very long texts are scanned whole;
repeated rows each get their own result; an empty table gives an empty result; only
the id and text columns are read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import ship, utf8

KINDS = ("assign", "access", "hex", "random")
SPAN_SCHEMA = "array<struct<kind:string,start:int,end:int,ratio:double>>"

# fixed patterns of the base kinds
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")

# what the token-efficiency test leaves alone
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
_HEX_ONLY = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_LETTER = re.compile(r"[A-Za-z]")
_SEPARATOR = re.compile(r"[/+_=-]")
_PART_OF_RUN = re.compile(r"[A-Za-z0-9]+")
_PADDING = re.compile(r"={0,2}")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


_HEX_BYTES = _table(b"0123456789abcdef")
_KEY_BYTES = _table(bytes(c for c in range(128) if chr(c).isalnum()) + b"+/_=-")
_LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def is_digest_or_number(text: str) -> bool:
    """Digests of a known length, UUIDs, and runs without a letter."""
    return bool(_HEX_ONLY.match(text) and len(text) in DIGEST_LENGTHS or _UUID.match(text)
                or not _LETTER.search(text))


def is_joined_words(text: str, tokens: Callable[[str], int], word: float = 2.5) -> bool:
    """Words joined by case, digits or punctuation: the letter parts, each by itself, take one token
    for ``word`` characters or more, as they stand or in lower case (few vocabularies have capitals)."""
    parts = [p for p in _PARTS.findall(text) if not p.isdigit()]
    return sum(map(len, parts)) >= word * sum(
        min(tokens(p), tokens(p.lower())) if p[0].isupper() else tokens(p) for p in parts)


def scoring_stretches(scores: list[float]) -> list[tuple[int, int]]:
    """All maximal scoring stretches ``(start, end)``: none can gain by growing or by being cut."""
    found: list[tuple[float, float, int, int]] = []  # score before it, score after it, start, end
    total = 0.0
    for i, score in enumerate(scores):
        if score > 0:
            new = (total, total + score, i, i + 1)
            while True:
                k = len(found) - 1
                while k >= 0 and found[k][0] >= new[0]:
                    k -= 1
                if k < 0 or found[k][1] >= new[1]:
                    found.append(new)
                    break
                new = (found[k][0], new[1], found[k][2], new[3])
                del found[k:]
        total += score
    return [(a, b) for _, _, a, b in found]


def random_stretches(run: str, sizes: list[int], max_ratio: float, min_chars: int) -> list[tuple[int, int]]:
    """Where keys may stand in a run whose tokens have the given ``sizes``: whole parts between separators that a
    scoring stretch covers by half or more, and the padding after them; else the whole run if its ratio is low."""
    whole = [(0, len(run))] if len(run) < max_ratio * len(sizes) else []
    if not _SEPARATOR.search(run):
        return whole
    ends = [0]
    for n in sizes:
        ends.append(ends[-1] + n)
    out: list[tuple[int, int]] = []
    parts = [m.span() for m in _PART_OF_RUN.finditer(run)]
    for a, b in scoring_stretches([max_ratio - n for n in sizes]):
        a, b = ends[a], ends[b]
        inside = [(s, e) for s, e in parts if 2 * (min(b, e) - max(a, s)) >= e - s]
        if inside:
            start, end = inside[0][0], inside[-1][1]
            end += len(_PADDING.match(run, end).group())
            if end - start >= min_chars and (not out or start >= out[-1][1]):
                out.append((start, end))
    return out or whole


def _runs(mask: np.ndarray, off: np.ndarray, least: int) -> np.ndarray:
    """Rows that hold a run of ``least`` set bytes or more (runs end at row ends)."""
    if not len(mask):
        return np.zeros(0, np.int64)
    edge = np.empty(len(mask) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(mask[1:], mask[:-1], out=edge[1:-1])
    edge[off[(off > 0) & (off < len(mask))]] = True
    cuts = np.flatnonzero(edge)
    starts = cuts[:-1][(np.diff(cuts) >= least) & mask[cuts[:-1]]]
    return np.searchsorted(off, starts, "right") - 1


def _holding(data: bytes, needles, off: np.ndarray) -> np.ndarray:
    """Rows in whose bytes one of ``needles`` occurs."""
    rows = set()
    for needle in needles:
        at = data.find(needle)
        while at >= 0:
            row = int(np.searchsorted(off, at, "right")) - 1
            rows.add(row)
            # on to the next row, unless the match crossed into it
            at = data.find(needle, at + 1 if at + len(needle) > off[row + 1] else int(off[row + 1]))
    return np.array(sorted(rows), np.int64)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the three fixed patterns, leftmost and non-overlapping per kind."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return out


_encoders: dict[tuple[str, str], object] = {}


def _encoder(path: str, pattern: str):
    if (path, pattern) not in _encoders:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[path, pattern] = tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path, pattern]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocab_path: str | None = None,
                 pattern: str | None = None, min_chars: int = 20, max_ratio: float = 2.0) -> DataFrame:
    """``(id, spans)``: for each row the sorted spans of all kinds, code points, end exclusive.

    A ``random`` span is a stretch of at least ``min_chars`` key characters that takes more
    than one token for every ``max_ratio`` characters; ``ratio`` is null for other kinds.
    """
    import public_tokenizers

    ship(docs.sparkSession)
    vocab_path = vocab_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    candidate = f"[A-Za-z0-9+/_=-]{{{min_chars},}}"

    def scan(batches):
        runs = re.compile(candidate)

        def tokens(run: str) -> int:
            return len(_encoder(vocab_path, pattern).encode_ordinary(run))

        def sizes(run: str) -> list[int]:
            encoder = _encoder(vocab_path, pattern)
            return list(map(len, encoder.decode_tokens_bytes(encoder.encode_ordinary(run))))

        for batch in batches:
            texts = batch.column(1)
            flat, off = utf8(texts)
            data = flat.tobytes()
            rows = np.unique(np.concatenate([
                _runs(_HEX_BYTES[flat], off, 16), _runs(_KEY_BYTES[flat], off, min_chars),
                _holding(data, (b"AKIA",), off), _holding(data.translate(_LOWER_BYTES), _KEYWORDS, off)]))
            found = {}
            for row in rows.tolist():
                text = data[off[row]:off[row + 1]].decode()
                spans = [(k, s, e, None) for k, s, e in base_spans(text)]
                for m in runs.finditer(text):
                    if is_digest_or_number(m.group()):
                        continue
                    for a, b in random_stretches(m.group(), sizes(m.group()), max_ratio, min_chars):
                        key = m.group()[a:b]
                        ratio = len(key) / tokens(key)
                        if ratio < max_ratio and not is_digest_or_number(key) and not is_joined_words(key, tokens):
                            spans.append(("random", m.start() + a, m.start() + b, ratio))
                found[row] = sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))
            spans = [[dict(zip(("kind", "start", "end", "ratio"), x, strict=True)) for x in found.get(i, ())]
                     for i in range(batch.num_rows)]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                       ("ratio", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"id {kind}, spans {SPAN_SCHEMA}").withColumnRenamed("id", id_col)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans as text."""
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col(id_col), *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(span_text(F.filter(spans, lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        span_text(spans).alias("spans"), count("random").alias("n_random"))
