"""Line de-duplication by range-partitioned line hashes.

Every line long enough gets a 128-bit hash of its key. Only hashes travel:
range-partitioned by (hash, document) with the position as secondary sort, so a line that a third of
all documents hold is spread over as many ranges as its rows need. Each range streams
its sorted rows and lets the first line of each (hash, document) pass; documents are counted and the
largest id is kept per range, and a line's partial rows, one per range, then meet. The result is a bitmap
per document (64 lines per word, bit 1 = keep) instead of text; documents that lose
nothing have none.

Defined results: null or empty text is one empty line; very long texts are split whole
(bitmaps answer a line by its index, whatever the number of lines); documents
are counted by distinct id, and rows sharing an id each keep or lose their own lines;
a null id counts as one document, the smallest; an empty table gives an empty result;
only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import ascii_lower, doc_key, land, text_hash

BLANKS = " \t\n\x0b\f\r"  # fixed: what is stripped at both ends of a line


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(id, th, n_lines, pos, h1, h2)`` of each line whose key has ``min_chars`` code points."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.btrim(F.col("line"), F.lit(BLANKS))
    return (docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("th"),
                        F.split(text, "\n", -1).alias("lines"))
            .select("id", "th", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
            .select("id", "th", "n_lines", "pos", key.alias("key"))
            .filter(F.length("key") >= min_chars)
            .withColumn("key", ascii_lower(F.col("key")))
            .select("id", "th", "n_lines", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit(1), "key").alias("h2")))  # the second hash has another seed


def first_occurrences(lines: DataFrame) -> DataFrame:
    """``(h1, h2, id, pos)``: the first line of each hash in each document.

    The rows are range-partitioned by (hash, document); that is also how the numbering wants them, so it only sorts
    each range by position within them and streams the rows that come first.
    """
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = Window.partitionBy("h1", "h2", "id").orderBy("pos")
    return (lines.select("h1", "h2", "id", "pos").repartitionByRange(n, "h1", "h2", "id")
            .withColumn("nth", F.row_number().over(order)).filter(F.col("nth") == 1).drop("nth"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = 20,
                 min_docs: int = 3) -> DataFrame:
    """``(id, th, keep)`` of every document that loses a line: ``keep[i div 64]`` has bit ``i % 64`` for line ``i``.

    A line whose key ``min_docs`` documents hold stays in the largest id alone.
    """
    lines = land(line_hashes(docs, id_col, text_col, min_chars), "lines")
    firsts = first_occurrences(lines)
    # landed, so that the join's two sides are plain shuffles and a hot line can be split in it
    repeated = land(firsts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("keeper"))
                    .filter(F.col("docs") >= min_docs).select("h1", "h2", "keeper"), "repeated_lines")
    lost = (lines.join(repeated, ["h1", "h2"])
            .filter(~F.col("id").eqNullSafe(F.col("keeper")))
            .select("id", "th", "n_lines", "pos"))
    words = (lost.groupBy("id", "th", "n_lines", F.shiftright("pos", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")))
    # words without a lost line are filled in, so that a line's word is found by its index
    return (words.groupBy("id", "th", "n_lines")
            .agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("lost"))
            .select("id", "th", F.explode(F.sequence(F.lit(0), F.shiftright(F.col("n_lines") - 1, 6))).alias("word"),
                    "lost")
            .select("id", "th", "word", F.bitwise_not(F.coalesce(F.col("lost")[F.col("word")], F.lit(0).cast("long")))
                    .alias("bits"))
            .groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))
            .select("id", "th", F.col("keep.bits").alias("keep")))


def _kept(lines: Column, keep: Column) -> Column:
    return F.when(keep.isNull(), lines).otherwise(
        F.filter(lines, lambda _, i: F.getbit(F.get(keep, F.shiftright(i, 6)), F.pmod(i, F.lit(64))) == 1))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, n_lines, n_dropped, kept_text)``: every input row as a struct, and its lines that stay."""
    rows = docs.select(F.struct("*").alias("row"), doc_key(id_col, text_col))
    lines = F.split(F.coalesce(F.col("row")[text_col], F.lit("")), "\n", -1)
    return (rows.join(bitmaps.select(F.struct("id", "th").alias("doc"), "keep"), "doc", "left")
            .select("row", lines.alias("lines"), "keep")
            .select("row", F.size("lines").cast("long").alias("n_lines"),
                    _kept(F.col("lines"), F.col("keep")).alias("kept"))
            .select("row", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"),
                    F.array_join("kept", "\n").alias("kept_text")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = 20,
                min_docs: int = 3) -> DataFrame:
    """Bitmaps made and applied: ``(row, n_lines, n_dropped, kept_text)``."""
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_chars=min_chars, min_docs=min_docs),
                         id_col, text_col)
