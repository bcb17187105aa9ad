"""Corpus pipeline: toxicity, line de-duplication, near duplicates, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; all but the
last return the columns of ``docs``, and other columns of a row go with it unchanged, whatever their names.

Defined results, for every stage: a null text has no words, no lines to lose but one, and packs as the end mark
alone; a null id is an id like others, the last one where ids are compared; rows may share an id, and what becomes
of a row depends on its text, not on the others of its id; texts are taken whole, however long; an empty table
gives an empty one. Equal rows (same id, same text) have the same fate, but for the near-duplicate stage, which
keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import bin_packing, decontaminate, jaccard_join, line_dedup, toxicity
from waymark.llm.common import land, read_table
from waymark.llm.queries import TOXICITY_CHAIN


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain flags go; without labels none does."""
    chain = toxicity.fit_chain(docs, read_table(spark, sf_dir, "labels"), TOXICITY_CHAIN)
    return chain.transform(docs).filter(~F.col("flagged")).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that three documents hold, but for the last of them; every document stays, with an
    empty text if it has lost all its lines, and a null text stays null. ``n_chars`` follows a text that has changed."""
    out = line_dedup.dedup_lines(docs)
    lost = F.col("n_dropped") > 0
    changed = {"text": F.when(lost, F.col("kept_text")).otherwise(F.col("row.text")),
               "n_chars": F.when(lost, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))}
    return out.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id stays.

    Similar: at least 0.8 of their five-word shingles in common. Such a pair shares none of 67 bands of 5
    with probability below 4e-12. Documents without words resemble none and stay.
    """
    return jaccard_join.keep_one(docs, width=5, percent=80, bands=67)


def drop_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word benchmark passage go, or with a whole benchmark text of fewer words."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token pieces in sequences of 2048: each row its own pieces, also a repeated one."""
    return bin_packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_each_group),
    ("decontamination", drop_benchmark_documents),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"after_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: A classifier, min-hash groups and a genetic algorithm are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
