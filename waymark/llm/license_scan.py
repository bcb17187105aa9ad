"""License scan with a positional rare-token index, in DataFrame operations alone.

Templates are notices, headers and tags of licenses, each with mandatory key phrases. Every text is
split into words once; its base phrases are counted there, and the places of the templates' words
are kept (words that stand everywhere, like "the", are left out: they would not make the index). Their
document frequencies over the whole corpus give the words' IDF, and each template keeps its
highest-IDF words in an index ``word → (template, position)``. A file looks up every index word it holds;
their postings, shifted by the template position, vote for one place of the template in the file. At a
place with enough of the template's index words, by IDF, the key phrases are verified word by word in
the text. A notice that stands in a file word for word has all its index words in place, so keeping a few
words a template loses none of those.

Templates and their words are a fixed list, so what is broadcast is bounded by it and
not by the corpus.

Defined results: null, empty or wordless text has no words, no labels, null positions
and score 0; very long texts are scanned whole; rows equal in id and text give equal
results; an empty table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.common import ascii_lower, doc_key, land

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Fixed base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Fixed notices: (label, words of the notice, mandatory key phrases within it).
TEMPLATES = (
    ("agpl", "gnu affero general public license", ("affero general public license",)),
    ("agpl-3.0", "you can redistribute it and or modify it under the terms of the gnu affero general public license as "
     "published by the free software foundation either version 3 of the license", ("affero general public license", "version 3")),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http "
     "www apache org licenses license 2 0", ("except in compliance with the license", "apache org licenses license 2 0")),
    ("as-is", "the software is provided as is without warranty of any kind express or implied",
     ("provided as is without warranty",)),
    ("as-is", "this software is provided by the copyright holders and contributors as is and any express or implied warranties",
     ("copyright holders and contributors as is",)),
    ("as-is", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on "
     "an as is basis without warranties or conditions of any kind", ("distributed on an as is basis",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("bsd-2-clause", "bsd 2 clause license", ("bsd 2 clause",)),
    ("bsd-3-clause", "bsd 3 clause license", ("bsd 3 clause",)),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
     "promote products derived from this software without specific prior written permission",
     ("endorse or promote products derived from this software",)),
    ("bsl-1.0", "boost software license version 1 0", ("boost software license",)),
    ("cc-by", "creative commons attribution 4 0 international", ("creative commons attribution 4 0",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international", ("attribution noncommercial",)),
    ("cc-by-nd", "creative commons attribution noderivatives 4 0 international", ("attribution noderivatives",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international", ("attribution sharealike",)),
    ("cc0", "released under cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    ("creative-commons", "licensed under a creative commons attribution 4 0 international license",
     ("creative commons attribution",)),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
     ("eclipse public license",)),
    ("gpl-2.0", "gnu general public license version 2", ("general public license version 2",)),
    ("gpl-2.0", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
     "free software foundation either version 2 of the license", ("gnu general public license as published", "either version 2")),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-3.0", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
     "free software foundation either version 3 of the license", ("gnu general public license as published", "either version 3")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
     "hereby granted", ("permission to use copy modify and or distribute this software",)),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("lgpl-2.1", "under the terms of the gnu lesser general public license as published by the free software foundation either "
     "version 2 1 of the license", ("lesser general public license", "version 2 1")),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files", ("permission is hereby granted free of charge",)),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("mpl-2.0", "mozilla public license version 2 0", ("mozilla public license version 2 0",)),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", ("sil open font license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software",)),
    ("wtfpl", "do what the fuck you want to public license", ("what the fuck you want to",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
     "for any damages arising from the use of this software", ("will the authors be held liable",)),
)

#: Fixed identifiers that a tag ``SPDX-License-Identifier: <identifier>`` names: words of the identifier → label.
SPDX = {"mit": "mit", "apache 2 0": "apache-2.0", "bsd 2 clause": "bsd-2-clause", "bsd 3 clause": "bsd-3-clause", "isc": "isc",
        "gpl 2 0": "gpl-2.0", "gpl 3 0": "gpl-3.0", "lgpl 2 1": "lgpl-2.1", "lgpl 3 0": "lgpl", "agpl 3 0": "agpl-3.0",
        "mpl 2 0": "mpl-2.0", "epl 2 0": "epl-2.0", "cc0 1 0": "cc0", "cc by 4 0": "cc-by", "cc by sa 4 0": "cc-by-sa",
        "unlicense": "unlicense", "zlib": "zlib", "bsl 1 0": "bsl-1.0", "ofl 1 1": "ofl-1.1", "wtfpl": "wtfpl"}
_TAG = "spdx license identifier"

#: Words that stand in most texts: never in the index, so their places are not kept.
COMMON = frozenset("a an and any are as at be by can do for from in is it its of on or that the this to under use what will with you "
                   "your may not".split())


def notices(templates: Sequence[tuple[str, str, Sequence[str]]] = TEMPLATES) -> list[tuple[str, str, Sequence[str]]]:
    """The templates and a notice for each tag."""
    return [*templates, *[(label, f"{_TAG} {words}", (f"{_TAG} {words}",)) for words, label in SPDX.items()]]


def words_of(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, split at ASCII characters that are no letter or digit."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, -1), lambda w: w != "")


def _places(words: Column, phrase: str) -> Column:
    """Word positions where the phrase stands; a text without the phrase's words is not walked."""
    parts = phrase.split()
    there = F.lit(True)
    for p in parts:
        there = there & F.array_contains(words, p)

    def at(i: Column) -> Column:
        hit = F.get(words, i) == parts[0]
        for j, p in enumerate(parts[1:], 1):
            hit = hit & F.coalesce(F.get(words, i + j) == p, F.lit(False))
        return hit

    return F.when(there, F.filter(F.sequence(F.lit(0), F.size(words) - 1), at)).otherwise(F.array().cast("array<int>"))


def scanned_words(docs: DataFrame, vocab: Sequence[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Landed ``(doc, n_words, n_base, first_word, last_word, base_labels, hits)`` of every row.

    Each text is split once; ``hits`` has the words of ``vocab`` with their positions.
    """
    words = docs.select(doc_key(id_col, text_col), F.inline(F.array(F.struct(words_of(F.col(text_col)).alias("words")))))
    placed = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word"))),
                      lambda x: x["word"].isin(list(vocab)))
    found = words.select("doc", F.size("words").cast("long").alias("n_words"),
                         *[_places(F.col("words"), p).alias(label) for p, label in BASE_PHRASES.items()],
                         placed.alias("hits"))
    every = F.concat(*[F.col(f"`{label}`") for label in BASE_PHRASES.values()])
    labels = F.array_compact(F.array(*[F.when(F.size(F.col(f"`{label}`")) > 0, F.lit(label))
                                       for label in sorted(BASE_PHRASES.values())]))
    return land(found.select("doc", "n_words", F.size(every).cast("long").alias("n_base"),
                             F.array_min(every).cast("long").alias("first_word"),
                             F.array_max(every).cast("long").alias("last_word"), labels.alias("base_labels"), "hits"),
                "license_words")


def _literal_rows(spark: SparkSession, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """A small fixed table, from literals."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in r.items()]) for r in rows])))


def rare_word_index(scanned: DataFrame, entries: Sequence[tuple[str, str, Sequence[str]]], index_words: int) -> DataFrame:
    """Landed ``(nr, word, at, idf, of)``: the ``index_words`` words of the highest IDF of each notice, with their places;
    ``of`` is the IDF of all of them. Bounded by the fixed list."""
    n_docs = scanned.select(F.count(F.lit(1))).scalar()
    df = (scanned.select(F.explode(F.array_distinct("hits.word")).alias("word"))
          .groupBy("word").agg(F.count(F.lit(1)).alias("df")))
    places = _literal_rows(scanned.sparkSession, [
        {"nr": nr, "word": w, "at": i} for nr, (_, notice, _) in enumerate(entries)
        for i, w in enumerate(notice.split()) if w not in COMMON])
    idf = F.log((n_docs + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1e-6
    rank = F.row_number().over(Window.partitionBy("nr").orderBy(F.desc("idf"), "at"))
    return land(places.join(df, "word", "left").withColumn("idf", idf)
                .withColumn("rank", rank).filter(F.col("rank") <= index_words)
                .withColumn("of", F.sum("idf").over(Window.partitionBy("nr")))
                .select("nr", "word", "at", "idf", "of"), "license_index")


def _phrases_stand(words: Column, start: Column, nr: Column, entries: Sequence[tuple[str, str, Sequence[str]]]) -> Column:
    """Whether all key phrases of notice ``nr`` stand in ``words`` where the notice at ``start`` has them."""
    out = F.lit(False)
    for k, (_, notice, keys) in enumerate(entries):
        met = F.lit(True)
        for key in keys:
            at = f" {notice} ".split(f" {key} ")[0].count(" ")
            parts = key.split()
            met = met & (start + at >= 0) & F.arrays_overlap(
                F.array(F.slice(words, F.greatest(start + at + 1, F.lit(1)), len(parts))), F.array(F.array(*map(F.lit, parts))))
        out = F.when(nr == k, met).otherwise(out)
    return out


def template_places(docs: DataFrame, scanned: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    templates: Sequence[tuple[str, str, Sequence[str]]] = TEMPLATES, index_words: int = 6,
                    min_share: float = 0.5) -> DataFrame:
    """``(doc, label, start, share)``: verified places of templates, ``start`` in words.

    ``index_words``: words kept per template; ``min_share``: the part of a template's index words (by IDF)
    that must vote for the place. A file looks up all index words it holds: the list bounds them.
    """
    entries = notices(templates)
    index = rare_word_index(scanned, entries, index_words)
    votes = (scanned.select("doc", F.inline("hits")).join(F.broadcast(index), "word")
             .select("doc", "nr", (F.col("pos") - F.col("at")).alias("start"), "at", "idf", "of").distinct()
             .groupBy("doc", "nr", "start").agg((F.sum("idf") / F.max("of")).alias("share"))
             .filter(F.col("share") >= min_share))
    # at most a few places for each occurrence of an index word
    voted = land(votes.groupBy("doc").agg(F.collect_list(F.struct("nr", "start", "share")).alias("votes")), "license_votes")
    texts = docs.select(doc_key(id_col, text_col), F.col(text_col).alias("text"))
    label = F.element_at(F.array(*[F.lit(x) for x, _, _ in entries]), F.col("nr") + 1)
    return (texts.join(voted, "doc").select("doc", "votes", F.inline(F.array(F.struct(words_of(F.col("text")).alias("words")))))
            .select("doc", F.inline(F.filter("votes", lambda v: _phrases_stand(F.col("words"), v["start"], v["nr"], entries))))
            .select("doc", label.alias("label"), "start", "share"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: words, base places, all labels, score.

    ``score``: 1 with a base phrase, else the largest share of a verified template, else 0.
    """
    entries = notices(options.get("templates", TEMPLATES))
    vocab = sorted({w for _, notice, _ in entries for w in notice.split()} - COMMON)
    scanned = scanned_words(docs, vocab, id_col, text_col)
    found = (template_places(docs, scanned, id_col, text_col, **options).groupBy("doc")
             .agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))
             .withColumnRenamed("doc", "f_doc"))
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("found", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.coalesce("share", F.lit(0.0))))
    return (scanned.join(found, F.col("doc") == F.col("f_doc"), "left")
            .select(F.col("doc.id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels",
                    labels.alias("labels"), score.alias("score")))
