"""Toxicity with a classifier chain of linear models.

The categories are label columns in a fixed order. Each has a logistic regression over the distinct
words of a text, how many of them begin alike (prefixes, so that inflected and compound forms of a
word count together), and how many there are; from the second on it also sees the
probabilities of the categories before it. A
later model is trained with out-of-fold probabilities: the earlier model that scores a
training row has not seen it, as it has not seen the texts it will score later.

The models are fitted with Spark ML on a bounded sample of labelled rows (``max_labelled``,
taken by the hash of the id). The vocabulary is the words and prefixes that tell a category: those whose
share of positive texts is ``min_z`` standard deviations from the sample's, so that rare words do
not let a model learn its labels' mistakes by heart. Every text is
scored, whole, in one pass without a shuffle.

Defined results: null, empty or wordless text is scored by the models' intercepts; labels
that are null in a category, or of ids without a text, are left out; a category with labels of one kind
only has that kind's rate as its probability; without any labelled row probabilities are null and nothing is
flagged; a label row repeated for an id counts as often as it stands there; repeated rows
get equal results; an empty table gives an empty result; other columns pass through
``transform`` untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import land
from waymark.llm.license_scan import words_of
from waymark.session import scratch_path

PREFIXES = (4, 5, 6, 7)  # characters


def _tokenised(docs: DataFrame, kept: str, text: Column) -> DataFrame:
    """``kept``, ``tokens`` and ``size``: distinct words and, once per word, the prefixes of longer ones."""
    def starts(k: int) -> Column:
        return F.transform(F.filter("words", lambda w: F.length(w) > k),
                           lambda w: F.concat(F.substring(w, 1, k), F.lit("*")))

    return (docs.select(kept, F.array_distinct(words_of(text)).alias("words"))
            .select(kept, F.concat("words", *map(starts, PREFIXES)).alias("tokens"), F.log1p(F.size("words")).alias("size")))


@dataclass
class ToxicityChain:
    """Fitted chain: a model, or a constant rate, per category in order."""

    categories: tuple[str, ...]
    words: CountVectorizerModel | None = None
    models: list[LogisticRegressionModel | float | None] = field(default_factory=list)
    threshold: float = 0.5

    def transform(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``(row, p, flagged)``: the input row as a struct, the probabilities in order, and whether the last
        category's reaches the threshold."""
        out = _tokenised(docs.select(F.struct("*").alias("row")), "row", F.col("row")[text_col])
        out = (self.words.transform(out) if self.words else out).drop("tokens")
        for k, model in enumerate(self.models):
            out = _scored(out, model, k)
        p = F.array(*[F.col(f"p{k}") for k in range(len(self.models))])
        last = F.col(f"p{len(self.models) - 1}")
        return out.select("row", p.alias("p"), F.coalesce(last >= self.threshold, F.lit(False)).alias("flagged"))


def _features(rows: DataFrame, k: int) -> DataFrame:
    """``x``: the words and the ``k`` probabilities before."""
    return VectorAssembler(inputCols=["features", "size", *[f"p{j}" for j in range(k)]], outputCol="x",
                           handleInvalid="keep").transform(rows)


def _scored(rows: DataFrame, model: LogisticRegressionModel | float | None, k: int) -> DataFrame:
    """``p<k>`` added."""
    if not isinstance(model, LogisticRegressionModel):
        return rows.withColumn(f"p{k}", F.lit(model).cast("double"))
    out = model.transform(_features(rows, k))
    return (out.withColumn(f"p{k}", vector_to_array("probability")[1])
            .drop("x", "rawPrediction", "probability", "prediction"))


def _fitted(rows: DataFrame, k: int, label: str, seen: dict, reg: float) -> LogisticRegressionModel | float | None:
    """The category's model on rows that have its label; the rate if there is one kind of label only."""
    if not seen["n"]:
        return None
    if seen["ones"] in (0, seen["n"]):
        return float(seen["ones"] > 0)
    labelled = rows.filter(F.col(label).isNotNull()).withColumn("label", F.col(label).cast("double"))
    model = LogisticRegression(featuresCol="x", labelCol="label", regParam=reg, maxIter=60, standardization=False,
                               aggregationDepth=2).fit(_features(labelled, k))
    # a fitted model drags its training summary, and with it the session, into every task; a saved one does not
    path = scratch_path(rows.sparkSession, "chain_model")
    model.save(path)
    return LogisticRegressionModel.load(path)


def _telling_words(known: DataFrame, names: Sequence[str], min_docs: int, min_z: float, most: int) -> list[str]:
    """Words of at least ``min_docs`` labelled texts that stand apart in a category, the most telling first."""
    counts = [c for n in names for c in (F.count(n).alias(f"n_{n}"), F.sum(n).alias(f"s_{n}"))]
    total = known.agg(*counts).first().asDict()
    per_word = (known.select(*names, F.explode(F.array_distinct("tokens")).alias("word")).groupBy("word")
                .agg(F.count(F.lit(1)).alias("docs"), *counts).filter(F.col("docs") >= min_docs))
    z = F.lit(0.0)
    for n in names:
        rate = (total[f"s_{n}"] or 0) / max(1, total[f"n_{n}"])
        if 0 < rate < 1:
            seen = F.col(f"n_{n}")
            apart = F.abs(F.coalesce(f"s_{n}", F.lit(0)) - seen * rate) / F.sqrt(F.greatest(seen, F.lit(1)) * rate * (1 - rate))
            z = F.greatest(z, apart)
    told = per_word.withColumn("z", z).filter(F.col("z") >= min_z)
    return [r["word"] for r in told.orderBy(F.desc("z"), "word").limit(most).select("word").collect()]


def fit_chain(docs: DataFrame, labels: DataFrame, categories: Sequence[str], id_col: str = "doc_id",
              text_col: str = "text", *, max_labelled: int = 10_000, max_words: int = 4096, min_docs: int = 3,
              min_z: float = 5.0, folds: int = 3, reg: float = 0.001, threshold: float = 0.2) -> ToxicityChain:
    """Chain fitted to 0/1 label columns of ``labels``; the last category is the one that flags."""
    chain = ToxicityChain(tuple(categories), threshold=threshold)
    names = [f"y{k}" for k in range(len(categories))]
    # at most max_labelled rows, so the sample may be broadcast to the texts
    sample = (labels.filter(F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("id"), *[(F.col(c) > 0).cast("int").alias(n)
                                                   for c, n in zip(categories, names, strict=True)])
              .orderBy(F.xxhash64("id"), "id", *names).limit(max_labelled))
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    known = land(_tokenised(known.select(F.struct("id", *names).alias("kept"), "text"), "kept", F.col("text"))
                 .select("kept.*", "tokens", "size"), "labelled")
    words = _telling_words(known, names, min_docs, min_z, max_words)
    if not words:
        words = ["\x00"]  # no word is it: intercepts only
    chain.words = CountVectorizerModel.from_vocabulary(words, inputCol="tokens", outputCol="features")
    stats = {f"n{k}": F.count(n) for k, n in enumerate(names)} | {f"s{k}": F.sum(n) for k, n in enumerate(names)}
    rows = land(chain.words.transform(known).drop("tokens")
                .withColumn("fold", F.pmod(F.xxhash64(F.lit(13), "id"), F.lit(folds))), "training")
    seen = rows.agg(*[c.alias(n) for n, c in stats.items()]).first().asDict()
    for k, label in enumerate(names):
        whole = {"n": seen[f"n{k}"], "ones": seen[f"s{k}"] or 0}
        chain.models.append(_fitted(rows, k, label, whole, reg))
        if k + 1 < len(names):
            parts = []
            for f in range(folds):
                rest = rows.filter(F.col("fold") != f)
                n = rest.agg(F.count(label).alias("n"), F.sum(label).alias("ones")).first()
                model = _fitted(rest, k, label, {"n": n["n"], "ones": n["ones"] or 0}, reg)
                parts.append(_scored(rows.filter(F.col("fold") == f), model, k))
            unscored = F.lit(0.5)  # a fold without labels outside it
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            rows = land(out.withColumn(f"p{k}", F.coalesce(f"p{k}", unscored)), "out_of_fold")
    return chain


def classify(docs: DataFrame, labels: DataFrame, categories: Sequence[str], id_col: str = "doc_id",
             text_col: str = "text", **options) -> DataFrame:
    """``(id, p_<category>..., flagged)`` of every row of ``docs``."""
    scored = fit_chain(docs, labels, categories, id_col, text_col, **options).transform(docs, text_col)
    return scored.select(F.col("row")[id_col].alias(id_col),
                         *[F.col("p")[k].alias(f"p_{c}") for k, c in enumerate(categories)], "flagged")
