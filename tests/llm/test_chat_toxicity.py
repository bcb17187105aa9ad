"""Tool-call linking and the toxicity chain."""

import json
import math
import random

import numpy as np
import pytest
from cases import documents, sentence, texts, words
from pyspark.sql import functions as F

from waymark.llm import tool_calls, toxicity
from waymark.llm.queries import TURN_SCHEMAS

SCHEMAS = {"search": {"q": {"type": "string", "required": True, "min_length": 2}, "n": {"type": "integer"},
                      "opts": {"type": "object"}, "tags": {"type": "array"}, "deep": {"type": "boolean"},
                      "rate": {"type": "number"}},
           "sum": {"a": {"type": "string", "required": True}, "b": {"type": "string"}}}
CALLS = [  # conv_id, turn, call_id, name, arguments
    (1, 0, "a", "search", '{"q": "hello", "n": 3, "opts": {"z": 1, "b": [1, 2]}}'),
    (1, 1, "b", "sum", '{"a": "$a", "b": "$c"}'), (1, 2, "c", "sum", '{"a": "$a"}'),
    (1, 3, "d", "sum", '{"a": "$nowhere", "b": "$b"}'),
    (1, 4, "x", "sum", '{"a": "$y"}'), (1, 5, "y", "sum", '{"a": "$x"}'), (1, 6, "z", "sum", '{"a": "$y"}'),
    (2, 0, "a", "search", '{"n": "3", "tags": 1, "deep": "no", "rate": true, "opts": [1], "more": 0, "q": "h"}'),
    (2, 1, "b", "search", "not json"), (2, 2, "c", "search", None), (2, 3, "d", "search", "[1]"), (2, 4, "e", "search", ""),
    (2, 5, "f", "unknown", "{}"), (2, 6, "g", None, '{"q": "ok"}'), (2, 7, None, "search", '{"q": "ok"}'),
    (None, 0, "a", "search", '{"q": "ok"}'), (2, 8, "a", "search", '{"q": "later"}'),
    (3, 0, "a", "search", '{"q": "twice"}'), (3, 0, "a", "search", '{"q": "twice"}'),
    (3, 1, "é", "search", '{"q": "Ünï \\"q\\" \\n /", "n": 1, "rate": 1.5, "deep": true, "tags": ["$a"]}'),
    (3, 2, "long", "search", json.dumps({"q": "w " * 100_000})),
]
RESULTS = [  # conv_id, turn, call_id, content
    (1, 1, "a", "ra"), (1, 9, "a", "again"), (1, 2, "b", None), (2, 9, "zz", "orphan"), (2, 9, None, "no id"),
    (None, 9, "a", "no conversation"), (3, 1, "a", "same"), (3, 1, "a", "same"), (3, 2, "é", ""),
]


def _link(spark, calls=CALLS, results=RESULTS):
    c = spark.createDataFrame([(*r, "x", "y") for r in calls],
                              "conv_id long, turn long, call_id string, name string, arguments string, level string, args string")
    r = spark.createDataFrame([(*x, "x") for x in results], "conv_id long, turn long, call_id string, content string, status string")
    return tool_calls.link_tool_calls(c.repartition(3), r.repartition(2), SCHEMAS).collect()


def test_linking(spark):
    out = _link(spark)
    by = {(r.conv_id, r.turn, r.call_id): r for r in out if r.name is not None or r.turn is not None}
    assert len(out) == len(set(CALLS)) + len(set(RESULTS)) - 4  # four results have found their calls
    status = {k: r.status for k, r in by.items()}
    assert status[1, 0, "a"] == "linked" and by[1, 0, "a"].content == "ra" and by[1, 0, "a"].result_turn == 1
    assert status[1, 1, "b"] == "linked" and by[1, 1, "b"].content is None
    assert status[1, 2, "c"] == "no_result" and status[2, 7, None] == "no_id" and status[None, 0, "a"] == "no_id"
    assert status[2, 8, "a"] == "duplicate_call" and by[3, 0, "a"].copies == 2 and by[3, 0, "a"].result_copies == 2
    rest = sorted(((r.content, r.status) for r in out if r.turn is None))
    assert rest == [("again", "duplicate_result"), ("no conversation", "no_call"), ("no id", "no_call"), ("orphan", "no_call")]


def test_order(spark):
    by = {r.call_id: r for r in _link(spark) if r.conv_id == 1 and r.turn is not None}
    assert {k: by[k].level for k in "abcdxyz"} == {"a": 0, "c": 1, "b": 2, "d": 3, "x": None, "y": None, "z": None}
    assert (by["d"].refs, by["d"].dangling, by["b"].refs, by["b"].dangling) == (2, 1, 2, 0)


def test_levels_of_long_chains_trees_and_cycles(spark):
    rng = random.Random(4)
    edges = [(1, f"c{k}", f"c{k - 1}") for k in range(1, 130)]  # one long chain
    edges += [(2, f"t{k}", f"t{rng.randrange(k)}") for k in range(1, 80) for _ in range(rng.randrange(1, 4))]
    edges += [(3, "a", "b"), (3, "b", "c"), (3, "c", "a"), (3, "d", "a"), (3, "e", "d"), (3, "e", "root"), (3, "f", "root")]
    calls = sorted({(c, x) for c, a, b in edges for x in (a, b)})
    needs = {}
    for c, a, b in edges:
        needs.setdefault((c, a), set()).add((c, b))
    level = {x: 0 for x in calls if x not in needs}
    while True:
        new = {x: 1 + max(level[y] for y in ys) for x, ys in needs.items() if x not in level and all(y in level for y in ys)}
        if not new:
            break
        level.update(new)
    out = tool_calls.topological_levels(spark.createDataFrame(calls, "conv_id long, call_id string"),
                                        spark.createDataFrame(edges, "conv_id long, call_id string, needs string"))
    assert {(r.conv_id, r.call_id): r.level for r in out.collect()} == level and level[1, "c129"] == 129
    assert (3, "e") not in level and level[3, "f"] == 1


def test_validation_and_canonical_json(spark):
    by = {(r.conv_id, r.turn): r for r in _link(spark) if r.turn is not None}
    assert by[1, 0].errors == [] and by[1, 0].canonical == '{"n":3,"opts":{"b":[1,2],"z":1},"q":"hello"}'
    assert by[2, 0].errors == ["short:q", "type:deep", "type:n", "type:opts", "type:rate", "type:tags", "unknown_parameter"]
    assert [by[2, k].errors for k in (1, 2, 3, 4)] == [["bad_json"]] * 4 and by[2, 1].canonical is None
    assert by[2, 5].errors == by[2, 6].errors == ["unknown_tool"]
    assert by[3, 1].errors == [] and json.loads(by[3, 1].canonical) == json.loads(CALLS[-2][4])
    assert by[3, 1].canonical == json.dumps(json.loads(CALLS[-2][4]), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert by[3, 2].errors == [] and len(by[3, 2].canonical) > 200_000


def test_references_at_any_depth(spark):
    calls = [(1, 0, "a", "t", "{}"), (1, 1, "b", "t", "{}"),
             (1, 2, "c", "t", '{"list": ["$a"], "q": {"x": "$b", "y": [[{"z": "$a"}]]}}'),
             (1, 3, "d", "t", '{"q": [["say \\"$a\\"", "$a b", "x$a", "$"], {"$b": 1}], "n": ["$gone"]}'), (1, 4, "e", "t", '{"deep": [[["$c"]]]}')]
    out = tool_calls.link_tool_calls(
        spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string"),
        spark.createDataFrame([], "conv_id long, turn long, call_id string, content string"), {"t": {}}).collect()
    by = {r.call_id: (r.refs, r.dangling, r.level) for r in out}
    assert by == {"a": (0, 0, 0), "b": (0, 0, 0), "c": (2, 0, 1), "d": (1, 1, 0), "e": (1, 0, 2)}


RULES = {"t": {"s": {"type": "string", "min_length": 2, "max_length": 4, "pattern": "^[a-z]+$", "enum": ["ab", "abc", "AB", "x"]},
               "n": {"type": "integer", "minimum": 1, "maximum": 9, "enum": [1, 5, 12]},
               "r": {"type": "number", "required": True, "maximum": 2.5},
               "o": {"type": "object", "properties": {"k": {"type": "string", "required": True},
                                                      "l": {"type": "array", "items": {"type": "integer", "minimum": 0}}}},
               "it's": {"type": "array", "items": {"type": "object", "properties": {"b": {"type": "boolean"}}}}}}


def test_rules(spark):
    cases = {
        '{"s": "ab", "n": 5, "r": 2}': [], '{"s": "abc", "n": 1.0, "r": 1.5}': [], '{"s": "AB", "r": 0}': ["pattern:s"],
        '{"s": "x", "n": 12, "r": 3}': ["large:n", "large:r", "short:s"], '{"s": "abcde", "n": 0, "r": 0}': ["enum:n", "enum:s", "long:s", "small:n"],
        '{"s": null, "n": null, "r": null, "o": null}': ["missing:r"], '{"n": 5.5, "r": "1"}': ["type:n", "type:r"],
        '{"r": 1, "o": {"l": [1, -2, "x", -3]}}': ["missing:o.k", "small:o.l[]", "type:o.l[]"],
        '{"r": 1, "o": {"k": "y", "l": 4}}': ["type:o.l"], '{"r": 1, "o": {"k": "y", "l": [], "m": 1}}': [],
        '{"r": 1, "it\'s": [{"b": 1}, {"b": true}, {}, 3]}': ["type:it's[]", "type:it's[].b"], '{"r": 1, "o": [1]}': ["type:o"],
    }
    calls = [(1, i, f"c{i}", "t", a) for i, a in enumerate(cases)]
    out = tool_calls.link_tool_calls(
        spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string"),
        spark.createDataFrame([], "conv_id long, turn long, call_id string, content string"), RULES).collect()
    assert {list(cases)[r.turn]: r.errors for r in out} == cases


def test_repeated_identifier_goes_round_the_join(spark):
    """The outer join sees each identifier once: rows that repeat one, or have none, are added beside it."""
    calls = [(1, k, "same", "t", "{}") for k in range(300)] + [(1, k, None, "t", "{}") for k in range(300, 400)]
    results = [(1, k, "same", f"r{k}") for k in range(50)] + [(None, 1, "same", "x")]
    out = tool_calls.link_tool_calls(
        spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string"),
        spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string"), {"t": {}})
    status = [r.status for r in out.collect()]
    assert {x: status.count(x) for x in set(status)} == {
        "linked": 1, "duplicate_call": 299, "no_id": 100, "duplicate_result": 49, "no_call": 1}


def test_linking_nothing(spark):
    assert _link(spark, [], []) == []
    assert [r.status for r in _link(spark, CALLS[:1], [])] == ["no_result"]
    assert [r.status for r in _link(spark, [], RESULTS[:1])] == ["no_call"]


def test_turns(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", ""),
             (1, 4, None, "who"), (2, 0, "user", None), (None, None, None, None), (3, 5, "assistant", "lost")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = tool_calls.link_tool_calls(*tool_calls.turns_as_calls(table), TURN_SCHEMAS).collect()
    by = {(r.conv_id, r.call_id): r for r in out}
    assert by[1, "call_1"].content == "hello" and by[1, "call_1"].level == 1
    assert by[1, "call_3"].errors == ["short:text"] and by[1, "call_3"].level == 2
    assert by[2, "call_0"].errors == ["missing:text"] and by[3, "call_4"].status == "no_call"
    assert by[None, None].status == "no_id" and len(out) == 7


# -- toxicity --------------------------------------------------------------------------

RUDE = ("grunkle", "snozz", "blather")
SPAM = ("buynow", "clickhere")


def _corpus(n=500, seed=3):
    rng, docs, labels = random.Random(seed), [], []
    for k in range(n):
        words = sentence(rng, rng.randrange(5, 80)).split(" ")
        spam = rng.random() < 0.3
        # rude texts are mostly spam as well: the first category helps the second
        rude = rng.random() < (0.6 if spam else 0.08)
        for word, on in ((rng.choice(SPAM), spam), (rng.choice(RUDE) + rng.choice(["", "ed", "ing"]), rude)):
            if on:
                words[rng.randrange(len(words))] = word
                words.append(word)
        docs.append((k, " ".join(words)))
        labels.append((k, int(spam), int(rude)))
    return docs, labels


def _labels(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, spam int, rude int, tokens string")


def test_held_out_accuracy(spark):
    docs, labels = _corpus()
    train = [r for r in labels if r[0] % 2]
    out = toxicity.classify(documents(spark, docs), _labels(spark, train), ("spam", "rude")).collect()
    assert len(out) == len(docs)
    held = [(r, labels[r.doc_id]) for r in out if r.doc_id % 2 == 0]
    assert np.mean([r.flagged == bool(x[2]) for r, x in held]) > 0.95
    assert np.mean([(r.p_spam > 0.5) == bool(x[1]) for r, x in held]) > 0.95


def _counts(text, vocabulary):
    """A text's features, by hand: its distinct words, how many of them begin alike, and how many there are."""
    own = sorted(set(words(text)))
    tokens = own + [w[:k] + "*" for k in toxicity.PREFIXES for w in own if len(w) > k]
    return [tokens.count(v) for v in vocabulary] + [math.log1p(len(own))]


def _regression(x, y, reg):
    """Logistic regression with a squared penalty on all but the intercept, by Newton's method."""
    x1, w = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    ridge = reg * np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x1 @ w))
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 / len(y) + ridge + 1e-12 * np.eye(len(w)),
                               x1.T @ (p - y) / len(y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    return lambda z: 1 / (1 + np.exp(-np.column_stack([z, np.ones(len(z))]) @ w))


def test_chain_by_brute_force(spark):
    """The whole chain in plain arrays: telling words, out-of-fold probabilities, both regressions, all scores."""
    docs, labels = _corpus(240)
    text = dict(docs)
    chain = toxicity.fit_chain(documents(spark, docs), _labels(spark, labels), ("spam", "rude"), reg=0.01)
    vocabulary = list(chain.words.vocabulary)
    every = {}
    for i, _, _ in labels:
        own = set(words(text[i]))
        for t in own | {w[:k] + "*" for k in toxicity.PREFIXES for w in own if len(w) > k}:
            every.setdefault(t, []).append(i)
    z = {}
    for t, ids in every.items():
        if len(ids) >= 3:
            for c in (1, 2):
                rate = sum(r[c] for r in labels) / len(labels)
                ones = sum(r[c] for r in labels if r[0] in set(ids))
                z[t] = max(z.get(t, 0), abs(ones - len(ids) * rate) / math.sqrt(len(ids) * rate * (1 - rate)))
    assert set(vocabulary) == {t for t, v in z.items() if v >= 5.0}
    folds = {r.id: r.fold for r in spark.createDataFrame([(i,) for i, _ in docs], "id long").select(
        "id", F.pmod(F.xxhash64(F.lit(13), "id"), F.lit(3)).alias("fold")).collect()}
    ids = [r[0] for r in labels]
    x = np.array([_counts(text[i], vocabulary) for i in ids], float)
    spam, rude = (np.array([r[c] for r in labels], float) for c in (1, 2))
    fold = np.array([folds[i] for i in ids])
    out_of_fold = np.zeros(len(ids))
    for f in range(3):
        out_of_fold[fold == f] = _regression(x[fold != f], spam[fold != f], 0.01)(x[fold == f])
    first = _regression(x, spam, 0.01)
    second = _regression(np.column_stack([x, out_of_fold]), rude, 0.01)
    wide = np.array([_counts(t, vocabulary) for _, t in docs], float)
    p0 = first(wide)
    p1 = second(np.column_stack([wide, p0]))
    got = {r.row.doc_id: r.p for r in chain.transform(documents(spark, docs)).collect()}
    for k, (i, _) in enumerate(docs):
        assert abs(got[i][0] - p0[k]) < 0.02 and abs(got[i][1] - p1[k]) < 0.02, (i, got[i], p0[k], p1[k])


def test_chain_feeds_probabilities_on(spark):
    docs, labels = _corpus()
    # the second category is the first one: only the probability tells it in texts whose words say nothing
    chain = toxicity.fit_chain(documents(spark, docs), _labels(spark, [(i, s, s) for i, s, _ in labels]), ("spam", "rude"))
    weights = chain.models[1].coefficients.toArray()
    n_words = len(chain.words.vocabulary)
    assert len(weights) == n_words + 2 and weights[n_words + 1] > 0
    out = chain.transform(documents(spark, docs))
    assert out.columns == ["row", "p", "flagged"] and set(out.schema["row"].dataType.names) == set(documents(spark, docs).columns)


def test_odd_texts_and_labels(spark):
    docs, labels = _corpus(200)
    rows = docs + [(i, t) for i, t in texts() if i is None or i >= 400] + [(900, None), (901, ""), (901, ""), (None, "grunkle")]
    odd = labels + [(0, None, 1), (None, 1, 1), (7777, 1, 1), (1, 1, None), (1, 1, None)]
    out = toxicity.classify(documents(spark, rows), _labels(spark, odd), ("spam", "rude")).collect()
    assert len(out) == len(rows) and all(0 <= r.p_rude <= 1 and r.flagged == (r.p_rude >= 0.2) for r in out)
    assert not any(r.flagged for r in out if r.doc_id in (900, 901))


@pytest.mark.parametrize("kind", ["no labels", "one kind", "no documents"])
def test_nothing_to_learn(spark, kind):
    docs, labels = _corpus(30)
    table, marks = documents(spark, docs), _labels(spark, labels)
    if kind == "no labels":
        out = toxicity.classify(table, marks.limit(0), ("spam", "rude")).collect()
        assert len(out) == 30 and all(r.p_rude is None and r.p_spam is None and not r.flagged for r in out)
    elif kind == "one kind":
        out = toxicity.classify(table, marks.withColumn("spam", F.lit(0)).withColumn("rude", F.lit(1)), ("spam", "rude")).collect()
        assert all(r.p_spam == 0 and r.p_rude == 1 and r.flagged for r in out)
    else:
        assert toxicity.classify(table.limit(0), marks, ("spam", "rude")).collect() == []
