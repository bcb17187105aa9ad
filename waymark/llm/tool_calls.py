"""Tool-call linking with DataFrame operations alone.

Calls and results are hash-joined by conversation and identifier. A call may refer to
the result of another call of its conversation by a string ``"$<call id>"`` anywhere in its arguments; calls are
ordered so that every call comes after those it refers to.
Arguments are parsed once into a VARIANT, checked against the tool's declared
parameters, and written back as canonical JSON (compact, keys sorted).

Defined results: arguments that are null, empty or no JSON object are ``bad_json``;
an unknown tool is ``unknown_tool``; a null identifier links with nothing; when an
identifier is called more than once, its earliest call is linked and the others are
``duplicate_call`` (likewise ``duplicate_result``); calls without a result are
``no_result`` and results without a call ``no_call``; references to missing or later
duplicate calls are ``dangling``; calls in a reference cycle, or behind one, get no
level. Equal rows are one row, which says how many copies it had. Empty tables give empty results; only the named columns are read.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import land, land_with

REFERENCE = r"^\$[A-Za-z0-9_-]+$"
CALL_COLS = ("conv_id", "turn", "call_id", "name", "arguments")
RESULT_COLS = ("conv_id", "turn", "call_id", "content")
JSON_TYPES = {"string": "STRING", "boolean": "BOOLEAN"}  # fixed: schema_of_variant's names


def _earliest(rows: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """The given columns, equal rows once, and whether the row is the earliest of its identifier.

    The earliest is found with ``min`` and a join, so the rows of a repeated identifier are
    pre-aggregated and never gathered. Rows without an identifier go round that join.
    """
    rows = rows.select(*cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
    rest = [c for c in cols if c not in ("conv_id", "call_id")]
    has_id = F.col("call_id").isNotNull() & F.col("conv_id").isNotNull()
    first = rows.filter(has_id).groupBy("conv_id", "call_id").agg(F.min(F.struct(*rest)).alias("first"))
    out = (rows.filter(has_id).join(first, ["conv_id", "call_id"])
           .withColumn("is_first", F.struct(*rest).eqNullSafe(F.col("first"))).drop("first"))
    return out.unionByName(rows.filter(~has_id).withColumn("is_first", F.lit(False)))


def _field(value: Column | str, name: str) -> Column:
    """A field of an object as a VARIANT (NULL if it has none)."""
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(value, f"$[{quote}{name}{quote}]", "variant")


def _type_fits(found: Column, kind: str) -> Column:
    """Whether a VARIANT's type name is of the declared JSON type; a number written 5.0 is an integer."""
    return {"number": found.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"), "array": found.startswith("ARRAY"),
            "integer": found.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$"),
            "object": found.startswith("OBJECT")}.get(kind, found == JSON_TYPES.get(kind, ""))


def _breaches(value: Column, kind: Column, rule: Mapping, label: str) -> list[Column]:
    """What is wrong with a value, as strings (NULL: nothing): one per rule, arrays of them for nested values.

    ``kind``: the value's type name. A value that is missing or ``null`` breaks no rule but ``required``.
    """
    given = kind.isNotNull() & (kind != "VOID")
    fits = given & _type_fits(kind, rule["type"])
    out = [F.when(F.lit(bool(rule.get("required"))) & ~F.coalesce(given, F.lit(False)), F.lit(f"missing:{label}")),
           F.when(given & ~fits, F.lit(f"type:{label}"))]
    if rule["type"] == "string":
        text = F.try_variant_get(value, "$", "string")
        if rule.get("min_length"):
            out.append(F.when(fits & (F.length(text) < rule["min_length"]), F.lit(f"short:{label}")))
        if rule.get("max_length") is not None:
            out.append(F.when(fits & (F.length(text) > rule["max_length"]), F.lit(f"long:{label}")))
        if rule.get("pattern"):
            out.append(F.when(fits & ~text.rlike(rule["pattern"]), F.lit(f"pattern:{label}")))
    if rule["type"] in ("number", "integer"):
        number = F.try_variant_get(value, "$", "double")
        if rule.get("minimum") is not None:
            out.append(F.when(fits & (number < rule["minimum"]), F.lit(f"small:{label}")))
        if rule.get("maximum") is not None:
            out.append(F.when(fits & (number > rule["maximum"]), F.lit(f"large:{label}")))
    if rule.get("enum"):
        allowed = [F.to_json(F.parse_json(F.lit(json.dumps(v)))) for v in rule["enum"]]
        out.append(F.when(fits & ~F.to_json(value).isin(*allowed), F.lit(f"enum:{label}")))
    return out


def _nested(value: Column, kind: Column, rule: Mapping, label: str) -> list[Column]:
    """Arrays of breaches inside an object or an array."""
    out = []
    none = F.array().cast("array<string>")
    if rule["type"] == "object" and rule.get("properties"):
        inside = F.concat(*[_all_breaches(_field(value, name), own, f"{label}.{name}") for name, own in rule["properties"].items()])
        out.append(F.when(kind.startswith("OBJECT"), inside).otherwise(none))
    if rule["type"] == "array" and rule.get("items"):
        each = F.transform(F.try_variant_get(value, "$", "array<variant>"),
                           lambda v: _all_breaches(v, rule["items"], f"{label}[]"))
        out.append(F.when(kind.startswith("ARRAY"), F.flatten(each)).otherwise(none))
    return out


def _all_breaches(value: Column, rule: Mapping, label: str) -> Column:
    """Everything that is wrong with a value and inside it, as one array of strings."""
    kind = F.schema_of_variant(value)
    own = F.array_compact(F.array(*_breaches(value, kind, rule, label)))
    return F.concat(own, *_nested(value, kind, rule, label))


def with_errors(calls: DataFrame, schemas: Mapping[str, Mapping[str, Mapping]]) -> DataFrame:
    """``calls`` (with ``args``, the parsed arguments) plus ``errors``: what is wrong, sorted, each once (empty: valid).

    ``schemas``: tool → parameter → rule. A rule has a ``type`` (string, integer, number, boolean, object, array) and may have
    ``required``, ``enum``, ``min_length``, ``max_length``, ``pattern`` (found anywhere), ``minimum``, ``maximum``, ``properties``
    (name → rule, of an object) and ``items`` (the rule of every element of an array). A parameter that is ``null`` is as one
    not given; 5.0 is an integer.
    """
    params = sorted({p for rules in schemas.values() for p in rules})
    # each parameter is looked up once; the checks below read it and its type's name
    looked = {f"_value{k}": _field("args", p) for k, p in enumerate(params)}
    kinds = {f"_type{k}": F.schema_of_variant(f"_value{k}") for k in range(len(params))}
    looked |= {"_object": F.coalesce(F.schema_of_variant("args").startswith("OBJECT"), F.lit(False)),
               "_names": F.json_object_keys("arguments")}
    is_object = F.col("_object")
    none = F.array().cast("array<string>")
    found = [F.when(~is_object, F.lit("bad_json")),
             F.when(~F.coalesce(F.col("name").isin(*schemas), F.lit(False)), F.lit("unknown_tool"))]
    deep = []
    for tool, rules in schemas.items():
        mine = is_object & (F.col("name") == tool)
        for param, rule in rules.items():
            k = params.index(param)
            value, kind = F.col(f"_value{k}"), F.col(f"_type{k}")
            found += [F.when(mine, e) for e in _breaches(value, kind, rule, param)]
            deep += [F.when(mine, e).otherwise(none) for e in _nested(value, kind, rule, param)]
        known = F.array(*[F.lit(p) for p in rules]) if rules else none
        found.append(F.when(mine & (F.size(F.array_except("_names", known)) > 0), F.lit("unknown_parameter")))
    errors = F.array_compact(F.array(*found))
    if deep:
        errors = F.array_distinct(F.concat(errors, *[F.coalesce(d, none) for d in deep]))
    return (calls.withColumns(looked).withColumns(kinds).withColumn("errors", F.array_sort(errors))
            .drop(*looked, *kinds))


def references(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, needs)``: the identifiers that a call's arguments refer to, each once.

    A reference is a string, at any depth, that is ``$`` and an identifier and nothing else. Objects and arrays are opened
    level by level; a level's containers are written as rows, and only those that hold such a text go on.
    """
    found, level = [], calls.select("conv_id", "call_id", F.col("arguments").alias("json"))
    while True:
        inside = (level.filter(F.col("json").contains('"$'))
                  .select("conv_id", "call_id", F.inline(F.array(F.struct(F.try_parse_json("json").alias("v")))))
                  .lateralJoin(calls.sparkSession.tvf.variant_explode(F.col("v").outer()))
                  .select("conv_id", "call_id", F.schema_of_variant("value").alias("kind"), "value"))
        text = F.when(F.col("kind") == "STRING", F.try_variant_get("value", "$", "string"))
        open_ = F.col("kind").startswith("OBJECT") | F.col("kind").startswith("ARRAY")
        values, seen = land_with(
            inside.select("conv_id", "call_id", text.alias("text"), F.when(open_, F.to_json("value")).alias("json"))
            .filter(F.col("text").rlike(REFERENCE) | F.col("json").contains('"$')), "argument_values", more=F.count("json"))
        found.append(values.filter(F.col("text").isNotNull())
                     .select("conv_id", "call_id", F.expr("substring(text, 2)").alias("needs")))
        if not seen["more"]:
            return reduce(DataFrame.unionByName, found).distinct()
        level = values.filter(F.col("json").isNotNull()).select("conv_id", "call_id", "json")


def _chains(singles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where the chains of calls with one reference lead: ``(conv_id, call_id, to, dist)`` and, apart, the ones
    that lead into a cycle. ``singles``: (conv_id, call_id, needs).

    Pointers double in every round, so the rounds grow with the logarithm of the longest chain.
    """
    step, n = land_with(singles.select("conv_id", "call_id", F.col("needs").alias("to"), F.lit(1).alias("dist"),
                                       F.lit(True).alias("moving")), "chain", n=F.count(F.lit(1)))
    moving = n["n"]
    for _ in range(n["n"].bit_length() + 1):
        if not moving:
            break
        on = step.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("dist").alias("more"))
        step, left = land_with(
            step.join(on, ["conv_id", "to"], "left")
            .select("conv_id", "call_id", F.coalesce("next", "to").alias("to"),
                    (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"), F.col("next").isNotNull().alias("moving")),
            "chain", moving=F.count(F.when(F.col("moving"), 1)))
        moving = left["moving"]
    return step.filter(~F.col("moving")).drop("moving"), step.filter("moving").select("conv_id", "call_id")


def topological_levels(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """``(conv_id, call_id, level)``: 0 without references, else one more than the deepest referred call.

    Chains of calls with one reference each are followed at once (``_chains``) to where they end: a
    call without references, or one with several. Only the latter are peeled round by round.
    Calls in or behind a cycle are left out.
    """
    key = ["conv_id", "call_id"]
    edges = land(edges.distinct(), "refs")
    counts = land(edges.groupBy(*key).agg(F.count(F.lit(1)).alias("n")), "ref_counts")
    ends, _ = _chains(edges.join(counts.filter("n = 1").select(*key), key, "left_semi"))
    ends = ends.withColumnRenamed("dist", "behind")
    levels = calls.select(*key).join(counts, key, "left_anti").withColumn("level", F.lit(0))
    # each reference of a call with several, taken to the end of its chain
    waiting, n = land_with(
        edges.join(counts.filter("n > 1"), key).withColumnRenamed("needs", "ref")
        .join(ends.withColumnRenamed("call_id", "ref"), ["conv_id", "ref"], "left")
        .select(*key, "n", F.coalesce("to", "ref").alias("to"), (F.coalesce("behind", F.lit(0)) + 1).alias("more")),
        "several", n=F.count(F.lit(1)))
    while n["n"]:
        known = levels.select("conv_id", F.col("call_id").alias("to"), "level")
        new = land(waiting.join(known, ["conv_id", "to"]).groupBy(*key, "n")
                   .agg(F.count(F.lit(1)).alias("met"), F.max(F.col("level") + F.col("more")).alias("level"))
                   .filter(F.col("met") == F.col("n")).select(*key, "level"), "levels")
        rest, left = land_with(waiting.join(new, key, "left_anti"), "several", n=F.count(F.lit(1)))
        if left["n"] == n["n"]:
            break
        levels, waiting, n = levels.unionByName(new), rest, left
    along = (ends.join(levels.withColumnRenamed("call_id", "to"), ["conv_id", "to"])
             .select(*key, (F.col("level") + F.col("behind")).alias("level")))
    return levels.unionByName(along)


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping[str, Mapping]]) -> DataFrame:
    """One row per distinct call and per distinct result that no call takes.

    ``calls``: conv_id, turn, call_id, name, arguments; ``results``: conv_id, turn, call_id, content.
    """
    parsed = _earliest(calls, CALL_COLS).withColumn("args", F.try_parse_json("arguments"))
    c = land(with_errors(parsed, schemas).withColumn("canonical", F.to_json("args")).drop("args"), "calls")
    linkable = c.filter("is_first").select("conv_id", "call_id")
    refs = land(references(c.filter(F.col("is_first") & ~F.array_contains("errors", "bad_json"))), "references")
    known = refs.join(linkable.select("conv_id", F.col("call_id").alias("needs")), ["conv_id", "needs"], "left_semi")
    levels = topological_levels(linkable, known.select("conv_id", "call_id", "needs"))
    per_call = (refs.join(known.withColumn("found", F.lit(1)), ["conv_id", "call_id", "needs"], "left")
                .groupBy("conv_id", "call_id").agg(F.count(F.lit(1)).alias("refs"), F.count("found").alias("found")))
    zero = F.lit(0).cast("long")
    left = (c.join(levels, ["conv_id", "call_id"], "left").join(per_call, ["conv_id", "call_id"], "left")
            .select("conv_id", "call_id", "turn", "name", "canonical", "errors",
                    F.when(F.col("is_first"), F.col("level")).alias("level"),
                    F.coalesce("refs", zero).alias("refs"),
                    (F.coalesce("refs", zero) - F.coalesce("found", zero)).alias("dangling"),
                    "copies", "is_first"))
    right = _earliest(results, RESULT_COLS).select(
        F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call"), F.col("turn").alias("result_turn"),
        "content", F.col("copies").alias("result_copies"), F.col("is_first").alias("r_first"))
    # both sides have an identifier once, so no task of the join gets more than its share; all other rows go round it
    on = (F.col("conv_id") == F.col("r_conv")) & (F.col("call_id") == F.col("r_call"))
    met = left.filter("is_first").join(right.filter("r_first"), on, "full_outer")
    alone = left.filter(~F.col("is_first")).unionByName(right.filter(~F.col("r_first")), allowMissingColumns=True)
    status = (F.when(F.col("copies").isNull(),
                     F.when(F.col("r_first") | F.col("r_call").isNull() | F.col("r_conv").isNull(), "no_call")
                     .otherwise("duplicate_result"))
              .when(F.col("conv_id").isNull() | F.col("call_id").isNull(), "no_id")
              .when(~F.col("is_first"), "duplicate_call")
              .when(F.col("result_copies").isNull(), "no_result").otherwise("linked"))
    return (met.unionByName(alone)
            .select(F.coalesce("conv_id", "r_conv").alias("conv_id"), F.coalesce("call_id", "r_call").alias("call_id"),
                    "turn", "name", "canonical", "errors", "level", "refs", "dangling", "copies",
                    "result_turn", "content", "result_copies", status.alias("status")))


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain chat turns as calls and results.

    A system turn calls ``configure``, every other turn but the assistant's calls ``reply``; an
    assistant turn is the result of the turn before it. A ``reply`` refers to the call it follows.
    """
    turn = F.col("turn")
    is_result = F.coalesce(F.col("role") == "assistant", F.lit(False))
    after = F.when(turn == 1, F.lit("$call_0")).when(turn > 1, F.concat(F.lit("$call_"), turn - 2))
    system = F.coalesce(F.col("role") == "system", F.lit(False))
    calls = conversations.filter(~is_result).select(
        "conv_id", "turn", F.concat(F.lit("call_"), turn).alias("call_id"),
        F.when(system, "configure").otherwise("reply").alias("name"),
        F.to_json(F.struct("turn", "text", F.when(~system, after).alias("after"))).alias("arguments"))
    results = conversations.filter(is_result).select(
        "conv_id", "turn", F.concat(F.lit("call_"), turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results
