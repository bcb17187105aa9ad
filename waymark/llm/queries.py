"""One query per operator, over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import (
    bin_packing, centroid_clusters, decontaminate, embed_dedup, jaccard_join, license_scan, line_dedup, secret_scan,
    suffix_dedup, token_alignment, token_counts, tool_calls, toxicity,
)
from waymark.llm.common import read_table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base patterns and token-efficiency spans."""
    return secret_scan.secret_summary(secret_scan.scan_secrets(read_table(spark, sf_dir, "documents")))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes under 400-byte strings that stand at more than one place, removed from every document."""
    out = suffix_dedup.dedup_substrings(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces packed into sequences of 2048."""
    out = bin_packing.pack_documents(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document under ten-word passages of ``benchmark``, and items whose rarest words stand together."""
    out = decontaminate.scan_contamination(read_table(spark, sf_dir, "documents"),
                                           read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near"),
                      F.array_join("near_items", ",").alias("near_items"))


#: The label columns in chain order; the last one flags.
TOXICITY_CHAIN = ("quality", "toxic")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the classifier chain."""
    out = toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), TOXICITY_CHAIN)
    return out.select("doc_id", "p_quality", "p_toxic", F.col("flagged").alias("toxic"))


#: What the two calls that chat turns stand for take.
TURN_SCHEMAS = {
    "configure": {"turn": {"type": "integer", "required": True},
                  "text": {"type": "string", "required": True, "min_length": 1}},
    "reply": {"turn": {"type": "integer", "required": True},
              "text": {"type": "string", "required": True, "min_length": 1}, "after": {"type": "string"}},
}


def op6_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of ``conversations`` as a call or a result: linked, ordered, validated, canonical."""
    calls, results = tool_calls.turns_as_calls(read_table(spark, sf_dir, "conversations"))
    out = tool_calls.link_tool_calls(calls, results, TURN_SCHEMAS)
    return out.select("conv_id", "call_id", "turn", "name", "canonical", F.array_join("errors", ",").alias("errors"),
                      "level", "refs", "dangling", "copies", "result_turn", "content", "result_copies", "status")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that three documents hold, dropped from all but the last of them."""
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked at a cosine of 0.9, their components and the ones that stay."""
    return embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    out = license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base_labels", ",").alias("base_labels"),
                      F.array_join("labels", ",").alias("labels"), "score")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets are at least 0.85 similar."""
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of a byte-level and a sentence-piece vocabulary over every document, grouped and linked by their bytes."""
    import public_tokenizers

    return token_alignment.align_tokens(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"), ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern=public_tokenizers.PATTERN)


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors around 16 centroids after three rounds, in exact integers."""
    return centroid_clusters.describe_clusters(*centroid_clusters.cluster_vectors(read_table(spark, sf_dir, "embeddings")))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens of every document, by merges alone."""
    import public_tokenizers

    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_decontamination": op4_decontamination,
    "op5_toxicity": op5_toxicity,
    "op6_tool_call_linking": op6_tool_call_linking,
    "op7_line_dedup": op7_line_dedup,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_token_alignment": op11_token_alignment,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_token_counts": op13_token_counts,
}


def _centroid_rounds(k: int = 16, size: int = 64, scale: int = 64, rounds: int = 3) -> str:
    """Clustering as a chain of common tables: centroids ``c0``, nearest ones ``a0``, the means ``c1``, ..."""
    steps = [f"""v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k, v AS c FROM v
            QUALIFY k < {k}
        )"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
            SELECT r, min(struct_pack(d := d, k := k)) AS near
            FROM (SELECT r, k, CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))
                                    AS BIGINT) AS d FROM v, c{r})
            GROUP BY r
        )""")
        if r < rounds:
            steps.append(f"""s{r} AS (
            SELECT near.k AS k, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
            FROM (SELECT near, unnest(v) AS x, unnest(range({size})) AS j FROM a{r} JOIN v USING (r)) GROUP BY near.k, j
        ), c{r + 1} AS MATERIALIZED (
            SELECT c.k, coalesce(m.c, c.c) AS c
            FROM c{r} c LEFT JOIN (
                SELECT k, list((s - (s % n + n) % n) // n ORDER BY j) AS c FROM s{r} GROUP BY k) m ON m.k = c.k
        )""")
    return f"""
        WITH {", ".join(steps)}
        SELECT v.vec_id, CAST(a.near.k AS INTEGER) AS cluster, a.near.d AS distance,
               CAST(sum(a.near.d) OVER (PARTITION BY a.near.k) AS BIGINT) AS cluster_inertia,
               CAST(sum(a.near.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} c ON c.k = a.near.k
    """


ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": r"""
        WITH doc_words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
            FROM documents
        ), item_words AS (
            SELECT item_id, list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + 9], ' ') AS w, ws[i:i + 9] AS terms
            FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS i
                  FROM item_words WHERE len(ws) > 0)
        ), places AS MATERIALIZED (
            SELECT doc_id, pos, ws[pos] AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS pos FROM doc_words)
            WHERE ws[pos] IN (SELECT unnest(terms) FROM windows)
        ), counts AS (
            SELECT w, count(*) AS c FROM places GROUP BY w
        ), known AS (
            SELECT item_id, x.w, n_terms, c.w AS t, count(*) OVER each AS n_known,
                   row_number() OVER (each ORDER BY c.c, place) AS rank
            FROM (SELECT item_id, w, len(list_distinct(terms)) AS n_terms, unnest(list_distinct(terms)) AS t, terms FROM windows) x
            JOIN counts c ON c.w = x.t, LATERAL (SELECT list_position(x.terms, x.t) AS place)
            WINDOW each AS (PARTITION BY item_id, x.w)
        ), rare AS (
            SELECT item_id, w, t, rank, least(n_known, 3) AS n_rare FROM known WHERE rank <= 3 AND n_known >= least(3, n_terms)
        ), near AS (
            SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM (
                SELECT a.item_id, a.w, p.doc_id, p.pos, any_value(a.n_rare) AS n_rare, count(DISTINCT b.rank) AS met
                FROM rare a JOIN places p ON p.w = a.t
                JOIN rare b ON b.item_id = a.item_id AND b.w = a.w
                JOIN places q ON q.w = b.t AND q.doc_id = p.doc_id AND q.pos BETWEEN p.pos - 15 AND p.pos + 15
                WHERE a.rank = 1 GROUP BY a.item_id, a.w, p.doc_id, p.pos)
            WHERE met = n_rare
        ), near_items AS (
            SELECT doc_id, count(*) AS n_near, string_agg(item_id, ',' ORDER BY item_id) AS s FROM near GROUP BY doc_id
        ), grams AS (
            SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS w
            FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
                  FROM doc_words, (SELECT DISTINCT n FROM windows))
        ), found AS (
            SELECT g.doc_id, g.i, g.n, x.item_id FROM grams g JOIN windows x ON x.n = g.n AND x.w = g.w
        ), hits AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(i.s, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near, coalesce(r.s, '') AS near_items
        FROM doc_words d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN items i ON i.doc_id = d.doc_id
        LEFT JOIN near_items r ON r.doc_id = d.doc_id
    """,
    "op8_embedding_dedup": r"""
        WITH RECURSIVE links AS MATERIALIZED (
            SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.9
        ), reach AS (
            SELECT vec_id AS x, vec_id AS y FROM embeddings
            UNION
            SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
        )
        SELECT c.x AS vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, c.x = c.component_id AS kept
        FROM (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c
        LEFT JOIN (SELECT x, count(*) AS n_links FROM links GROUP BY x) n ON n.x = c.x
    """,
    "op10_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                ELSE list_distinct(list_transform(range(1, len(ws) - 2),
                     lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3])) END AS s
            FROM words
        ), tokens AS MATERIALIZED (
            SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets
        ), links AS MATERIALIZED (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id AND 100 * b.n >= 85 * a.n
                 AND 100 * a.n >= 85 * b.n
            GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
        ), reach AS (
            SELECT doc_id AS x, doc_id AS y FROM sets
            UNION
            SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
        )
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id
        FROM sets s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = s.doc_id
    """,
    "op6_tool_call_linking": r"""
        WITH RECURSIVE calls AS (
            SELECT conv_id, turn, 'call_' || turn AS call_id,
                   CASE WHEN role = 'system' THEN 'configure' ELSE 'reply' END AS name, text,
                   CASE WHEN role = 'system' OR turn = 0 THEN NULL WHEN turn = 1 THEN 'call_0'
                        ELSE 'call_' || (turn - 2) END AS needs, count(*) AS copies
            FROM conversations WHERE role IS DISTINCT FROM 'assistant' GROUP BY ALL
        ), results AS (
            SELECT conv_id, turn AS result_turn, 'call_' || (turn - 1) AS call_id, text AS content,
                   count(*) AS result_copies
            FROM conversations WHERE role = 'assistant' GROUP BY ALL
        ), levels AS (
            SELECT conv_id, call_id, 0 AS level FROM calls c
            WHERE needs IS NULL OR NOT EXISTS (SELECT 1 FROM calls d WHERE d.conv_id = c.conv_id AND d.call_id = c.needs)
            UNION ALL
            SELECT c.conv_id, c.call_id, l.level + 1 FROM calls c JOIN levels l
            ON c.conv_id = l.conv_id AND c.needs = l.call_id
        )
        SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, c.turn, c.name,
               CASE WHEN c.call_id IS NULL THEN NULL
                    WHEN c.needs IS NULL THEN CAST(json_object('text', c.text, 'turn', c.turn) AS VARCHAR)
                    ELSE CAST(json_object('after', '$' || c.needs, 'text', c.text, 'turn', c.turn) AS VARCHAR)
               END AS canonical,
               CASE WHEN c.call_id IS NULL THEN NULL WHEN c.text = '' THEN 'short:text' ELSE '' END AS errors,
               l.level,
               CASE WHEN c.call_id IS NULL THEN NULL WHEN c.needs IS NULL THEN 0 ELSE 1 END::BIGINT AS refs,
               CASE WHEN c.call_id IS NULL THEN NULL WHEN c.needs IS NULL OR d.call_id IS NOT NULL THEN 0 ELSE 1
               END::BIGINT AS dangling,
               c.copies, r.result_turn, r.content, r.result_copies,
               CASE WHEN c.call_id IS NULL THEN 'no_call' WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked'
               END AS status
        FROM calls c LEFT JOIN levels l ON l.conv_id = c.conv_id AND l.call_id = c.call_id
        LEFT JOIN (SELECT conv_id, call_id FROM calls) d ON d.conv_id = c.conv_id AND d.call_id = c.needs
        FULL JOIN results r ON r.conv_id = c.conv_id AND r.call_id = c.call_id
    """,
    "op7_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
        ), keyed AS (
            SELECT doc_id, pos, ls[pos] AS line,
                   translate(regexp_replace(ls[pos], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS pos FROM lines)
        ), repeated AS (
            SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
            GROUP BY k HAVING count(DISTINCT doc_id) >= 3
        )
        SELECT x.doc_id, count(*) AS n_lines,
               count(*) FILTER (WHERE r.k IS NOT NULL AND x.doc_id <> r.keeper) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                               FILTER (WHERE r.k IS NULL OR x.doc_id = r.keeper), '')) AS kept_sha256
        FROM keyed x LEFT JOIN repeated r ON x.k = r.k
        GROUP BY x.doc_id
    """,
    "op12_centroid_clustering": _centroid_rounds(),
}
