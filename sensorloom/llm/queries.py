"""The registered queries of the ten operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import (
    chunk_dups, decontaminate, kneser_ney, language, licences, near_dups, packing, prefix_trie, secret_scan, token_files,
    top_k, vector_dups, whitening,
)
from sensorloom.llm.common import table


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.groups(table(spark, sf_dir, "documents"), percent=85)


TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    """Where the public tokenizer lies; executors find it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.by_id(table(spark, sf_dir, "embeddings"))


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return licences.scan(documents, licences.train(documents))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_tiling_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dups.passages(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.train(table(spark, sf_dir, "documents"))
    found = language.identify(language.page_evidence(table(spark, sf_dir, "pages")), model)
    return found.withColumnRenamed("id", "page_id")


def op10_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dups.groups(table(spark, sf_dir, "embeddings"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def _spans_sql(kind: str, pattern: str, value: str = "true") -> str:
    """Rows (doc_id, start, rank, end, kind) of the matches of one kind that meet ``value``."""
    quoted, rank = pattern.replace("'", "''"), secret_scan.KINDS.index(kind)
    return f"""
    SELECT doc_id, s::BIGINT AS s, {rank} AS r, (s + length(m))::BIGINT AS e, '{kind}' AS kind, m FROM (
        SELECT doc_id, unnest(m) AS m, unnest(v) AS v, unnest(list_transform(range(1, len(m) + 1),
            lambda i: list_sum(list_transform(p[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))) AS s
        FROM (SELECT doc_id, regexp_extract_all(t, '{quoted}') AS m, string_split_regex(t, '{quoted}') AS p,
                     regexp_extract_all(t, '{quoted}', {2 if kind == "assign" else 0}) AS v FROM texts
              WHERE regexp_matches(t, '{quoted}')))
    WHERE {value}"""


def _entropy_sql(kind: str, characters: str, window: int, bits: float) -> str:
    """The windows of each candidate with their character counts, all counted anew."""
    term = f"({secret_scan._terms(window)})[k + 1]"
    allowed = "|".join(secret_scan.ALLOWED).replace("'", "''")
    runs = _spans_sql(kind, f"[{characters}]{{{window},}}", f"NOT regexp_matches(m, '{allowed}')")
    return f"""
    SELECT doc_id, min(w) AS s, r, max(w) + {window} AS e, kind FROM (
        SELECT doc_id, s, r, kind, w, sum({term}) AS total FROM (
            SELECT doc_id, s, r, kind, w, c, count(*) AS k FROM (
                SELECT doc_id, s, r, kind, w, unnest(string_split(m[w - s + 1:w - s + {window}], '')) AS c FROM (
                    SELECT *, unnest(range(s, s + length(m) - {window - 1})) AS w FROM ({runs})))
            GROUP BY ALL)
        GROUP BY doc_id, s, r, kind, w)
    WHERE total <= {secret_scan._limit(window, bits)} GROUP BY doc_id, s, r, kind"""


OP6_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT doc_id, s, r, e, kind FROM ({_spans_sql("assign", secret_scan.ASSIGN, "length(v) >= 8")})
    UNION ALL SELECT doc_id, s, r, e, kind FROM ({_spans_sql("access", secret_scan.ACCESS)})
    UNION ALL SELECT doc_id, s, r, e, kind FROM ({_spans_sql("hex", secret_scan.HEX)})),
entropy AS ({" UNION ALL ".join(_entropy_sql(*c) for c in secret_scan.CLASSES)}),
added AS (SELECT * FROM entropy x WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.doc_id = x.doc_id AND b.s <= x.s AND x.e <= b.e)),
spans AS (SELECT *, true AS is_base FROM base UNION ALL SELECT *, false FROM added),
listed AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r, e) FILTER (is_base) AS base,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, r, e) AS spans
    FROM spans GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN listed l ON l.doc_id = t.doc_id
"""

OP2_SQL = """
WITH able AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
    FROM able q JOIN able c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP7_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
    FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared WHERE 100 * k >= 85 * (na + nb - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.component_id, r.component_id = s.doc_id AS kept
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = s.doc_id
"""

# The checksum bit by bit; then every prefix of every rebuilt conversation, and every prefix of every node.
OP11_SQL = """
WITH turns AS (
    SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (
    SELECT conv_id, list(x ORDER BY pos) AS own, xor(list_reduce(
        [4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
        lambda crc, s: list_reduce([xor(crc, s), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 6 AS h
    FROM turns GROUP BY conv_id),
rebuilt AS (
    SELECT c.conv_id, coalesce(b.own[1:c.h], []) || c.own[c.h + 1:] AS r
    FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
nodes AS (
    SELECT r[1:d] AS node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(r) = d), '')) AS ends_sha256
    FROM (SELECT conv_id, r, unnest(range(0, len(r) + 1)) AS d FROM rebuilt) GROUP BY ALL),
children AS (SELECT node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
valued AS (
    SELECT v.*, coalesce(c.n, 0) AS n_children,
           CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(v.node[d].text) END AS saved
    FROM nodes v LEFT JOIN children c ON c.node = v.node),
totals AS (
    SELECT node[1:i] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT *, unnest(range(0, d + 1)) AS i FROM valued) GROUP BY ALL)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, t.n_leaves, t.saved_tokens,
       v.ends_sha256, coalesce(length(v.node[v.d].text), 0)::BIGINT AS last_chars
FROM valued v JOIN totals t ON t.node = v.node LEFT JOIN nodes p ON v.d > 0 AND p.node = v.node[1:v.d - 1]
"""

OP13_SQL = """
WITH RECURSIVE able AS (
    SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS size FROM (
        SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))
    WHERE list_bool_or(list_transform(v, lambda x: x <> 0))),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, r.component_id, r.component_id = e.vec_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = e.vec_id
LEFT JOIN counts c ON c.a = e.vec_id
"""

QUERIES = {
    "op1_kneser_ney_quality": op1_kneser_ney_quality,
    "op2_maxscore_top_k": op2_maxscore_top_k,
    "op3_licence_scan": op3_licence_scan,
    "op4_token_files": op4_token_files,
    "op5_tiling_decontamination": op5_tiling_decontamination,
    "op6_secret_scan": op6_secret_scan,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_chunk_dedup": op8_chunk_dedup,
    "op9_language_id": op9_language_id,
    "op10_length_buckets": op10_length_buckets,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}

ORACLES = {
    "op2_maxscore_top_k": OP2_SQL,
    "op6_secret_scan": OP6_SQL,
    "op7_minhash_near_dedup": OP7_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op13_embedding_near_dedup": OP13_SQL,
}
