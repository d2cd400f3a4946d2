"""The registered queries of the training-data operators: thin wrappers that
run one operator over its whole table and derive the digest columns of its
contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import table


#: The rules of the URL filter's contract.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block")]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.url_filter import filter_urls
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


OP1_SQL = """
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
q AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM p),
r(rule, rhost, rpath, rverdict) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block'))
SELECT page_id, host, path,
       (SELECT max_by(rule, length(rule)) FROM r
        WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule,
       coalesce((SELECT max_by(rverdict, length(rule)) FROM r
        WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)), 'allow') AS verdict
FROM q
"""


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.substring_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.html_extract import extract_text
    return extract_text(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.suffix_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.quality import quality_rules
    return quality_rules(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from daybook.llm.bpe import round_trip
    return round_trip(table(spark, sf_dir, "documents"),
                      public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).withColumnRenamed("id", "doc_id")


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.fingerprint import edited_fingerprints
    return edited_fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from daybook.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"),
                public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from daybook.llm.token_files import token_files
    return token_files(table(spark, sf_dir, "documents"),
                       public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.pii import personal_data
    return personal_data(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
grams AS (
  SELECT lang, ws[i:i + k - 1] AS p FROM places, (VALUES (1), (2), (3)) AS ks(k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, p, count(*) AS c FROM grams GROUP BY lang, p),
totals AS (SELECT lang, sum(c) AS n FROM f WHERE len(p) = 1 GROUP BY lang),
candidates AS (SELECT lang, p, c AS a FROM f WHERE len(p) > 1 AND c >= 10),
longer AS (
  SELECT lang, p[1:2] AS p, a FROM candidates WHERE len(p) = 3
  UNION ALL SELECT lang, p[2:3] AS p, a FROM candidates WHERE len(p) = 3),
gone AS (
  SELECT DISTINCT c.lang, c.p FROM candidates c JOIN longer l ON l.lang = c.lang AND l.p = c.p WHERE 100 * l.a >= 50 * c.a),
cuts AS (
  SELECT c.lang, c.p, k, c.a, l.c AS l, r.c AS r,
         (1000000::HUGEINT * c.a::HUGEINT * c.a::HUGEINT) // (l.c::HUGEINT * r.c::HUGEINT) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.p = c.p[1:k]
  JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1:]
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.lang = c.lang AND g.p = c.p)),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM lowest)
SELECT lang, rank, array_to_string(p, ' ') AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from daybook.llm.prefix_trie import conversation_trie
    return conversation_trie(table(spark, sf_dir, "conversations"))


OP13_SQL = r"""
WITH crc_table AS (
  SELECT list(list_reduce(list_concat([i], range(8)),
                          lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM range(256) AS r(i)),
own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (
  SELECT conv_id, turns, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                         lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 4 AS h
  FROM own, crc_table),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS path
  FROM headed a LEFT JOIN own b ON a.base = b.conv_id),
steps AS (
  SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         count(DISTINCT CASE WHEN len(path) > depth THEN path[depth + 1] END) AS n_children,
         coalesce(string_agg(CASE WHEN len(path) = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
  FROM steps GROUP BY path[1:depth], depth),
weighed AS (
  SELECT *, CASE WHEN depth = 0 THEN 0 ELSE
           (n_convs - 1) * len(regexp_extract_all(node[depth].text, '[^\x20\x09-\x0D]+')) END AS own_saved
  FROM nodes),
up AS (
  SELECT node, n_children, own_saved, unnest(range(depth + 1)) AS above FROM weighed),
sums AS (
  SELECT node[1:above] AS node, above AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum(own_saved) AS saved_tokens
  FROM up GROUP BY node[1:above], above)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM weighed w JOIN sums s ON s.depth = w.depth AND s.node = w.node
LEFT JOIN nodes p ON p.depth = w.depth - 1 AND p.node = w.node[1:w.depth - 1]
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_token_files": op10_token_files,
    "op11_personal_data": op11_personal_data,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE: dict[str, str] = {
    "op1_url_filters": OP1_SQL,
    "op12_phrase_collocations": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
