"""One query per operator over its whole table, and SQL for those that SQL can say."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from creditloom.llm import (alignment, bpe, chat, jaccard, language, lengths, lines, outliers, pii, seeds, toxicity, urls,
                            whitening)

#: The URL rules of the contract.
URL_RULES = [urls.host_rule("com", "/", "allow"), urls.host_rule("example.com", "/en/", "block"),
             urls.host_rule("www.example.com", "/en/", "allow"), urls.host_rule("net", "/es/", "block"),
             urls.host_rule("net", "/fr/", "block")]
#: The conversation added to the table.
MARKED = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = lengths.token_lengths(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                    public_tokenizers.PATTERN)
    return lengths.limits(lengths.length_histogram(counted))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.sql(f"SELECT -7L AS conv_id, turn, role, '{MARKED}' AS text "
                      "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return chat.digests(chat.format_conversations(turns.unionByName(added)))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages").select("page_id", "url"), URL_RULES)


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


def op8_quality_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.judge(table(spark, folder, "documents")).drop("distance")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return seeds.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, folder, "documents"))


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.digests(lines.drop_repeated_lines(table(spark, folder, "documents")))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_token_counts, op3_bpe, op4_chat_format, op5_url_filter, op6_toxicity, op7_pii,
    op8_quality_outliers, op9_decontamination, op10_jaccard_join, op11_line_dedup, op12_token_alignment,
    op13_embedding_whitening)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLES = {
    "op4_chat_format": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{MARKED}' UNION ALL SELECT -7, 1, 'assistant', '{MARKED}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), ''))
    AS loss_sha256,
  sum(23 + length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'))
         + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id""",
    "op5_url_filter": f"""
WITH u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(host, path, decides) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
    max_by(r.decides, length(r.host || r.path)) AS decides
  FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY page_id),
words(word) AS (VALUES ('spam-farm'), ('cheap-pills'), ('casino'), ('viagra'), ('link-farm'), ('free-money')),
hits AS (
  SELECT page_id, max_by('*' || word || '*', struct_pack(a := length(word), b := word)) AS reason
  FROM u JOIN words ON regexp_matches(lower(u.host || u.path), '(^|[^a-z0-9])' || word || '($|[^a-z0-9])')
  GROUP BY page_id)
SELECT u.page_id, u.host, u.path, rule,
  coalesce(decides, CASE WHEN reason IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
  CASE WHEN rule IS NULL THEN reason END AS reason
FROM u LEFT JOIN fits USING (page_id) LEFT JOIN hits USING (page_id)""",
    "op10_jaccard_join": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b USING (item)
  WHERE a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, min(other) AS component_id,
  CASE WHEN len(s) > 0 THEN count_same END AS n_class
FROM sets JOIN reach USING (doc_id)
JOIN (SELECT doc_id, count(*) OVER (PARTITION BY list_sort(s)) AS count_same FROM sets) c USING (doc_id)
GROUP BY doc_id, s, count_same""",
    "op11_line_dedup": f"""
WITH pieces AS (
  SELECT doc_id, row_number() OVER () AS doc, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
split AS (
  SELECT doc_id, doc, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM pieces),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key
  FROM split),
repeats AS (
  SELECT key, max(doc_id) AS stays FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id <> stays) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE stays IS NULL OR doc_id IS NULL OR doc_id = stays), ''))
    AS kept_sha256
FROM keyed LEFT JOIN repeats USING (key) GROUP BY doc_id, doc""",
}
