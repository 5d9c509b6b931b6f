"""The operators over the given tables, under fixed names, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eduflow.llm import (chat_format, decontaminate, language_id, license_scan, line_dedup, merkle_manifest, near_dedup, packing,
                         quality_classifier, repetition, token_counts, warc_zstd, whitening)
from eduflow.llm.common import shared_folder, table

TOKENIZER = "word_bpe_49k.json"
Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(given.unionByName(extra))


def op2_warc_zstd(spark: SparkSession, folder: str) -> DataFrame:
    archives = shared_folder(spark)
    warc_zstd.write(table(spark, folder, "pages"), archives)
    return warc_zstd.read(spark, archives).drop("url")


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digests(table(spark, folder, "documents")).drop("keep_runs")


def op5_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.classes(table(spark, folder, "documents"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.languages(spark, table(spark, folder, "documents"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.judged(spark, table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(spark, table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scanned(table(spark, folder, "documents"))


def op10_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.judged(table(spark, folder, "documents"))


def op11_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.components(table(spark, folder, "embeddings"), "vec_id", "embedding")


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.verified(table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in (
        op1_chat_format, op2_warc_zstd, op3_token_counts, op4_line_dedup, op5_near_dedup, op6_language_id,
        op7_decontaminate, op8_packing, op9_license_scan, op10_repetition, op11_quality, op12_whitening,
        op13_merkle)}


WS = r"chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
UP, LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
ESCAPED = ("replace(replace(replace(replace(replace(replace({0}, '\\', '\\\\'), '<|', '<\\|'), '</s>', '<\\/s>'), "
           "'<s>', '<\\s>'), '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]')")

FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
LEAF = " || ".join(FIELD.format(c) for c in ("doc_id", "source", "lang", "{0}", "text"))

SQL = {
    "op1_chat_format": f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|turn|>') + length(replace({ESCAPED.format('role')}, chr(10), '\\' || chr(10))) + 1 + length({ESCAPED.format('text')})
    + length('<|end|>')) AS BIGINT) AS formatted_chars
FROM given GROUP BY conv_id""",
    "op2_warc_zstd": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM p LEFT JOIN f USING (digest)""",
    "op4_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {WS}), {UP}, {LOW}) AS key FROM l),
shared AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key
  HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, coalesce(k.doc_id < s.last, false) AS gone FROM k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op7_decontaminate": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, {UP}, {LOW}), {WORD}) AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, {UP}, {LOW}), {WORD}) AS ws
  FROM benchmark),
bw AS (SELECT item, least(len(ws), 10) AS size, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i, ws
  FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item, size, array_to_string(ws[i : i + size - 1], ' ') AS win FROM bw),
sizes AS (SELECT DISTINCT size FROM win),
dw AS (SELECT doc_id, size, unnest(range(1, len(ws) - size + 2)) AS i, ws FROM d, sizes WHERE len(ws) >= size),
hit AS (SELECT doc_id, i, w.size, item FROM (SELECT doc_id, size, i, array_to_string(ws[i : i + size - 1], ' ') AS win
  FROM dw) x JOIN win w ON w.win = x.win AND w.size = x.size),
words AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hit)
  GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op13_merkle": f"""
WITH RECURSIVE crc_bytes AS MATERIALIZED (SELECT list(c ORDER BY n) AS steps FROM (
  SELECT n, list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) AS c
  FROM range(256) r(n))),
given AS (SELECT *, coalesce(xor(list_reduce(encode_points, lambda c, b: xor(c // 256, steps[xor(c, b) % 256 + 1]),
    4294967295), 4294967295) % 7 = 0, false) AS hit
  FROM (SELECT *, [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')] AS encode_points
    FROM documents), crc_bytes),
leaves AS (SELECT doc_id, lang, sha256({LEAF.format('n_chars')}) AS leaf,
  CASE WHEN hit THEN sha256({LEAF.format('(n_chars + 1)')}) END AS tampered FROM given),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
  count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS id FROM leaves),
tree AS MATERIALIZED (SELECT lang, 0 AS level, idx, n, leaf AS h FROM placed
  UNION ALL SELECT lang, level + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM tree WHERE n > 1 GROUP BY lang, level, idx // 2),
subs AS MATERIALIZED (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM tree WHERE n = 1),
upper_tree AS MATERIALIZED (SELECT 0 AS level, idx, n, h FROM subs
  UNION ALL SELECT level + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM upper_tree WHERE n > 1 GROUP BY level, idx // 2),
nodes AS MATERIALIZED (SELECT 0 AS part, lang, level, idx, n, h FROM tree
  UNION ALL SELECT 1, NULL, level, idx, n, h FROM upper_tree),
way AS (SELECT id, lang, 0 AS part, 0 AS level, idx, n, coalesce(tampered, leaf) AS h, '' AS proof FROM placed
  UNION ALL SELECT w.id, w.lang, CASE WHEN w.n > 1 THEN w.part ELSE 1 END, CASE WHEN w.n > 1 THEN w.level + 1 ELSE 0 END,
    CASE WHEN w.n > 1 THEN w.idx // 2 ELSE s.idx END, CASE WHEN w.n > 1 THEN (w.n + 1) // 2 ELSE s.n END,
    CASE WHEN w.n = 1 THEN w.h WHEN w.idx % 2 = 1 THEN sha256(o.h || w.h) ELSE sha256(w.h || coalesce(o.h, '')) END,
    w.proof || coalesce(o.h, '')
  FROM way w LEFT JOIN nodes o ON w.n > 1 AND o.part = w.part AND o.level = w.level AND o.idx = xor(w.idx, 1)
    AND (w.part = 1 OR o.lang IS NOT DISTINCT FROM w.lang)
  JOIN subs s ON s.lang IS NOT DISTINCT FROM w.lang WHERE w.n > 1 OR w.part = 0)
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = r.h AS verified
FROM placed p JOIN way w ON w.id = p.id AND w.part = 1 AND w.n = 1 JOIN subs s ON s.lang IS NOT DISTINCT FROM p.lang,
(SELECT h FROM upper_tree WHERE n = 1) r""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
