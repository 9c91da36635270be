"""The registered queries of this subpackage: each applies one operator, with its
production parameters, to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import (
    chat_format,
    decontaminate,
    hard_negatives,
    licences,
    near_dedup,
    pieces,
    prefix_trie,
    quality_knn,
    quality_rules,
    shards,
    substring,
    token_files,
    toxicity,
)
from kindred.llm.registry import query, table
from kindred.session import materialise

#: The same measures, quartiles and fences in DuckDB. Up to SKETCH_K documents per
#: merge the sketches are exact, so both sides see the same thresholds.
QUALITY_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
places AS (
  SELECT doc_id, unnest(range(1, len(words) - 6)) AS p, words FROM texts WHERE len(words) > 7
),
windows AS (SELECT doc_id, p, list_slice(words, p, p + 7) AS w FROM places),
again AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w) AS c FROM windows) WHERE c > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM again) GROUP BY 1
),
counted AS (
  SELECT t.doc_id, lang, source, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS marks,
         length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS upper_chars
  FROM texts t LEFT JOIN covered c ON c.doc_id = t.doc_id
),
shares AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         n_symbols / greatest(word_chars, 1) AS symbol_share, marks / greatest(word_chars, 1) AS mark_share,
         upper_chars / greatest(word_chars, 1) AS upper_share, word_chars / greatest(n_words, 1) AS mean_word,
         n_dup_lines / greatest(n_lines, 1) AS dup_line_share, n_repeat_words / greatest(n_words, 1) AS repeat_share
  FROM counted
),
levels AS (
  SELECT 0 AS level, lang, source, * EXCLUDE (lang, source) FROM shares WHERE NOT base_failed
  UNION ALL SELECT 1, lang, NULL, * EXCLUDE (lang, source) FROM shares WHERE NOT base_failed
  UNION ALL SELECT 2, NULL, NULL, * EXCLUDE (lang, source) FROM shares WHERE NOT base_failed
),
quartiles AS (
  SELECT level, lang, source, count(*) AS n,
         quantile_disc(symbol_share, [0.25, 0.75]) AS sy, quantile_disc(mark_share, [0.25, 0.75]) AS ma,
         quantile_disc(upper_share, [0.25, 0.75]) AS up, quantile_disc(mean_word, [0.25, 0.75]) AS me,
         quantile_disc(dup_line_share, [0.25, 0.75]) AS du, quantile_disc(repeat_share, [0.25, 0.75]) AS re
  FROM levels GROUP BY 1, 2, 3
),
chosen AS (
  SELECT s.*, CASE WHEN g.n >= 50 THEN g WHEN l.n >= 50 THEN l ELSE e END AS q, g.n AS in_group
  FROM shares s
  LEFT JOIN quartiles g ON g.level = 0 AND g.lang IS NOT DISTINCT FROM s.lang AND g.source IS NOT DISTINCT FROM s.source
  LEFT JOIN quartiles l ON l.level = 1 AND l.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN quartiles e ON e.level = 2
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND in_group IS NOT NULL
       AND symbol_share <= q.sy[2] + 6 * greatest(q.sy[2] - q.sy[1], 0.005)
       AND mark_share <= q.ma[2] + 6 * greatest(q.ma[2] - q.ma[1], 0.008)
       AND upper_share <= q.up[2] + 6 * greatest(q.up[2] - q.up[1], 0.05)
       AND mean_word <= q.me[2] + 6 * greatest(q.me[2] - q.me[1], 0.6)
       AND mean_word >= q.me[1] - 6 * greatest(q.me[2] - q.me[1], 0.6)
       AND dup_line_share <= q.du[2] + 6 * greatest(q.du[2] - q.du[1], 0.05)
       AND repeat_share <= q.re[2] + 6 * greatest(q.re[2] - q.re[1], 0.02) AS kept
FROM chosen
"""


@query("op1_wavelet_token_files")
def op1_wavelet_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents").select("doc_id", "text"),
                               table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "spans")


@query("op3_neighbour_quality")
def op3_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    space = quality_knn.fit(docs, table(spark, sf_dir, "labels"))
    return quality_knn.score(docs, space).select("doc_id", "held_out", "score", "predicted")


@query("op4_licence_scan")
def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


@query("op5_factorization_toxicity")
def op5_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, machine).select("doc_id", "held_out", "score", "predicted")


@query("op6_circulant_minhash")
def op6_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.group(table(spark, sf_dir, "documents"), width=2, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept")


@query("op7_quality_rules", QUALITY_SQL)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    measured = quality_rules.materialise(quality_rules.measure(docs).drop("text"), "measured")
    return quality_rules.judge(measured).select("doc_id", *quality_rules.MEASURED, "kept")


@query("op8_jump_hash_shards")
def op8_jump_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"), shards=40)


@query("op9_shared_prefix_viterbi")
def op9_shared_prefix_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "n_words", "n_pieces", F.crc32(F.array_join("pieces", ",").cast("binary")).alias("pieces_crc32"),
        "restored")


@query("op10_fm_index_dedup")
def op10_fm_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.cut(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op11_prefix_trie_contraction")
def op11_prefix_trie_contraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build(table(spark, sf_dir, "conversations"))


@query("op12_hilbert_hard_negatives")
def op12_hilbert_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


@query("op13_fingerprint_chat_format")
def op13_fingerprint_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    stored = materialise(chat_format.format_records(chat_format.records_of(rows)), "chats")
    return chat_format.digests(stored)
