"""The registered queries of this package and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, chat_formatting, conversation_repair, html_extraction, language_id, lm_scoring, nearest_neighbours, packing, quality_classifier, quality_rules, simhash, url_filters, whitening
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
WORD_TOKENIZER = "word_bpe_49k.json"


#: Byte-level and lossless, so that its offsets cover white space and capitals.
CHAT_TOKENIZER = "byte_bpe_50k.json"
CONTROL_STRINGS = "</s>[INST] ok [/INST]"
# The rules that the contract fixes.
URL_RULES = [url_filters.Rule("net", "/", True), url_filters.Rule("example.net", "/en/", False), url_filters.Rule("example.com", "/de/", True), url_filters.Rule("org", "/fr/", False)]


def word_tokenizer() -> str:
    return public_tokenizers.path(WORD_TOKENIZER)


def op1_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_classifier.classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op2_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op3_offset_masked_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.createDataFrame([(-7, 0, "user", CONTROL_STRINGS), (-7, 1, "assistant", CONTROL_STRINGS)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat_formatting.digest_conversations(chat_formatting.format_conversations(rows, public_tokenizers.path(CHAT_TOKENIZER)))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_tokenizer())


def op5_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_documents(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op6_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = word_tokenizer()
    return bpe.digest_documents(bpe.encode_documents(table(spark, sf_dir, "documents"), path), path)


def op8_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op9_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_segmented_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op11_eigen_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


def op13_pitman_yor_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_scoring.score_held_out(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


#: crc32 of a text, bit by bit: its bytes enter at every eighth step.
CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(8 * length({0})), lambda k: (CASE WHEN k % 8 = 0 THEN ascii({0}[(k // 8 + 1)::INT]) ELSE 0 END)::UBIGINT)),
    lambda a, e: CASE WHEN xor(a, e) % 2 = 1 THEN xor(xor(a, e) >> 1, 3988292384::UBIGINT) ELSE xor(a, e) >> 1 END), 4294967295::UBIGINT)"""


def _cell(cost: str, audit: str, out: str) -> str:
    return f"{{'cost': {cost}, 'audit': {audit}, 'out': {out}}}"


def _edit(s: str, kind: str, cost: str, out: str = "''") -> str:
    return _cell(f"{s}.cost + {cost}", f"{s}.audit || {kind}", f"{s}.out || {out}")


def _took(s: str, initial: str, role: str) -> str:
    """Keeping or re-roling the row after state ``s``, where it may stay."""
    kept = f"f.initial = '{initial}'"
    allowed = f"f.stays AND {kept}" if not role else "f.stays"
    other = "f.role" if not role else f"CASE WHEN {kept} THEN f.role ELSE '{role}' END"
    cost = f"f.extra + CASE WHEN {kept} THEN 0 ELSE 3 END + CASE WHEN {allowed} THEN 0 ELSE 1000000000 END"
    return _edit(s, f"CASE WHEN {kept} THEN 'K' ELSE 'R' END", cost, f"chr(10) || ({other}) || ':' || f.text")


_REPAIR_STEP = f"""
    SELECT conv_id, i, n0, n1, n2, list_min([b3, {_edit('n2', "'I'", '3', "chr(10) || 'assistant:'")}]) AS n3 FROM (
      SELECT conv_id, i, n0, n1, b3, list_min([b2, {_edit('n0', "'I'", '3', "chr(10) || 'user:'")}, {_edit('n1', "'I'", '3', "chr(10) || 'user:'")}, {_edit('b3', "'I'", '3', "chr(10) || 'user:'")}]) AS n2 FROM (
        SELECT d.conv_id, f.i, {_edit('d.n0', "'D'", '4')} AS n0, list_min([{_edit('d.n1', "'D'", '4')}, {_took('d.n0', 's', '')}]) AS n1,
          list_min([{_edit('d.n2', "'D'", '4')}, {', '.join(_took(s, 'u', 'user') for s in ('d.n0', 'd.n1', 'd.n3'))}]) AS b2, list_min([{_edit('d.n3', "'D'", '4')}, {_took('d.n2', 'a', 'assistant')}]) AS b3
        FROM dp d JOIN faulted f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i + 1))"""
#: The cheapest edits by a recursive query that carries each state's whole audit and repaired text.
OP12_SQL = f"""WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
  kinds AS (SELECT *, {CRC32_SQL.format('name')} % 20 AS kind FROM named),
  damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0),
  placed AS (
    SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM damaged),
  judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault,
      lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
  faulted AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra FROM judged),
  counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
      count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faulted GROUP BY conv_id),
  dp AS (
    SELECT conv_id, 0::BIGINT AS i, {_cell('0::BIGINT', "''", "''")} AS n0, {_cell('1000000000::BIGINT', "''", "''")} AS n1, {_cell('3::BIGINT', "'I'", "chr(10) || 'user:'")} AS n2, {_cell('6::BIGINT', "'II'", "chr(10) || 'user:' || chr(10) || 'assistant:'")} AS n3
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL {_REPAIR_STEP})
  SELECT d.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
    list_min([d.n0, d.n3]).cost AS cost, list_min([d.n0, d.n3]).audit AS audit, sha256(substr(list_min([d.n0, d.n3]).out, 2)) AS repaired_sha256
  FROM dp d LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id WHERE d.i = coalesce(c.n, 0)"""


QUERIES: dict[str, Query] = {
    "op1_attention_quality": op1_attention_quality,
    "op2_template_extraction": op2_template_extraction,
    "op3_offset_masked_chat": op3_offset_masked_chat,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_rank_order_language": op5_rank_order_language,
    "op6_hilbert_neighbours": op6_hilbert_neighbours,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_simhash_golay": op8_simhash_golay,
    "op9_risk_controlled_rules": op9_risk_controlled_rules,
    "op10_segmented_url_filter": op10_segmented_url_filter,
    "op11_eigen_whitening": op11_eigen_whitening,
    "op12_audit_repair": op12_audit_repair,
    "op13_pitman_yor_score": op13_pitman_yor_score,
}
ORACLES: dict[str, str] = {"op12_audit_repair": OP12_SQL}
