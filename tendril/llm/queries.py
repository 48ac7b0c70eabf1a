"""Queries over the given tables, one per operator, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, decontamination, licenses, line_dedup, mixing, ngram_join, packing, personal_data, quality, sharding, spelling, suffix_tree, token_counts
from .common import stored, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data_report(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # read for the lengths and for their ranges; stored, so that texts are encoded once
    return token_counts.context_limits(stored(token_counts.length_histogram(table(spark, sf_dir, "documents")), "lengths"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_report(table(spark, sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_report(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(table(spark, sf_dir, "conversations"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_report(table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_line_dedup, op2_license_scan, op3_decontamination, op4_personal_data, op5_quality_rules, op6_token_counts, op7_sharding, op8_lm_scoring, op9_ngram_join, op10_mixing,
    op11_conversation_repair, op12_spelling_variants, op13_packing)}

_FOLDED = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op3_decontamination": f"""
WITH d AS (SELECT doc_id, coalesce({_FOLDED}, []) AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 10) AS size FROM (SELECT item_id, {_FOLDED} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM b)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, dw.size, i, item_id FROM dw JOIN bw USING (size, g)),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_sharding": sharding.report_sql(),
    "op11_conversation_repair": conversations.report_sql(),
    "op12_spelling_variants": spelling.report_sql(),
}
