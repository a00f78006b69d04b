"""Queries of the corpus problems and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from boardloom.llm import canonical_values, corpus_tokens, format_duplicates, history_dedup, mixture, mojibake, subjects, truncation
from boardloom.plans.work import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    """Name and query of each problem in this package."""
    return {
        "p1_found": lambda s, d: canonical_values.canonical_findings(table(s, d, "findings"), table(s, d, "reference_items")).select("row_id", "field", "item_id"),
        "p1_unmatched": lambda s, d: canonical_values.unmatched(table(s, d, "findings"), table(s, d, "reference_items")),
        "p2_found": lambda s, d: format_duplicates.finding_copies(table(s, d, "findings")),
        "p2_groups": lambda s, d: format_duplicates.finding_groups(table(s, d, "findings")),
        "p3_found": lambda s, d: history_dedup.known_findings(table(s, d, "findings")),
        "p4_found": lambda s, d: mojibake.garbled_values(table(s, d, "findings"), table(s, d, "schools")).select("tab", "rec_key"),
        "p4_restored": lambda s, d: mojibake.garbled_values(table(s, d, "findings"), table(s, d, "schools")).select("tab", "rec_key", "restored"),
        "p6_found": lambda s, d: truncation.cut_titles(table(s, d, "findings"), table(s, d, "schools")).select("row_id"),
        "p6_rates": lambda s, d: truncation.cut_rates(table(s, d, "findings"), table(s, d, "schools")),
        "p7_ids": lambda s, d: corpus_tokens.document_ids(table(s, d, "documents")),
        "p8_mix": lambda s, d: mixture.mix(table(s, d, "documents"), table(s, d, "mix_targets")),
        "p8_shares": lambda s, d: mixture.mix_report(table(s, d, "documents"), table(s, d, "mix_targets")),
        "p8_targets": lambda s, d: mixture.targets_met(table(s, d, "documents"), table(s, d, "mix_targets")),
        "p9_found": lambda s, d: subjects.document_subjects(*(table(s, d, t) for t in ("documents", "subject_labels", "subjects"))),
        "p9_composition": lambda s, d: subjects.composition(*(table(s, d, t) for t in ("documents", "subject_labels", "subjects"))),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that have one; the others are tested against brute force on fixtures."""
    bare = r"lower(regexp_replace(coalesce(url, ''), '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g'))"
    return {
        "p2_found": rf"""
        WITH c AS (SELECT row_id, school_code, list_sort(regexp_extract_all(lower(upper(coalesce(title, ''))), '[\p{{L}}\p{{N}}]+')) AS words, {bare} AS u FROM findings),
        k AS (SELECT row_id, school_code, words, regexp_replace(regexp_extract(u, '^([^?#]*)', 1), '/$', '') AS path, list_sort(string_split(regexp_extract(u, '^[^?#]*[?]([^#]*)', 1), '&')) AS params, regexp_extract(u, '#.*$') AS place FROM c),
        g AS (SELECT row_id, min(row_id) OVER (PARTITION BY school_code, words, path, params, place) AS kept_row_id FROM k)
        SELECT kept_row_id, row_id FROM g WHERE row_id <> kept_row_id""",
        "p2_groups": rf"""
        WITH c AS (SELECT row_id, school_code, list_sort(regexp_extract_all(lower(upper(coalesce(title, ''))), '[\p{{L}}\p{{N}}]+')) AS words, {bare} AS u FROM findings),
        k AS (SELECT row_id, school_code, words, regexp_replace(regexp_extract(u, '^([^?#]*)', 1), '/$', '') AS path, list_sort(string_split(regexp_extract(u, '^[^?#]*[?]([^#]*)', 1), '&')) AS params, regexp_extract(u, '#.*$') AS place FROM c)
        SELECT min(row_id) AS kept_row_id, count(*) AS copies FROM k GROUP BY school_code, words, path, params, place""",
        "p3_found": r"""
        WITH r AS (SELECT row_id, coalesce(school_code, chr(1)) AS s, coalesce(epoch_us(first_seen), -4611686018427387904) AS ts, coalesce(origin, 'nuovo') <> 'archivio' AS fresh,
            regexp_extract_all(lower(upper(coalesce(title, ''))), '[\p{L}\p{N}]+') AS ws FROM findings),
        w AS (SELECT row_id, s, ts, fresh, n, word, row_number() OVER (PARTITION BY row_id, word) AS k FROM (SELECT row_id, s, ts, fresh, len(ws) AS n, unnest(ws) AS word FROM r)),
        near AS (SELECT a.row_id FROM w a JOIN w b ON a.s = b.s AND a.word = b.word AND a.k = b.k AND (b.ts < a.ts OR b.ts = a.ts AND b.row_id < a.row_id)
            WHERE a.fresh GROUP BY a.row_id, b.row_id HAVING greatest(any_value(a.n), any_value(b.n)) - count(*) <= 3),
        short AS (SELECT a.row_id FROM r a JOIN r b ON a.s = b.s AND (b.ts < a.ts OR b.ts = a.ts AND b.row_id < a.row_id) WHERE a.fresh AND len(a.ws) <= 3 AND len(b.ws) <= 3)
        SELECT DISTINCT row_id FROM (SELECT row_id FROM near UNION ALL SELECT row_id FROM short)""",
        "p8_targets": "SELECT source, target_share, max_repeats, true AS met, true AS kept FROM mix_targets WHERE source IS NOT NULL",
    }
