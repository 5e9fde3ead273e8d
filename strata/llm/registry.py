"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (
    decontam,
    embed_dedup,
    html_text,
    jaccard_join,
    licenses,
    line_dedup,
    mixing,
    periodic_runs,
    quality,
    sharding,
    token_alignment,
    token_count,
    toxicity,
)
from strata.llm.scratch import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_digest(_table(spark, sf_dir, "documents"), Scratch(spark, "lines"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(_table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), Scratch(spark, "quality"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_links(_table(spark, sf_dir, "embeddings"), Scratch(spark, "embeddings"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), Scratch(spark, "jaccard"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_digest(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), Scratch(spark, "decontam")
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(_table(spark, sf_dir, "documents"), Scratch(spark, "shards"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), Scratch(spark, "toxicity")
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_digest(_table(spark, sf_dir, "documents"), Scratch(spark, "mixing"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_spans(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.runs_digest(periodic_runs.with_planted_periods(_table(spark, sf_dir, "documents")))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(_table(spark, sf_dir, "pages"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_digest(_table(spark, sf_dir, "documents"), Scratch(spark, "alignment"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_quality": op3_quality,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_licenses": op10_licenses,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_html_text": op12_html_text,
    "op13_token_alignment": op13_token_alignment,
}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": f"""
        WITH split AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
        ), lines AS (
            SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split
        ), keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_AZ}) AS key
            FROM lines
        ), owners AS (
            SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key
        ), kept AS (
            SELECT k.doc_id, k.line, k.pos, (o.owner IS NULL OR o.owner = k.doc_id) AS keep
            FROM keyed k LEFT JOIN owners o ON o.key = k.key AND length(k.key) >= 10
        )
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (NOT keep)::BIGINT AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (keep), '')) AS kept_sha256
        FROM kept GROUP BY doc_id""",
    "op6_decontamination": rf"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), i AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), sized AS (
            SELECT item_id, w, least(len(w), 13) AS n FROM i WHERE len(w) > 0
        ), item_runs AS (
            SELECT DISTINCT item_id, n, array_to_string(w[a : a + n - 1], ' ') AS run
            FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS a FROM sized)
        ), doc_runs AS (
            SELECT doc_id, n, a, array_to_string(w[a : a + n - 1], ' ') AS run
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS a
                  FROM w, (SELECT DISTINCT n FROM item_runs) WHERE len(w) >= n)
        ), found AS (
            SELECT d.doc_id, d.a, d.n, r.item_id FROM doc_runs d JOIN item_runs r USING (n, run)
        ), hits AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(a, a + n)) AS p FROM found) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
        )
        SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
        FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op9_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   ([3, 1, 2])[(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS w
            FROM sized GROUP BY source
        ), levels AS (
            SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS everything, source_size * 2.0::DOUBLE AS cap,
                   coalesce(sum(source_size * 2.0::DOUBLE) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                       AS capped,
                   sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS remaining,
                   row_number() OVER o AS k
            FROM sources WINDOW o AS (ORDER BY source_size * 2.0::DOUBLE / w, source ASC NULLS LAST)
        ), first_free AS (
            SELECT capped AS c, remaining AS r, k AS k0 FROM levels
            WHERE cap * remaining > (everything - capped) * w ORDER BY k LIMIT 1
        ), goals AS (
            SELECT source, source_size,
                   CASE WHEN k0 IS NULL OR k < k0 THEN cap ELSE (everything - c) * w / r END AS target
            FROM levels LEFT JOIN first_free ON true
        ), rests AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM goals
        ), running AS (
            SELECT source, h, sum(s) OVER (PARTITION BY source ORDER BY h) AS upto, s
            FROM (SELECT source, h, sum(size) AS s FROM sized GROUP BY source, h)
        )
        SELECT d.doc_id, d.size, r.source_size, r.target,
               (d.size * (r.whole + CASE
                   WHEN u.upto <= r.target - r.whole * r.source_size THEN 1
                   WHEN u.upto - u.s <= r.target - r.whole * r.source_size
                        AND 2 * (r.target - r.whole * r.source_size - (u.upto - u.s)) >= u.s THEN 1
                   ELSE 0 END))::BIGINT AS taken
        FROM sized d
        JOIN rests r ON d.source IS NOT DISTINCT FROM r.source
        JOIN running u ON d.source IS NOT DISTINCT FROM u.source AND d.h = u.h""",
}
