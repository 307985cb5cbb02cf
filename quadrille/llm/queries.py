"""One query per operator, over whole tables with production parameters, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, exact_dedup, html_text, language_id, near_dedup, packing, quality_model, quality_rules, secrets, substring_dedup
from ._common import bound_batches


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_read(spark, sf_dir, "documents"), with_ids=False)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _read(spark, sf_dir, "documents"), language_id.fold("doc_id", 4, 2)
    return language_id.predict(docs, language_id.train(docs.where(~held_out)), "doc_id", "text", held_out.alias("held_out"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(_read(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels, held_out = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), language_id.fold("doc_id", 3, 1)
    return quality_model.score(docs, quality_model.train(docs, labels, only=~held_out), "doc_id", "text", held_out.alias("held_out"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(_read(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_read(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_html_text, op2_packing, op3_bpe, op4_secrets, op5_language, op6_exact_dedup, op7_quality, op8_near_dedup, op9_substring_dedup, op10_quality_rules, pipeline)}


def oracle_sql() -> dict[str, str]:
    """SQL for the whole result of a query. The other operators' results (ids of a tokenizer, learned models, spans at
    positions, parsed pages, packing plans) can't be said in SQL; their tests compare with brute force."""
    return {
        "op6_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
        """,
        "op9_substring_dedup": r"""
            WITH words AS (
                SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
            ), windows AS (
                SELECT doc_id, pos, array_to_string(w[pos : pos + 49], ' ') AS win
                FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS pos FROM words WHERE len(w) >= 50)
            ), first AS (SELECT md5_number(win) AS h, min(doc_id) AS least FROM windows GROUP BY ALL),
            bad AS (
                SELECT doc_id, pos FROM windows JOIN first ON md5_number(win) = h WHERE doc_id > least
            ), gone AS (
                SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + 49)) AS pos FROM bad
            ), gone_lists AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
            kept AS (
                SELECT doc_id, string_agg(x, ' ' ORDER BY pos) AS k
                FROM (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS pos FROM words WHERE len(w) > 0) ANTI JOIN gone USING (doc_id, pos)
                GROUP BY doc_id
            )
            SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
            FROM words LEFT JOIN gone_lists USING (doc_id) LEFT JOIN kept USING (doc_id)
        """,
    }
