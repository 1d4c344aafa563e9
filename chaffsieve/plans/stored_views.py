"""The nine views as views of the catalog: they read the fact table by name, so they see later loads.

Ranks and averages of a cluster come from its counts per value, as in
``plans.views``, so that no window holds the rows of a cluster.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from chaffsieve.config import AuditConfig
from chaffsieve.schema import QUALITY_FLAGS


def _half_up(num: str, den: str, scale: int, digits: int) -> str:
    """round(scale * num / den, digits) on whole numbers, half away from zero; NULL when den is 0."""
    by = scale * 10**digits
    size = f"((abs({num}) * {2 * by}L + ({den})) DIV (({den}) * 2))"
    return f"(CASE WHEN ({den}) > 0 THEN sign({num}) * {size} / {10**digits}.0D END)"


def _pct(num: str, den: str) -> str:
    return _half_up(num, den, 100, 2)


def _avg(total: str, count: str, digits: int = 1) -> str:
    return _half_up(total, count, 1, digits)


_ANY_DUPLICATE = "(is_exact_duplicate = 1 OR is_near_duplicate = 1)"
_AVG_SCORE = _avg("sum(CAST(rint(CAST(flesch_score AS DOUBLE) * 100) AS BIGINT))", "count(flesch_score) * 100")


def view_queries(fact: str, cfg: AuditConfig) -> dict[str, str]:
    """The view texts over the table ``fact``."""
    low = f"adequacy_score <= {cfg.low_adequacy_cutoff}"
    prevalence = " UNION ALL ".join(
        f"SELECT '{f.removeprefix('flag_')}' AS flag_name, CAST(sum({f}) AS BIGINT) AS n, "
        f"{_pct(f'sum({f})', 'count(*)')} AS pct FROM {fact}"
        for f in QUALITY_FLAGS
    )
    return {
        "v_cluster_composition": f"""
            SELECT cluster_label, row_count, {_pct("row_count", "sum(row_count) OVER ()")} AS pct_of_corpus,
                   avg_instruction_len, avg_response_len, avg_readability, avg_adequacy
            FROM (SELECT cluster_label, count(*) AS row_count,
                         {_avg("sum(instruction_word_count)", "count(*)")} AS avg_instruction_len,
                         {_avg("sum(output_word_count)", "count(*)")} AS avg_response_len,
                         {_AVG_SCORE} AS avg_readability,
                         {_avg("sum(adequacy_score)", "count(*)")} AS avg_adequacy
                  FROM {fact} GROUP BY cluster_label)
            ORDER BY row_count DESC, cluster_label NULLS FIRST""",
        "v_rule_vs_cluster": f"""
            SELECT prompt_type_rule, row_count, {_pct("row_count", "sum(row_count) OVER ()")} AS pct_of_corpus,
                   distinct_clusters_spanned
            FROM (SELECT prompt_type_rule, sum(n) AS row_count, count(cluster_label) AS distinct_clusters_spanned
                  FROM (SELECT prompt_type_rule, cluster_label, count(*) AS n FROM {fact} GROUP BY ALL)
                  GROUP BY prompt_type_rule)
            ORDER BY row_count DESC, prompt_type_rule""",
        "v_duplicate_rate": f"""
            SELECT cluster_label, count(*) AS total_rows, sum(is_exact_duplicate) AS exact_dupes,
                   sum(is_near_duplicate) AS near_dupes, count_if({_ANY_DUPLICATE}) AS any_dupe,
                   {_pct(f"count_if({_ANY_DUPLICATE})", "count(*)")} AS dupe_pct
            FROM {fact} GROUP BY cluster_label
            ORDER BY dupe_pct DESC, cluster_label NULLS FIRST""",
        "v_duplicate_pairs": f"""
            SELECT d.row_id AS flagged_row, left(d.instruction, 90) AS flagged_instruction,
                   k.row_id AS kept_row, left(k.instruction, 90) AS kept_instruction, d.cluster_label
            FROM {fact} d JOIN {fact} k ON d.duplicate_of = k.row_id WHERE d.is_near_duplicate = 1""",
        "v_worst_by_cluster": f"""
            WITH counted AS (
                SELECT cluster_id, adequacy_score, output_word_count, count(*) AS n FROM {fact} GROUP BY ALL
            ), ranked AS (
                SELECT *, 1 + coalesce(sum(n) OVER (
                    PARTITION BY cluster_id ORDER BY adequacy_score, output_word_count
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rk FROM counted)
            SELECT row_id, cluster_label, f.adequacy_score, n_flags, f.output_word_count,
                   left(instruction, 80) AS instruction_preview, left(output, 120) AS output_preview, rk
            FROM {fact} f JOIN ranked r ON f.cluster_id <=> r.cluster_id
                 AND f.adequacy_score <=> r.adequacy_score AND f.output_word_count <=> r.output_word_count
            WHERE rk <= {cfg.worst_per_cluster}""",
        "v_flag_prevalence": prevalence,
        "v_length_quality": f"""
            WITH counted AS (
                SELECT output_word_count, count(*) AS n FROM {fact} GROUP BY output_word_count
            ), laddered AS (
                SELECT output_word_count, coalesce(sum(n) OVER (ORDER BY output_word_count
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_before,
                       sum(n) OVER () AS total FROM counted
            ), placed AS (
                SELECT f.*, total, n_before + row_number() OVER (
                           PARTITION BY f.output_word_count ORDER BY row_id) - 1 AS place
                FROM {fact} f JOIN laddered l ON f.output_word_count <=> l.output_word_count
            ), tiled AS (
                SELECT *, CAST(CASE WHEN place < (total % 4) * (total DIV 4 + 1)
                                    THEN place DIV (total DIV 4 + 1) + 1
                                    ELSE (total % 4) + (place - (total % 4) * (total DIV 4 + 1))
                                         DIV greatest(total DIV 4, 1) + 1 END AS BIGINT) AS quartile
                FROM placed)
            SELECT quartile, count(*) AS n_rows, min(output_word_count) AS min_words,
                   max(output_word_count) AS max_words,
                   {_avg("sum(adequacy_score)", "count(*)")} AS avg_adequacy, {_AVG_SCORE} AS avg_readability
            FROM tiled GROUP BY quartile ORDER BY quartile""",
        "v_deviation_from_cluster": f"""
            WITH counted AS (
                SELECT cluster_id, output_word_count, count(*) AS n FROM {fact} GROUP BY ALL
            ), laddered AS (
                SELECT *, sum(n) OVER c AS total, sum(n * output_word_count) OVER c AS words,
                       coalesce(sum(n) OVER (PARTITION BY cluster_id ORDER BY output_word_count
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_before
                FROM counted WINDOW c AS (PARTITION BY cluster_id))
            SELECT row_id, cluster_label, f.output_word_count,
                   {_avg("words", "total")} AS cluster_avg_len,
                   {_avg("(f.output_word_count * total - words)", "total")} AS deviation,
                   coalesce({_half_up("n_before", "(total - 1)", 1, 3)}, 0.0D) AS pct_rank_in_cluster,
                   adequacy_score
            FROM {fact} f JOIN laddered l ON f.cluster_id <=> l.cluster_id
                 AND f.output_word_count <=> l.output_word_count""",
        "v_cleaning_impact": f"""
            SELECT cluster_label, disposition, n_rows,
                   {_pct("n_rows", "sum(n_rows) OVER (PARTITION BY cluster_label)")} AS pct_of_cluster
            FROM (SELECT cluster_label, disposition, count(*) AS n_rows
                  FROM (SELECT cluster_label, CASE WHEN {_ANY_DUPLICATE} THEN 'drop_duplicate'
                                                   WHEN {low} THEN 'drop_low_quality' ELSE 'keep' END AS disposition
                        FROM {fact})
                  GROUP BY cluster_label, disposition)
            ORDER BY cluster_label NULLS FIRST, disposition""",
    }


def create_views(spark: SparkSession, fact: str, cfg: AuditConfig, prefix: str = "") -> list[str]:
    """Create or replace the views over the table ``fact`` of the catalog; ``prefix`` may name a database."""
    names = []
    for name, text in view_queries(fact, cfg).items():
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{name} AS {text}")
        names.append(f"{prefix}{name}")
    return names
