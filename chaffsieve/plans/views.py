"""The nine analytical views as functions of the fact table.

Windows over a cluster would put a hot cluster into one task, so ranks and
cluster averages come from counts per value (``value_ladder``) that are looked
up, and windows remain only over already grouped rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.functions import rules
from chaffsieve.functions.numeric import cents, percent, ratio
from chaffsieve.functions.text import preview
from chaffsieve.operators.lookup import keyed_lookup
from chaffsieve.operators.order import assign_ntile, value_ladder
from chaffsieve.schema import QUALITY_FLAGS
from chaffsieve.sources.staging import stage


def _average(name: str, digits: int):
    return ratio(F.sum(name), F.count(name), digits)


def _average_score(digits: int):
    """Mean of the non-NULL readability scores."""
    return ratio(F.sum(cents(F.col("flesch_score"))), F.count("flesch_score") * 100, digits)


def cluster_composition(fact: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Size, share and averages of each cluster."""
    grouped = fact.groupBy("cluster_label").agg(
        F.count("*").alias("row_count"),
        _average("instruction_word_count", 1).alias("avg_instruction_len"),
        _average("output_word_count", 1).alias("avg_response_len"),
        _average_score(1).alias("avg_readability"),
        _average("adequacy_score", 1).alias("avg_adequacy"),
    )
    total = F.sum("row_count").over(Window.partitionBy())
    return grouped.select(
        "cluster_label",
        "row_count",
        percent(F.col("row_count"), total, 2).alias("pct_of_corpus"),
        "avg_instruction_len",
        "avg_response_len",
        "avg_readability",
        "avg_adequacy",
    ).orderBy(F.desc("row_count"), F.asc_nulls_first("cluster_label"))


def rule_vs_cluster(fact: DataFrame, cfg: AuditConfig) -> DataFrame:
    """How the rule classes spread over the clusters."""
    cells = fact.groupBy("prompt_type_rule", "cluster_label").agg(F.count("*").alias("n"))
    grouped = cells.groupBy("prompt_type_rule").agg(
        F.sum("n").alias("row_count"),
        F.count("cluster_label").alias("distinct_clusters_spanned"),
    )
    total = F.sum("row_count").over(Window.partitionBy())
    return grouped.select(
        "prompt_type_rule",
        "row_count",
        percent(F.col("row_count"), total, 2).alias("pct_of_corpus"),
        "distinct_clusters_spanned",
    ).orderBy(F.desc("row_count"), "prompt_type_rule")


def duplicate_rate(fact: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Redundancy per cluster."""
    dupes = F.count_if(rules.any_duplicate())
    return (
        fact.groupBy("cluster_label")
        .agg(
            F.count("*").alias("total_rows"),
            F.sum("is_exact_duplicate").alias("exact_dupes"),
            F.sum("is_near_duplicate").alias("near_dupes"),
            dupes.alias("any_dupe"),
            percent(dupes, F.count("*"), 2).alias("dupe_pct"),
        )
        .orderBy(F.desc("dupe_pct"), F.asc_nulls_first("cluster_label"))
    )


def duplicate_pairs(fact: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Flagged rows next to the row they repeat.

    Any number of rows may point at one kept row; the table of kept rows
    carries that number, so hot ones are looked up without a shuffle.
    """
    flagged = fact.filter(
        (F.col("is_near_duplicate") == 1) & F.col("duplicate_of").isNotNull()
    ).select(
        F.col("row_id").alias("flagged_row"),
        preview(F.col("instruction"), 90).alias("flagged_instruction"),
        F.col("duplicate_of").alias("kept_row"),
        "cluster_label",
    )
    pointed = flagged.groupBy("kept_row").agg(F.count("*").alias("copies"))
    kept = fact.select(
        F.col("row_id").alias("kept_row"),
        preview(F.col("instruction"), 90).alias("kept_instruction"),
    )
    table = stage(pointed.join(kept, "kept_row"), "kept-rows")
    return keyed_lookup(flagged, table, ["kept_row"], "copies", cfg).select(
        "flagged_row", "flagged_instruction", "kept_row", "kept_instruction", "cluster_label"
    )


def worst_by_cluster(fact: DataFrame, cfg: AuditConfig) -> DataFrame:
    """The lowest ranks of each cluster, ties kept.

    A rank is one more than the rows below, so it belongs to the pair
    (score, words); only the few qualifying pairs are looked up.
    """
    order = ["adequacy_score", "output_word_count"]
    ranks = value_ladder(fact, ["cluster_id"], order).filter(
        F.col("n_before") < cfg.worst_per_cluster
    )
    table = stage(
        ranks.select("cluster_id", *order, (F.col("n_before") + 1).alias("rk"), "n"), "ranks"
    )
    return keyed_lookup(fact, table, ["cluster_id", *order], "n", cfg).select(
        "row_id",
        "cluster_label",
        "adequacy_score",
        "n_flags",
        "output_word_count",
        preview(F.col("instruction"), 80).alias("instruction_preview"),
        preview(F.col("output"), 120).alias("output_preview"),
        "rk",
    )


def flag_prevalence(fact: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Rows and share per quality flag: one scan, then columns to rows."""
    counts = fact.agg(
        F.count("*").alias("rows"),
        *[F.sum(f).alias(f.removeprefix("flag_")) for f in QUALITY_FLAGS],
    )
    return counts.unpivot(
        "rows", [f.removeprefix("flag_") for f in QUALITY_FLAGS], "flag_name", "n"
    ).select("flag_name", "n", percent(F.col("n"), F.col("rows"), 2).alias("pct"))


def length_quality(fact: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Response-length quartiles against quality."""
    narrow = fact.select("row_id", "output_word_count", "adequacy_score", "flesch_score")
    return (
        assign_ntile(narrow, "output_word_count", "row_id", 4, "quartile")
        .groupBy("quartile")
        .agg(
            F.count("*").alias("n_rows"),
            F.min("output_word_count").alias("min_words"),
            F.max("output_word_count").alias("max_words"),
            _average("adequacy_score", 1).alias("avg_adequacy"),
            _average_score(1).alias("avg_readability"),
        )
        .orderBy("quartile")
    )


def deviation_from_cluster(fact: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Every row against the average length of its cluster.

    All three figures depend on (cluster, words) only and are worked out once
    per such pair.
    """
    words = F.col("output_word_count").cast("bigint")
    ladder = value_ladder(fact, ["cluster_id"], ["output_word_count"])
    cluster_words = F.sum(words * F.col("n")).over(Window.partitionBy("cluster_id"))
    ladder = ladder.withColumn("cluster_words", cluster_words)
    rows = F.col("n_total")
    table = stage(
        ladder.select(
            "cluster_id",
            "output_word_count",
            ratio(F.col("cluster_words"), rows, 1).alias("cluster_avg_len"),
            ratio(words * rows - F.col("cluster_words"), rows, 1).alias("deviation"),
            F.coalesce(ratio(F.col("n_before"), rows - 1, 3), F.lit(0.0)).alias(
                "pct_rank_in_cluster"
            ),
            "n",
        ),
        "lengths",
    )
    return keyed_lookup(fact, table, ["cluster_id", "output_word_count"], "n", cfg).select(
        "row_id",
        "cluster_label",
        "output_word_count",
        "cluster_avg_len",
        "deviation",
        "pct_rank_in_cluster",
        "adequacy_score",
    )


def cleaning_impact(fact: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Rows per cluster and recommended treatment."""
    grouped = fact.groupBy("cluster_label", rules.disposition(cfg).alias("disposition")).agg(
        F.count("*").alias("n_rows")
    )
    cluster = F.sum("n_rows").over(Window.partitionBy("cluster_label"))
    return grouped.select(
        "cluster_label",
        "disposition",
        "n_rows",
        percent(F.col("n_rows"), cluster, 2).alias("pct_of_cluster"),
    ).orderBy(F.asc_nulls_first("cluster_label"), "disposition")


VIEWS: dict[str, Callable[[DataFrame, AuditConfig], DataFrame]] = {
    "v_cluster_composition": cluster_composition,
    "v_rule_vs_cluster": rule_vs_cluster,
    "v_duplicate_rate": duplicate_rate,
    "v_duplicate_pairs": duplicate_pairs,
    "v_worst_by_cluster": worst_by_cluster,
    "v_flag_prevalence": flag_prevalence,
    "v_length_quality": length_quality,
    "v_deviation_from_cluster": deviation_from_cluster,
    "v_cleaning_impact": cleaning_impact,
}


def register_views(fact: DataFrame, cfg: AuditConfig) -> None:
    """Make the views readable by name in the session."""
    for name, view in VIEWS.items():
        view(fact, cfg).createOrReplaceTempView(name)
