"""Stage 3: quality flags, adequacy score, audit report, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.functions import rules
from chaffsieve.functions import text as fx
from chaffsieve.functions.numeric import cents, percent, ratio
from chaffsieve.operators.lookup import keyed_lookup
from chaffsieve.operators.order import value_at, value_ladder
from chaffsieve.schema import QUALITY_FLAGS
from chaffsieve.sources.staging import small_batches, stage


def row_flags(df: DataFrame, cfg: AuditConfig) -> DataFrame:
    """The four flags that need nothing but the row itself."""
    small_batches(df.sparkSession)
    output, words = F.col("output"), F.col("output_word_count")
    return df.withColumns(
        {
            "flag_truncated": fx.is_truncated(output, cfg.terminal_punct),
            "flag_too_short": rules.flag_too_short(words, cfg),
            "flag_empty_ish": rules.flag_empty_ish(words, cfg),
            "flag_repetitive": fx.has_repeated_ngram(
                output, cfg.repeat_ngram_n, cfg.repeat_ngram_min_count
            ),
        }
    )


def readability_fences(df: DataFrame, group: str) -> DataFrame:
    """(group, n, q1, q3, lo, hi) of prose scores, staged; in eighths of a hundredth.

    Quartiles interpolate linearly.  A position is a multiple of a quarter and
    scores are whole hundredths, so eight times each fence is a whole number
    and comparisons with it are exact.
    """
    scores = df.filter(rules.prose_only() & F.col(group).isNotNull()).select(
        group, cents(F.col("flesch_score")).alias("score")
    )
    ladder = value_ladder(scores, [group], ["score"])
    last = F.col("n_total") - 1

    def quartile(which: int) -> list:
        below = F.call_function("div", last * which, F.lit(4))
        return [
            value_at("score", below).alias(f"at{which}"),
            value_at("score", F.least(below + 1, last)).alias(f"next{which}"),
        ]

    def interpolated(which: int):
        part = (F.col("n") - 1) * which % 4
        return F.col(f"at{which}") * (4 - part) + F.col(f"next{which}") * part

    corners = ladder.groupBy(group).agg(F.max("n_total").alias("n"), *quartile(1), *quartile(3))
    quarters = corners.select(
        group, "n", interpolated(1).alias("q1x4"), interpolated(3).alias("q3x4")
    )
    spread = 3 * (F.col("q3x4") - F.col("q1x4"))
    return stage(
        quarters.select(
            group,
            "n",
            (F.col("q1x4") * 2).alias("q1"),
            (F.col("q3x4") * 2).alias("q3"),
            (F.col("q1x4") * 2 - spread).alias("lo"),
            (F.col("q3x4") * 2 + spread).alias("hi"),
        ),
        "fences",
    )


def flag_readability_outliers(df: DataFrame, cfg: AuditConfig) -> DataFrame:
    """1 for prose strictly outside its group's fences."""
    group = rules.group_key(df)
    fences = readability_fences(df, group).select(group, "n", "lo", "hi")
    score = cents(F.col("flesch_score")) * 8
    outside = rules.prose_only() & ((score < F.col("lo")) | (score > F.col("hi")))
    return (
        keyed_lookup(df, fences, [group], "n", cfg, how="left")
        .withColumn("flag_readability_outlier", F.coalesce(outside, F.lit(False)).cast("int"))
        .drop("lo", "hi")
    )


def score_adequacy(df: DataFrame, cfg: AuditConfig) -> DataFrame:
    df = df.withColumn("n_flags", rules.n_flags())
    return df.withColumn("adequacy_score", rules.adequacy(F.col("n_flags"), cfg))


def flag_quality(df: DataFrame, cfg: AuditConfig) -> DataFrame:
    """All five flags, their number and the score."""
    if "flag_truncated" not in df.columns:
        df = row_flags(df, cfg)
    return score_adequacy(flag_readability_outliers(df, cfg), cfg)


def audit_report(df: DataFrame, cfg: AuditConfig) -> DataFrame:
    """The audit in one row: counts, shares, flag counts, cluster sizes.

    One scan: sums per cluster label first, then over the few labels.
    """
    label = F.col("cluster_label") if "cluster_label" in df.columns else F.lit(None)
    dupe, low = rules.any_duplicate(), rules.low_adequacy(cfg)
    parts = df.groupBy(label.cast("string").alias("label")).agg(
        F.count("*").alias("n"),
        F.sum("is_exact_duplicate").alias("exact"),
        F.sum("is_near_duplicate").alias("near"),
        F.count_if(dupe).alias("dupe"),
        F.count_if(low).alias("low"),
        F.count_if(dupe | low).alias("drop"),
        F.sum("adequacy_score").alias("score"),
        *[F.sum(f).alias(f) for f in QUALITY_FLAGS],
    )
    named = F.when(F.col("label").isNotNull(), F.struct("label", "n"))

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0))

    sums = parts.agg(
        *[total(c).alias(c) for c in parts.columns if c != "label"],
        F.map_from_entries(F.collect_list(named)).alias("cluster_sizes"),
    )
    n = F.col("n")
    return sums.select(
        n.alias("total_rows"),
        F.col("exact").alias("exact_duplicates"),
        F.col("near").alias("near_duplicates"),
        F.col("dupe").alias("duplicate_rows_union"),
        percent(F.col("dupe"), n, 2).alias("duplicate_pct"),
        F.col("low").alias("low_adequacy_rows"),
        percent(F.col("low"), n, 2).alias("low_adequacy_pct"),
        F.struct(*QUALITY_FLAGS).alias("flag_counts"),
        ratio(F.col("score"), n, 2).alias("mean_adequacy"),
        F.col("drop").alias("recommended_drop_rows"),
        percent(F.col("drop"), n, 2).alias("recommended_drop_pct"),
        (n - F.col("drop")).alias("rows_remaining_after_clean"),
        "cluster_sizes",
    )


def rule_baseline(df: DataFrame) -> DataFrame:
    """Rows and share per rule class, with the share of unclassified rows beside each."""
    counts = df.groupBy("prompt_type_rule").agg(F.count("*").alias("row_count"))
    # A window over the rule classes, of which there is a fixed handful.
    everything = Window.partitionBy()
    other = F.when(F.col("prompt_type_rule") == fx.OTHER_CLASS, F.col("row_count")).otherwise(0)
    total = F.sum("row_count").over(everything)
    return counts.select(
        "prompt_type_rule",
        "row_count",
        percent(F.col("row_count"), total, 1).alias("pct"),
        percent(F.sum(other).over(everything), total, 1).alias("other_pct"),
    ).orderBy(F.desc("row_count"), "prompt_type_rule")


def cluster_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("cluster_id", "cluster_label").agg(F.count("*").alias("row_count"))


def flagged_per_cluster(df: DataFrame) -> DataFrame:
    """Rows and near duplicates per cluster."""
    return df.groupBy("cluster_id").agg(
        F.count("*").alias("row_count"), F.sum("is_near_duplicate").alias("flagged")
    )


def low_adequacy_rows(df: DataFrame, cfg: AuditConfig) -> DataFrame:
    return df.filter(rules.low_adequacy(cfg))


def root_of(df: DataFrame, cfg: AuditConfig, max_hops: int = 40) -> DataFrame:
    """(row_id, root): the unflagged row at the end of each duplicate_of chain.

    Pointer jumping halves the chains per pass; pointers lead to earlier rows,
    so they end.  Each pass looks up only the rows that are pointed at and
    point on.
    """
    links = stage(
        df.filter(F.col("duplicate_of").isNotNull()).select(
            "row_id", F.col("duplicate_of").alias("root")
        ),
        "links",
    )
    for _ in range(max_hops):
        pointed = links.groupBy("root").agg(F.count("*").alias("n"))
        onward = links.select(F.col("row_id").alias("root"), F.col("root").alias("next"))
        table = stage(pointed.join(onward, "root"), "onward")
        if table.count() == 0:
            return links
        jumped = keyed_lookup(links, table, ["root"], "n", cfg, how="left")
        links = stage(jumped.select("row_id", F.coalesce("next", "root").alias("root")), "links")
    raise RuntimeError(f"duplicate chains longer than 2**{max_hops}")
