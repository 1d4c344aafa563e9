"""Row rules of the quality stage."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.schema import QUALITY_FLAGS


def group_key(df: DataFrame) -> str:
    """Cluster where clustering ran, rule class otherwise."""
    return "cluster_id" if "cluster_id" in df.columns else "prompt_type_rule"


def flag_too_short(words: Column, cfg: AuditConfig) -> Column:
    return (words < cfg.min_output_words).cast("int")


def flag_empty_ish(words: Column, cfg: AuditConfig) -> Column:
    return (words < cfg.empty_output_words).cast("int")


def n_flags() -> Column:
    return reduce(add, [F.col(f) for f in QUALITY_FLAGS])


def adequacy(flags: Column, cfg: AuditConfig) -> Column:
    return F.greatest(F.lit(100) - flags * cfg.flag_penalty, F.lit(0))


def prose_only() -> Column:
    return (F.col("is_code_like") == 0) & F.col("flesch_score").isNotNull()


def any_duplicate() -> Column:
    return (F.col("is_exact_duplicate") == 1) | (F.col("is_near_duplicate") == 1)


def low_adequacy(cfg: AuditConfig) -> Column:
    return F.col("adequacy_score") <= cfg.low_adequacy_cutoff


def disposition(cfg: AuditConfig) -> Column:
    return (
        F.when(any_duplicate(), "drop_duplicate")
        .when(low_adequacy(cfg), "drop_low_quality")
        .otherwise("keep")
    )
