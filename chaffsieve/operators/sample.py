"""Reproducible samples: rows ordered by a digest of their id."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.functions import rules
from chaffsieve.operators.order import nth_row
from chaffsieve.schema import QUALITY_FLAGS

# Hex digits of the digest that stand for a number in [0, 1).
_DIGITS = 12


def draw(row_id: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")))


def sample_rows(df: DataFrame, n: int, row_id: str = "row_id", seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, uniformly and without replacement.

    The n smallest digests win.  Only digests are sorted, those under a cut-off
    that n rows stay below with overwhelming probability (if fewer do, all);
    rows are then filtered where they lie, so the sample keeps its partitions.
    """
    rows = df.count()
    if rows <= n:
        return df
    ordered = df.withColumn("__draw", draw(row_id, seed))
    share = n / rows + 6 * math.sqrt(n) / rows + 10 / rows
    if share < 1:
        cut = f"{int(share * 16**_DIGITS):0{_DIGITS}x}"
        fewer = ordered.filter(F.col("__draw") < cut)
        if fewer.count() >= n:
            ordered = fewer
    last = nth_row(ordered, ["__draw", row_id], n)
    drawn, at = F.col("__draw"), F.lit(last["__draw"])
    return ordered.filter(
        (drawn < at) | ((drawn == at) & (F.col(row_id) <= F.lit(last[row_id])))
    ).drop("__draw")


def review_sample(df: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Low scorers to read by hand."""
    return (
        df.filter(rules.low_adequacy(cfg))
        .withColumn("__draw", draw("row_id", cfg.seed))
        .orderBy("__draw", "row_id")
        .limit(cfg.review_rows)
        .select("row_id", "instruction", "output", "n_flags", "adequacy_score", *QUALITY_FLAGS)
    )
