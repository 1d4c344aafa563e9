"""Joins of a large frame with a keyed table, and the skew they must survive."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.sources.staging import stored_bytes


def _same(big: DataFrame, small: DataFrame, keys: list[str]):
    return reduce(and_, [big[k].eqNullSafe(small[f"__{k}"]) for k in keys])


def _join(big: DataFrame, small: DataFrame, keys: list[str], how: str) -> DataFrame:
    small = small.withColumnsRenamed({k: f"__{k}" for k in keys})
    return big.join(small, _same(big, small, keys), how).drop(*[f"__{k}" for k in keys])


def keyed_lookup(
    big: DataFrame,
    table: DataFrame,
    keys: list[str],
    copies: str,
    cfg: AuditConfig,
    how: str = "inner",
) -> DataFrame:
    """Join ``big`` with a staged ``table`` that has one row per key.

    ``table[copies]`` says how many rows of ``big`` carry the key at most.
    Up to ``broadcast_rows`` keys and ``broadcast_bytes`` the table is broadcast.  Beyond that only
    the hot keys are, of which there are at most rows / threshold, and the
    rest meets in a shuffle in which no key exceeds the threshold.  NULL keys
    match NULL keys.
    """
    if table.count() <= cfg.broadcast_rows and stored_bytes(table) <= cfg.broadcast_bytes:
        return _join(big, F.broadcast(table.drop(copies)), keys, how)

    total = table.agg(F.sum(copies)).first()[0] or 0
    threshold = max(cfg.hot_rows, total // cfg.broadcast_rows)
    hot = table.filter(F.col(copies) > threshold).withColumn("__hot", F.lit(True))
    cold = table.filter(F.col(copies) <= threshold).drop(copies)
    tagged = _join(big, F.broadcast(hot.drop(copies)), keys, "left")
    payload = [c for c in cold.columns if c not in keys]
    warm = tagged.filter(F.col("__hot")).drop("__hot")
    rest = tagged.filter(F.col("__hot").isNull()).drop("__hot", *payload)
    return warm.unionByName(_join(rest, cold, keys, how))


def top_k_per_group(
    df: DataFrame, group: list[str], order: list, spread: str, k: int, cfg: AuditConfig
) -> DataFrame:
    """Exactly the first ``k`` rows of each group under a total order.

    A group is first cut to ``k`` rows per salt, so that the final ranking of
    a group sees at most ``topk_salts * k`` rows however large the group is.
    """
    salt = F.pmod(F.xxhash64(spread), F.lit(cfg.topk_salts))
    near = Window.partitionBy(*group, "__salt").orderBy(*order)
    final = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("__salt", salt)
        .withColumn("__pos", F.row_number().over(near))
        .filter(F.col("__pos") <= k)
        .withColumn("__pos", F.row_number().over(final))
        .filter(F.col("__pos") <= k)
        .drop("__salt")
        .withColumnRenamed("__pos", "position")
    )
