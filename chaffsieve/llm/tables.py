"""What the operators of this folder share: reading, batch sizes, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chaffsieve.sources.staging import small_batches, stored_bytes  # noqa: F401

# A staged table is broadcast up to this many rows and stored bytes.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20

# A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """A NULL text counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def remainder(name: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``: the folds of the classifiers."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % divisor


def meet(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join with a staged table that has one row per key.

    Counting a staged table reads file footers.  Up to BROADCAST_ROWS rows and
    BROADCAST_BYTES are broadcast; beyond that both sides are shuffled
    plainly, so that adaptive execution can split a hot key of the big side.
    """
    if small.count() <= BROADCAST_ROWS and stored_bytes(small) <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), keys, how)
    return big.join(small.hint("merge"), keys, how)
