"""Rows added to a corpus that is already numbered, batch by batch.

Each batch is saved under its own number: its enriched rows, which continue
the row ids, and the digests of the pairs first seen in it.  A new batch meets
the digests of all earlier ones, never their texts, and a batch that is run
again replaces what it wrote before, so a stream may replay it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chaffsieve.config import AuditConfig
from chaffsieve.operators.clean import check_keys, clean, engineer, pair_digest
from chaffsieve.operators.order import dense_positions
from chaffsieve.operators.quality import row_flags
from chaffsieve.schema import RAW
from chaffsieve.sources import sinks
from chaffsieve.sources.staging import stage, stored_bytes


def _batches(spark: SparkSession, root: str, kind: str, before: int | None = None) -> list[int]:
    """Numbers of the saved batches, those below ``before`` only if it is given."""
    names = sinks.folders(spark, f"{root}/{kind}")
    found = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
    return [b for b in found if before is None or b < before]


def _read(spark: SparkSession, root: str, kind: str, before: int | None = None) -> DataFrame | None:
    """Rows of the saved batches with a column ``batch``."""
    paths = [f"{root}/{kind}/batch={b}" for b in _batches(spark, root, kind, before)]
    return spark.read.option("basePath", f"{root}/{kind}").parquet(*paths) if paths else None


def read_rows(spark: SparkSession, root: str) -> DataFrame:
    """The enriched rows of all batches."""
    found = _read(spark, root, "rows")
    if found is None:
        raise FileNotFoundError(f"no batch under {root}")
    return found.drop("batch", "order_key")


def append_batch(spark: SparkSession, root: str, batch: int, raw: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Clean, number and enrich ``raw`` as batch ``batch`` of the corpus under ``root``.

    Keys must be unique and above those of all earlier batches; row ids go on
    from theirs.  A row is an exact duplicate if its pair occurs in an earlier
    batch or earlier in this one.  A batch without usable rows is saved empty.
    """
    cleaned = clean(raw)
    pairs = stage(cleaned.select("order_key", pair_digest().alias("pair")), "batch-pairs")
    check_keys(pairs, "order_key")
    earlier = _read(spark, root, "rows", batch)
    rows_before = 0
    if earlier is not None:
        last = earlier.agg(F.count("*").alias("n"), F.max("order_key").alias("key")).first()
        first = pairs.agg(F.min("order_key")).first()[0]
        rows_before = last["n"]
        if first is not None and last["key"] is not None and first <= last["key"]:
            raise ValueError(f"key {first} does not come after {last['key']}, the last of the earlier rows")

    firsts = stage(pairs.groupBy("pair").agg(F.min("order_key").alias("order_key")), "batch-firsts")
    known = _read(spark, root, "pairs", batch)
    if known is not None:
        small = firsts.count() <= cfg.broadcast_rows and stored_bytes(firsts) <= cfg.broadcast_bytes
        # The earlier digests are only scanned while the batch is small.
        side = F.broadcast(firsts.select("pair")) if small else firsts.select("pair")
        seen = stage(known.select("pair").join(side, "pair", "left_semi"), "pairs-seen")
        firsts = stage(firsts.join(seen, "pair", "left_anti"), "batch-new-pairs")
    marked = dense_positions(pairs.select("order_key"), ["order_key"], "row_id").join(
        firsts.select("order_key", F.lit(0).alias("__copy")), "order_key", "left"
    )
    index = marked.select(
        "order_key",
        (F.col("row_id") + rows_before).alias("row_id"),
        F.coalesce("__copy", F.lit(1)).alias("is_exact_duplicate"),
    )
    numbered = cleaned.repartition("order_key").join(index, "order_key")
    rows = row_flags(engineer(numbered, cfg), cfg)
    # Digests first: a batch exists once its rows do.
    firsts.select("pair").write.mode("overwrite").parquet(f"{root}/pairs/batch={batch}")
    rows.write.mode("overwrite").parquet(f"{root}/rows/batch={batch}")
    return spark.read.schema(rows.schema).parquet(f"{root}/rows/batch={batch}").drop("order_key")


def next_batch(spark: SparkSession, root: str) -> int:
    return max(_batches(spark, root, "rows"), default=-1) + 1


def append_stream(
    spark: SparkSession, folder: str, root: str, cfg: AuditConfig, files_per_batch: int | None = None
) -> StreamingQuery:
    """Add the files of ``folder`` that have not been read yet, micro-batch by micro-batch, and stop.

    Spark remembers under ``root`` what it has read.  Files must come in the
    order of their keys.
    """
    reader = spark.readStream.schema(RAW)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def add(rows: DataFrame, batch: int) -> None:
        append_batch(rows.sparkSession, root, batch, rows, cfg)

    return (
        reader.parquet(folder)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )
