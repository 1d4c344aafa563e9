"""Intermediate tables in the folder the cluster shares.

A staged table cuts lineage without pinning anything to an executor: it is a
plain parquet table under ``spark.checkpoint.dir``, so a lost executor costs
a task retry.  Its row count comes from the file footers, which is what the
broadcast checks rely on.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_LOCAL = "chaffsieve.scratch"

# Spark drops the shuffle files of a query when it ends; otherwise they stay until
# the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Rows and bytes of an Arrow batch, whichever is reached first.
BATCH_ROWS = 256
BATCH_BYTES = "32m"

# Paths of staged tables, in the order they were written.
_written: list[str] = []

# Staged tables that several callers share, by application and key.
_shared: dict[tuple, DataFrame] = {}


def _context_folder(spark: SparkSession) -> str | None:
    """The folder given to SparkContext.setCheckpointDir, if any."""
    folder = spark._jsc.sc().getCheckpointDir()
    return folder.get() if folder.isDefined() else None


def scratch_root(spark: SparkSession) -> str:
    """Where this application stages: below the cluster's checkpoint folder.

    Only a local master may go without one; it gets a temporary folder, once.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _context_folder(spark)
    base = base or spark.conf.get(_LOCAL, None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="chaffsieve-")
        spark.conf.set(_LOCAL, base)
    return f"{base.rstrip('/')}/chaffsieve/{spark.conf.get('spark.app.id', 'session')}"


@contextmanager
def no_leftovers(spark: SparkSession) -> Iterator[None]:
    """Shuffles of the writes inside are gone when these end: for work that is done once."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, label: str, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once and read it back as a table.

    Readers hold a row group of long values at a time; ``group_bytes`` bounds it.
    Such values are packed numbers, which do not compress and are read often.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if group_bytes is not None:
        # Sizes are looked at every hundred rows otherwise.
        sizes = {"parquet.block.size": group_bytes, "parquet.page.size.row.check.min": 1}
        writer = writer.options(compression="none", **sizes)
    with no_leftovers(spark):
        writer.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Stage what ``build`` gives; what it staged on its way goes."""
    with passing(spark):
        kept = stage(build(), label)
        path = _written.pop()
    _written.append(path)
    return kept


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what crosses to Python at once: rows can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def delete(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is staged inside goes at the end: for work whose result is saved by then."""
    before = len(_written)
    try:
        yield
    finally:
        for path in _written[before:]:
            delete(spark, path)
        del _written[before:]


def stored_bytes(df: DataFrame) -> int:
    """What the planner takes for the size of ``df``: of a staged table, its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shared(spark: SparkSession, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` makes, once per application until it is released."""
    key = (spark.conf.get("spark.app.id", ""), *key)
    if key not in _shared:
        _shared[key] = build()
    return _shared[key]


def release(spark: SparkSession) -> None:
    """Delete what this application staged; call it when its results are saved.

    Shared tables are forgotten, and the temporary folder of a local master
    goes as a whole.
    """
    app = spark.conf.get("spark.app.id", "")
    for key in [k for k in _shared if k[0] == app]:
        del _shared[key]
    delete(spark, scratch_root(spark))
    _written.clear()
    made = spark.conf.get(_LOCAL, None)
    if made:
        shutil.rmtree(made, ignore_errors=True)
        spark.conf.unset(_LOCAL)
