"""Writing stage tables, the fact table, reports and views."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.functions.numeric import to_numeric
from chaffsieve.schema import FACT, FACT_COLUMNS
from chaffsieve.sources.staging import no_leftovers


def write_enriched(df: DataFrame, root: str, stage_name: str, key: str | None = None) -> DataFrame:
    """Save one stage in a folder of its own and return the saved table.

    Spark cannot overwrite a path it reads from, so stages do not share one.
    ``key`` says what the stage was made of; it is noted once the rows are
    there, so a stage that was cut short has none.
    """
    spark = df.sparkSession
    path = f"{root}/stage={stage_name}"
    _delete(spark, f"{root}/made={stage_name}")
    with no_leftovers(spark):
        df.write.mode("overwrite").parquet(path)
    if key is not None:
        spark.createDataFrame([(key,)], "key string").coalesce(1).write.mode("overwrite").json(f"{root}/made={stage_name}")
    return spark.read.schema(df.schema).parquet(path)


def made_of(spark: SparkSession, root: str, stage_name: str) -> str | None:
    """The ``key`` a finished stage was saved with."""
    path = f"{root}/made={stage_name}"
    if not (_exists(spark, path) and has_stage(spark, root, stage_name)):
        return None
    row = spark.read.schema("key string").json(path).first()
    return row["key"] if row else None


def fingerprint(df: DataFrame, *more: str) -> str:
    """A digest of the rows of ``df``, in any order and any partitions, and of some words on their use."""
    names = sorted(df.columns)
    h = F.xxhash64(*[F.col(c) for c in names])
    found = df.agg(
        F.count(F.lit(1)), F.bit_xor(h), F.sum(F.shiftrightunsigned(h, 1).cast("decimal(38,0)"))
    ).first()
    return md5(repr((names, tuple(found), more)).encode()).hexdigest()


def derived(key: str, *more: str) -> str:
    """The key of a stage made of the stage ``key``."""
    return md5(repr((key, more)).encode()).hexdigest()


def read_enriched(spark: SparkSession, root: str, stage_name: str, limit: int | None = None):
    """A saved stage, or its first ``limit`` rows: a filter the scan can use."""
    df = spark.read.parquet(f"{root}/stage={stage_name}")
    return df if limit is None else df.filter(F.col("row_id") <= limit)


def has_stage(spark: SparkSession, root: str, stage_name: str) -> bool:
    return _exists(spark, f"{root}/stage={stage_name}")


def _files(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _exists(spark: SparkSession, path: str) -> bool:
    system, found = _files(spark, path)
    return system.exists(found)


def _delete(spark: SparkSession, path: str) -> None:
    system, found = _files(spark, path)
    system.delete(found, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder with rows that Spark finished writing."""
    system, found = _files(spark, path)
    if not system.exists(found):
        return []
    names = [status.getPath().getName() for status in system.listStatus(found)]
    return [n for n in names if _exists(spark, f"{path}/{n}/_SUCCESS")]


def missing_columns(df: DataFrame) -> list[str]:
    """The fact columns ``df`` does not have, in their order."""
    return [c for c in FACT_COLUMNS if c not in df.columns]


def select_fact(df: DataFrame) -> DataFrame:
    """The fact columns in order and typed; names any that are missing."""
    missing = missing_columns(df)
    if missing:
        raise KeyError(f"missing columns {missing}; run clean, cluster and flag first")
    return coerce_fact(df)


def coerce_fact(df: DataFrame) -> DataFrame:
    """NaN and unparsable numbers -> NULL; a score that does not fit its type -> NULL."""

    def typed(field):
        value = F.col(field.name)
        if field.name in ("flesch_score", "words_per_sentence"):
            value = to_numeric(value).try_cast(field.dataType)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[typed(f) for f in FACT.fields])


def create_fact_table(spark: SparkSession, table: str) -> None:
    """An empty table with the fixed schema; an existing one is left alone."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FACT.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")


def load_fact_table(fact: DataFrame, table: str, truncate: bool = True) -> int:
    """Load into a table of the session's catalog, never changing its schema."""
    spark = fact.sparkSession
    rows = select_fact(fact)
    create_fact_table(spark, table)
    # Rows go in by position, so another table's columns would be filled with the wrong ones.
    have, want = ([(f.name, f.dataType) for f in t.fields] for t in (spark.table(table).schema, FACT))
    if have != want:
        odd = [f"{n} {k.simpleString()}" for n, k in have if (n, k) not in want]
        raise ValueError(f"{table} is not a fact table; unexpected or misplaced columns: {odd}")
    before = 0 if truncate else spark.table(table).count()
    # Sorted files let a reader skip by row_id, cluster and score.
    rows.sortWithinPartitions("cluster_id", "adequacy_score").write.insertInto(
        table, overwrite=truncate
    )
    return verify_load(spark.table(table), before + rows.count())


def load_fact_by_cluster(fact: DataFrame, table: str) -> int:
    """Load into a table laid out by cluster, replacing the clusters that ``fact`` has and no others.

    A cluster is a partition, and inside it files are ranges of row_id, so a
    reader opens the clusters and ranges it asks for.  Returns the rows of the
    replaced clusters.
    """
    spark = fact.sparkSession
    rows = select_fact(fact)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FACT.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY (cluster_id)")
    # Partition columns come last in a table, and rows go in by position.
    ordered = rows.select(*spark.table(table).columns)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        ordered.repartitionByRange("cluster_id", "row_id").sortWithinPartitions("cluster_id", "row_id").write.insertInto(
            table, overwrite=True
        )
    finally:
        spark.conf.set(mode, before)
    # One row per cluster on either side.
    want = rows.groupBy("cluster_id").agg(F.count("*").alias("want"))
    have = spark.table(table).groupBy(F.col("cluster_id").alias("c")).agg(F.count("*").alias("have"))
    odd = want.join(have, F.col("cluster_id").eqNullSafe(F.col("c")), "left").agg(
        F.sum("want").alias("rows"), F.count_if(~F.col("want").eqNullSafe(F.col("have"))).alias("wrong")
    ).first()
    if odd["wrong"]:
        raise RuntimeError(f"{odd['wrong']} clusters of {table} do not have the rows that were loaded")
    return odd["rows"] or 0


def load_fact_jdbc(
    fact: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    cfg: AuditConfig,
    truncate: bool = True,
) -> int:
    """Load into an existing table of a database, in batches over a few connections.

    The database counts its rows itself.  A missing table is an error, and so
    is truncating where Spark would drop the table and make a new one.
    """
    spark = fact.sparkSession
    rows = select_fact(fact)
    if truncate and not _truncates(spark, url):
        raise ValueError(f"Spark replaces tables of {url.split(':')[1]} instead of truncating them")

    def counted() -> int:
        query = f"(SELECT COUNT(*) AS n FROM {table}) counted"
        return int(spark.read.jdbc(url, query, properties=properties).first()[0])

    there = counted()  # fails here if there is no such table
    (
        rows.write.mode("overwrite" if truncate else "append")
        .option("truncate", True)
        .option("batchsize", cfg.load_batch)
        .option("numPartitions", cfg.load_connections)
        .jdbc(url, table, properties=properties)
    )
    return check_count(counted(), rows.count() + (0 if truncate else there))


def _truncates(spark: SparkSession, url: str) -> bool:
    """Whether Spark's dialect truncates a table in place: known not to cascade."""
    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    cascades = dialect.isCascadingTruncateTable()
    return cascades.isDefined() and not cascades.get()


def verify_load(loaded: DataFrame, expected: int) -> int:
    return check_count(loaded.count(), expected)


def check_count(found: int, expected: int) -> int:
    if found != expected:
        raise RuntimeError(f"loaded table has {found} rows, expected {expected}")
    return found


def _csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option(
        "escape", '"'
    ).csv(path)


def write_sample_csv(df: DataFrame, path: str, cfg: AuditConfig) -> None:
    """The first rows by row_id: dense ids make that a filter, run by all tasks."""
    head = df.filter(F.col("row_id") <= cfg.sample_csv_rows)
    _csv(head.repartition(1).sortWithinPartitions("row_id"), path)


def write_review_csv(review: DataFrame, path: str) -> None:
    """At most ``review_rows`` rows."""
    _csv(review.coalesce(1), path)


def write_json(record: DataFrame, path: str) -> None:
    """A one-row record such as the audit report or the cluster selection."""
    record.coalesce(1).write.mode("overwrite").json(path)


def export_views(
    fact: DataFrame,
    views: dict[str, Callable[[DataFrame, AuditConfig], DataFrame]],
    root: str,
    cfg: AuditConfig,
) -> dict[str, str]:
    """Each view to ``root/<name>`` as CSV; a failing one does not stop the rest."""
    status = {}
    for name, view in views.items():
        try:
            _csv(view(fact, cfg), f"{root}/{name}")
            status[name] = "ok"
        except Exception as error:
            status[name] = f"failed: {error}"
    return status
