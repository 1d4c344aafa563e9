"""Reading a raw corpus and shaping other tables into one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chaffsieve.operators.order import nth_row
from chaffsieve.schema import RAW

# Leading phrase given to a document's first line, by its length
# modulo 8, so that every task class occurs.
PREFIX_VERBS = (
    "What about", "Write", "Explain", "Solve", "Suggest", "List", "Rewrite", "Regarding",
)
# Cluster of a document by its language.
LANGUAGE_CLUSTERS = {"de": 0, "en": 1, "es": 2, "fr": 3}
CONVERSATION_CLUSTER = 4
PAGE_CLUSTER = 5
CLUSTER_NAMES = {
    0: "german", 1: "english", 2: "spanish", 3: "french", 4: "conversation", 5: "page",
}
# Turns a conversation can have before its keys would meet those of the next.
TURN_SPAN = 1 << 32


def load_corpus(
    spark: SparkSession, path: str, order_key: str = "order_key", limit: int | None = None
) -> DataFrame:
    """A parquet corpus at any path Spark can read.

    ``order_key`` names a unique column that stands for file order, which
    Spark does not define; it keeps its type, whatever can be ordered will do.
    Columns missing from the files read as NULL.
    """
    present = set(spark.read.parquet(path).columns)
    if order_key not in present:
        raise KeyError(f"corpus has no order column {order_key!r}; columns: {sorted(present)}")
    texts = [f for f in RAW.fields if f.name != "order_key"]
    raw = spark.read.parquet(path).select(
        F.col(order_key).alias("order_key"),
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in texts
        ],
    )
    return raw if limit is None else limit_rows(raw, limit)


def limit_rows(df: DataFrame, n: int, order_key: str = "order_key") -> DataFrame:
    """The first ``n`` rows in key order.

    Only keys are sorted, range by range; the rows themselves are filtered
    where they lie by the n-th key, which is a single value.  NULL keys are
    no rows of an order and are left out.
    """
    if n <= 0:
        return df.limit(0)
    keyed = df.filter(F.col(order_key).isNotNull())
    last = nth_row(keyed, [order_key], n)
    return keyed if last is None else keyed.filter(F.col(order_key) <= F.lit(last[order_key]))


def _table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def _first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def corpus_from_documents(
    spark: SparkSession, base: str, prefixed: bool = False, whole: bool = False
) -> DataFrame:
    """First line, or the whole text -> instruction, whole text -> output."""
    line = F.col("text") if whole else _first_line(F.col("text"))
    if prefixed:
        verbs = F.array(*[F.lit(v) for v in PREFIX_VERBS])
        pick = (F.length(line) % len(PREFIX_VERBS)) + 1
        line = F.concat(F.element_at(verbs, pick), F.lit(" "), line)
    cluster = F.coalesce(
        *[F.when(F.col("lang") == k, F.lit(v)) for k, v in LANGUAGE_CLUSTERS.items()]
    )
    return _table(spark, base, "documents").select(
        F.col("doc_id").alias("order_key"),
        line.alias("instruction"),
        F.lit("").alias("input"),
        F.col("text").alias("output"),
        cluster.alias("cluster_id"),
    )


def _turn_key() -> Column:
    """One number per (conversation, turn), in their order."""
    turn = F.col("turn")
    fits = turn.between(0, TURN_SPAN - 1)
    wrong = F.raise_error(F.concat(F.lit("turn out of range: "), turn.cast("string")))
    return F.when(fits, F.col("conv_id") * TURN_SPAN + turn).otherwise(wrong.cast("bigint"))


def corpus_from_conversations(spark: SparkSession, base: str) -> DataFrame:
    """User turn -> instruction, the assistant turn after it -> output, system -> input."""
    turns = _table(spark, base, "conversations")
    ask = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("instruction"))
    reply = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    system = (
        turns.filter("role = 'system'")
        .groupBy("conv_id")
        .agg(F.min_by("text", "turn").alias("input"))
    )
    return (
        ask.join(reply, ["conv_id", "turn"])
        .join(system, "conv_id", "left")
        .select(
            _turn_key().alias("order_key"),
            "instruction",
            F.coalesce("input", F.lit("")).alias("input"),
            "output",
            F.lit(CONVERSATION_CLUSTER).alias("cluster_id"),
        )
    )


def corpus_from_pages(spark: SparkSession, base: str) -> DataFrame:
    """URL -> instruction, raw HTML -> output."""
    return _table(spark, base, "pages").select(
        F.col("page_id").alias("order_key"),
        F.col("url").alias("instruction"),
        F.lit("").alias("input"),
        F.col("html").alias("output"),
        F.lit(PAGE_CLUSTER).alias("cluster_id"),
    )


def corpus_mixed(spark: SparkSession, base: str) -> DataFrame:
    """Documents, conversations and pages as one corpus; keys interleave."""
    parts = [
        corpus_from_documents(spark, base, prefixed=True),
        corpus_from_conversations(spark, base),
        corpus_from_pages(spark, base),
    ]
    keyed = [
        p.withColumn("order_key", F.col("order_key") * len(parts) + i)
        for i, p in enumerate(parts)
    ]
    out = keyed[0]
    for p in keyed[1:]:
        out = out.unionByName(p)
    return out
