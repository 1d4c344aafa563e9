"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every source is a queue of its documents in shuffled order, repeated in
passes.  A document finishes at the virtual time (words of its source up to
and with it) / (target of the source).  Sources are served at rates
proportional to their targets, so the stream sorted by virtual finish time
keeps the mix at every point, and a budget of the sum of all targets is used
up at virtual time CUT, whatever the number of documents.  Documents that
finish by then are taken whole, those that start later not at all, and what is
in service is cut: at most one document per source is taken in part.

Running sums are taken without sorting a source in one task: rows fall into
buckets of shuffle order, about sqrt(rows) rows each, a bucket is summed as a
whole first, and only inside a bucket are rows sorted.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chaffsieve.llm.tables import WORD, meet, whole_text
from chaffsieve.sources.staging import stage

WEIGHTS = (5, 2, 1)
CAP = 3
# Virtual time at which the sum of all targets is used up.
CUT = 1.0
# Bits of the shuffle key: the first 15 hexadecimal digits of an MD5 digest.
KEY_BITS = 60


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def _queue(source: Column) -> Column:
    """A key that also tells a NULL source from every other."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def _shuffle_key(doc_id: Column, text: Column) -> Column:
    """Rows without an id, or that share one, are told apart by their texts."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(text.cast("binary")))
    digits = F.substring(F.md5(named.cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("bigint")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """(queue, source_size, source_rows, target) per source of ``sized`` (source, size).

    Sources in code point order, NULL last, take the weights in turn and share
    the sum of all sizes; no target exceeds ``cap`` times its source's size.
    With sources in order of cap * size / weight the capped ones come first:
    a source is capped if the level, what the sources before leave per unit of
    weight, reaches its cap, and the first that is not sets the common level.
    The windows see one row per source.
    """
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(
        F.array(*[F.lit(w).cast("bigint") for w in weights]),
        ((F.row_number().over(ranked) - 1) % len(weights) + 1).cast("int"),
    )
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows")
    )
    limit = F.col("source_size") * cap
    tightest = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(
        F.sum(limit).over(tightest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rest = F.sum("weight").over(tightest.rowsBetween(0, Window.unboundedFollowing))
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - before).cast("double") / rest.cast("double")
    leveled = totals.withColumn("weight", turn).withColumn("level", level)
    open_level = F.when(F.col("level") < limit / F.col("weight"), F.col("level"))
    return leveled.withColumn("common", F.max(open_level).over(every)).select(
        _queue(F.col("source")).alias("queue"),
        "source_size",
        "source_rows",
        F.when(F.col("common").isNull(), limit.cast("double"))
        .otherwise(F.least(limit.cast("double"), F.col("common") * F.col("weight")))
        .alias("target"),
    )


def virtual_time(words: Column, n: int | Column) -> Column:
    """When ``words`` of pass ``n`` of a source have been served; NULL for a source without words."""
    return F.try_divide((F.col("source_size") * n + words).cast("double"), F.col("target"))


def served(n: int) -> Column:
    """Words of a document that pass ``n`` has served when the budget is used up."""
    start = virtual_time(F.col("before"), n)
    finish = virtual_time(F.col("before") + F.col("size"), n)
    # In service at the cut: what the source's whole number of words leaves for it.
    part = F.col("goal") - F.col("before") - F.col("source_size") * n
    none = F.lit(0).cast("bigint")
    return (
        F.when(finish <= CUT, F.col("size"))
        .when(start < CUT, F.greatest(none, F.least(F.col("size"), part)))
        .otherwise(none)
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """(row, size, source_size, target, before, taken) per row of ``docs``.

    ``row`` is the row itself as a struct, so its columns may have any names;
    the columns doc_id, source and text must be among them.  ``before`` counts
    the words of the source ahead of it in the first pass, ``taken`` the words
    the mix takes of it over all passes, never more than ``cap`` * size.  The
    order within a source depends on doc_id and text alone, so reruns agree.
    A NULL text has size 0; a NULL doc_id shuffles like an empty one; repeated
    rows count as documents of their own; an empty table gives no rows.
    """
    row = F.struct(*[F.col(c) for c in docs.columns])
    placed = docs.select(
        row.alias("row"),
        F.col("source"),
        _queue(F.col("source")).alias("queue"),
        _shuffle_key(F.col("doc_id"), whole_text()).alias("key"),
        word_count(whole_text()).alias("size"),
    )
    if set(docs.columns) == {"doc_id", "source", "text"}:
        # A narrow table: count the words once, the texts are not needed again.
        placed = stage(
            placed.withColumn("row", F.struct("row.doc_id", "row.source")), "mix-sizes"
        )
        narrow = placed
    else:
        narrow = stage(placed.select("source", "queue", "key", "size"), "mix-sizes")
    sources = source_targets(narrow, weights, cap)
    rows_per_bucket = max(16, isqrt(narrow.count()))
    sources = stage(
        sources.withColumn(
            "buckets", F.ceil(F.col("source_rows") / rows_per_bucket).cast("bigint")
        ).withColumn("goal", F.floor(F.col("target") + 0.5).cast("bigint")),
        "mix-sources",
    )
    half = KEY_BITS // 2
    bucket = F.shiftright(F.shiftright("key", half) * F.col("buckets"), half)
    sums = (
        meet(narrow, sources.select("queue", "buckets"), ["queue"])
        .groupBy("queue", bucket.alias("bucket"))
        .agg(F.sum("size").alias("words"))
    )
    earlier = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        sums.select(
            "queue", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
        ),
        "mix-offsets",
    )
    inside = (
        Window.partitionBy("queue", "bucket")
        .orderBy("key", F.col("row.doc_id"), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    queued = meet(placed.drop("source"), sources, ["queue"]).withColumn("bucket", bucket)
    queued = meet(queued, offsets, ["queue", "bucket"]).withColumn(
        "before", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    taken = served(0)
    for n in range(1, cap):
        taken = taken + served(n)
    return queued.select(
        "row", "size", "source_size", "target", "goal", "before", taken.alias("taken")
    )


def mixed_stream(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """The mix as rows of ``docs`` in stream order: repeated, cut and globally range-sorted.

    A document is there once per pass that takes it; a pass that takes only
    its first words cuts the text (and n_chars, if there is such a column).
    Documents without words are never part of a mix.
    """
    taken = mix(docs, weights, cap).filter("taken > 0")
    passes = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("taken") - 1) / F.col("size")))
    copies = taken.select("*", F.explode(passes).alias("pass")).select(
        "*",
        F.least(F.col("size"), F.col("taken") - F.col("pass") * F.col("size")).alias("words"),
        virtual_time(F.col("before") + F.col("size"), F.col("pass")).alias("finish"),
    )
    pieces = F.regexp_extract_all(F.col("row.text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    head = F.array_join(F.slice(pieces, 1, F.col("words").cast("int")), "")
    copies = copies.withColumn(
        "cut", F.when(F.col("words") < F.col("size"), head).otherwise(F.col("row.text"))
    )
    columns = []
    for c in docs.columns:
        column = F.col("row").getField(c)
        if c == "text":
            column = F.col("cut")
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            column = F.when(
                F.col("words") < F.col("size"), F.length("cut").cast(kind)
            ).otherwise(column)
        columns.append(column.alias(c))
    order = [F.col("finish"), F.col("row.doc_id"), F.col("pass")]
    return copies.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)
