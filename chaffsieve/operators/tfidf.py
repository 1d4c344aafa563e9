"""TF-IDF vectors of cleaned instructions, one vocabulary per group."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, StringType, StructField, StructType

from chaffsieve.config import AuditConfig
from chaffsieve.functions.text import let
from chaffsieve.operators.lookup import keyed_lookup, top_k_per_group
from chaffsieve.operators.order import value_ladder
from chaffsieve.sources.staging import settle, small_batches, stage, stored_bytes

_CELLS = ArrayType(StructType([StructField("term", StringType()), StructField("tf", IntegerType())]))


def term_list(text: Column, stop_words: tuple[str, ...]) -> Column:
    """Words of two letters or more without stop words, then their bigrams."""

    def with_bigrams(words: Column) -> Column:
        following = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1)))
        pairs = F.zip_with(words, following, lambda a, b: F.concat(a, F.lit(" "), b))
        return F.array_compact(F.concat(words, pairs))

    kept = F.filter(
        F.split(text, " "), lambda w: (F.length(w) > 1) & ~w.isin(*stop_words)
    )
    return let(kept, with_bigrams)


def term_counts(terms: Column) -> Column:
    """Array of (term, tf): run lengths of the sorted terms, inside the row."""

    def runs(t: Column) -> Column:
        positions = F.sequence(F.lit(0), F.size(t) - 1)
        starts = F.filter(
            positions, lambda i: (i == 0) | (F.get(t, i) != F.get(t, i - 1))
        )

        def lengths(s: Column) -> Column:
            return F.transform(
                s,
                lambda p, k: F.struct(
                    F.get(t, p).alias("term"),
                    (F.coalesce(F.get(s, k + 1), F.size(t)) - p).alias("tf"),
                ),
            )

        return F.when(F.size(t) > 0, let(starts, lengths))

    return let(F.sort_array(terms), runs)


# Terms are counted in so many parts, one after the other, where texts take more than so many
# bytes as stored: what is shuffled to count them takes more room than the texts.
_PARTS, _LARGE = 2, 64 << 20


def _terms(text: str, stop_words: frozenset[str], part: int, parts: int) -> Counter:
    words = [w for w in text.split(" ") if len(w) > 1 and w not in stop_words]
    if parts == 1:
        mine = [True] * len(words)
    else:
        # By the first word, so that each term is in one part.
        mine = [(ord(w[0]) + ord(w[-1])) % parts == part for w in words]
    counts = Counter(compress(words, mine))
    counts.update(map(" ".join, compress(zip(words, words[1:]), mine)))
    return counts


def counted_terms(text: Column, stop_words: tuple[str, ...], part: int = 0, parts: int = 1) -> Column:
    """What ``term_counts`` gives of ``term_list``, or one part of it, counted over Arrow batches.

    A lambda per term costs some times as much, but Spark takes rows for
    scattered that have been to Python.
    """
    stop = frozenset(stop_words)

    def count(texts: pa.Array) -> pa.Array:
        ends, terms, tfs = [0], [], []
        for text in texts.to_pylist():
            if text is not None:
                counts = _terms(text, stop, part, parts)
                terms += counts
                tfs += counts.values()
            ends.append(len(terms))
        cells = pa.StructArray.from_arrays([pa.array(terms, pa.string()), pa.array(tfs, pa.int32())], ["term", "tf"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cells)

    return F.arrow_udf(count, _CELLS)(text)


def explode_terms(df: DataFrame, group: str, cfg: AuditConfig) -> DataFrame:
    """(group_key, row_id, term, tf); rows without terms vanish here."""
    terms = term_counts(term_list(F.col("instruction_clean"), cfg.stop_words))
    return df.select(F.col(group).alias("group_key"), "row_id", F.inline(terms))


def _most_frequent(counted: DataFrame, k: int, cfg: AuditConfig) -> DataFrame:
    """The ``k`` terms of each group with the highest total_tf, ties by term; ``counted`` is staged.

    How often each total occurs settles at which total a group is cut, so
    terms are dropped where they lie; only those at the cut are ranked.
    """
    negative = counted.withColumn("__down", -F.col("total_tf"))
    ladder = value_ladder(negative, ["group_key"], ["__down"])
    cut = ladder.filter((F.col("n_before") < k) & (F.col("n_before") + F.col("n") >= k)).select(
        "group_key",
        (-F.col("__down")).alias("cut"),
        (k - F.col("n_before")).alias("room"),
        F.col("n_total").alias("copies"),
    )
    # One row per group, of which there may be many.
    marked = keyed_lookup(counted, stage(cut, "cuts"), ["group_key"], "copies", cfg, "left")
    above = marked.filter(F.col("cut").isNull() | (F.col("total_tf") > F.col("cut")))
    tied = top_k_per_group(
        marked.filter(F.col("total_tf") == F.col("cut")), ["group_key"], [F.asc("term")], "term", k, cfg
    ).filter(F.col("position") <= F.col("room"))
    return above.select(*counted.columns).unionByName(tied.select(*counted.columns))


def _proportions(cells: str):
    """Term counts over their greatest common divisor: equal for parallel vectors."""
    counts = F.col(f"{cells}.tf")
    least = F.array_min(counts).cast("int")
    divisors = F.filter(
        F.sequence(least, F.lit(1), F.lit(-1)), lambda d: F.forall(counts, lambda c: c % d == 0)
    )
    return let(
        F.get(divisors, 0),
        lambda d: F.transform(
            cells, lambda c: F.concat_ws(":", c["term_rank"], (c["tf"] / d).cast("bigint"))
        ),
    )


def _counted(df: DataFrame, group: str, cfg: AuditConfig) -> DataFrame:
    """(group_key, term, df, total_tf) of the terms in ``min_df`` rows or more, staged."""
    small_batches(df.sparkSession)
    parts = _PARTS if stored_bytes(df) > _LARGE else 1
    found = []
    for part in range(parts):
        terms = counted_terms(F.col("instruction_clean"), cfg.stop_words, part, parts)
        listed = df.select(F.col(group).alias("group_key"), terms.alias("terms"))
        counted = (
            listed.select("group_key", F.inline("terms"))
            .groupBy("group_key", "term")
            .agg(F.count("*").alias("df"), F.sum("tf").alias("total_tf"))
            .filter(F.col("df") >= cfg.min_df)
        )
        found.append(stage(counted, "term-counts"))
    return reduce(DataFrame.unionByName, found)


def vocabulary(df: DataFrame, group: str, cfg: AuditConfig) -> DataFrame:
    """(group_key, term, term_rank, df, idf, n_rows) of the rows that have a group, staged.

    Terms in ``min_df`` rows or more, the ``max_features`` most frequent ones
    per group (all if that is None), ranked rarest first.  idf = ln((1 + n) /
    (1 + df)) + 1 over all rows of the group, with or without terms.
    """
    df = df.filter(F.col(group).isNotNull())

    def build() -> DataFrame:
        sizes = df.groupBy(F.col(group).alias("group_key")).agg(F.count("*").alias("n_rows"))
        counted = _counted(df, group, cfg)
        top = counted if cfg.max_features is None else _most_frequent(counted, cfg.max_features, cfg)
        rarest_first = Window.partitionBy("group_key").orderBy("df", "term")
        ranked = top.select(
            "group_key", "term", "df", F.row_number().over(rarest_first).alias("term_rank")
        )
        idf = F.log((1 + F.col("n_rows")) / (1 + F.col("df"))) + 1.0
        return ranked.join(sizes, "group_key").select(
            "group_key", "term", "term_rank", "df", idf.alias("idf"), "n_rows"
        )

    return settle(df.sparkSession, "vocabulary", build)


def weighted_terms(df: DataFrame, group: str, cfg: AuditConfig, words: DataFrame | None = None) -> DataFrame:
    """(group_key, row_id, term, term_rank, df, n_rows, tf, weight, norm, mass_before).

    Weights are tf * idf over ``norm``, the length of the row.  ``mass_before``
    is the squared weight of the row's rarer terms.
    """
    words = vocabulary(df, group, cfg) if words is None else words
    df = df.filter(F.col(group).isNotNull())
    # Spread by row first: the windows below and the regrouping into vectors
    # then need no further shuffle when the vocabulary is broadcast.  Texts
    # travel, not their terms, which take some times the bytes; the number of
    # partitions is given, since it is the terms that they have to suit.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = df.select(group, "row_id", "instruction_clean").repartition(parts, "row_id")
    found = keyed_lookup(
        explode_terms(texts, group, cfg), words.withColumn("copies", F.col("df")), ["group_key", "term"], "copies", cfg
    )
    raw = F.col("tf") * F.col("idf")
    row = Window.partitionBy("row_id").orderBy("term_rank")
    total = F.sum("sq").over(row.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = F.sum("sq").over(row.rowsBetween(Window.unboundedPreceding, -1))
    return (
        found.withColumns({"raw": raw, "sq": raw * raw})
        .withColumns({"total": total, "before": F.coalesce(before, F.lit(0.0))})
        .select(
            "group_key", "row_id", "term", "term_rank", "df", "n_rows", "tf",
            (F.col("raw") / F.sqrt("total")).alias("weight"),
            F.sqrt("total").alias("norm"),
            (F.col("before") / F.col("total")).alias("mass_before"),
        )
    )


def _vectors_in_place(df: DataFrame, group: str, words: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Vectors made where the texts lie, by a vocabulary that every task holds."""
    spark, schema = df.sparkSession, df.schema
    small_batches(spark)
    table: dict = {}
    for key, term, rank, idf in words.select("group_key", "term", "term_rank", "idf").collect():
        table.setdefault(key, []).append((rank, term, idf))
    for key, cells in table.items():
        cells.sort()
        table[key] = ({term: rank for rank, term, _ in cells}, np.array([idf for *_, idf in cells]))
    held, stop = spark.sparkContext.broadcast(table), frozenset(cfg.stop_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, keys, norms, ranks, counts, ends = [], [], [], [], [], [0]
            for i, (key, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                rank_of, idfs = held.value.get(key, ({}, None))
                found = [] if text is None else _terms(text, stop, 0, 1).items()
                cells = sorted((rank_of[term], n) for term, n in found if term in rank_of)
                if not cells:
                    continue
                rank, n = np.array(cells, "<i4").T
                raw = n * idfs[rank - 1]
                kept.append(i)
                # One by one from the rarest term on, as Spark adds them up.
                norms.append(np.sqrt(np.cumsum(raw * raw)[-1]))
                keys.append(sha256(rank.tobytes() + (n // np.gcd.reduce(n)).tobytes()).digest())
                ranks.append(rank)
                counts.append(n)
                ends.append(ends[-1] + len(rank))
            if kept:
                at = pa.array(kept)
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x))) for x in (ranks, counts)]
                columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(keys, pa.binary()), pa.array(norms)]
                yield pa.RecordBatch.from_arrays([*columns, *lists], names=_VECTOR)

    kinds = [schema[group].dataType, schema["row_id"].dataType, BinaryType(), DoubleType(), *[ArrayType(IntegerType())] * 2]
    made = StructType([StructField(c, kind) for c, kind in zip(_VECTOR, kinds)])
    return df.select(F.col(group).alias("group_key"), "row_id", "instruction_clean").mapInArrow(run, made)


_VECTOR = ["group_key", "row_id", "vector_key", "norm", "ranks", "counts"]


def _vectors_by_join(df: DataFrame, group: str, words: DataFrame, cfg: AuditConfig) -> DataFrame:
    """The same for a vocabulary too large for a task."""
    cell = F.struct("term_rank", F.col("tf").cast("int").alias("tf"))
    packed = (
        weighted_terms(df, group, cfg, words)
        .groupBy("row_id")
        .agg(
            F.first("group_key").alias("group_key"),
            F.first("norm").alias("norm"),
            F.sort_array(F.collect_list(cell)).alias("cells"),
        )
    )
    spelled = F.array_join(_proportions("cells"), " ")
    return packed.select(
        "group_key",
        "row_id",
        F.unhex(F.sha2(spelled, 256)).alias("vector_key"),
        "norm",
        F.col("cells.term_rank").alias("ranks"),
        F.col("cells.tf").alias("counts"),
    )


def vectors(df: DataFrame, group: str, cfg: AuditConfig) -> tuple[DataFrame, DataFrame]:
    """(one staged row per non-empty vector, the vocabulary): ranks ascending, rarest term first.

    A weight is tf * idf / norm; what is staged are the counts, which take a
    few bits each, and the row's norm.  ``vector_key`` is a digest of the terms
    and their relative counts: rows of a group have equal keys just if their
    unit vectors are equal.
    """
    words = vocabulary(df, group, cfg)
    df = df.filter(F.col(group).isNotNull())
    fits = words.count() <= cfg.broadcast_rows and stored_bytes(words) <= cfg.broadcast_bytes
    make = _vectors_in_place if fits else _vectors_by_join
    return stage(make(df, group, words, cfg), "vectors"), words
