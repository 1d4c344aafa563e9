"""Stage 1: clean rows, number them, mark exact copies, attach features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.functions import text as fx
from chaffsieve.operators.order import dense_positions
from chaffsieve.sources.staging import small_batches, stage

_TEXT_COLUMNS = ("instruction", "input_text", "output")


def clean(raw: DataFrame) -> DataFrame:
    """Drop ``text``, rename ``input``, strip all texts, keep non-empty pairs."""
    df = raw.drop("text").withColumnRenamed("input", "input_text")
    df = df.withColumns({c: fx.clean_text(F.col(c)) for c in _TEXT_COLUMNS})
    return df.filter((F.col("instruction") != "") & (F.col("output") != ""))


def cleaning_counts(raw: DataFrame) -> DataFrame:
    """Rows read, kept and dropped as empty."""
    kept = (fx.clean_text(F.col("instruction")) != "") & (fx.clean_text(F.col("output")) != "")
    return raw.agg(
        F.count("*").alias("rows_read"),
        F.count_if(kept).alias("rows_kept"),
        F.count_if(~kept).alias("rows_dropped"),
    )


def counted(raw: DataFrame) -> tuple[DataFrame, Observation]:
    """``raw``, and what ``cleaning_counts`` says of it once an action has read it: no scan of its own.

    The counts are those of the first action that reads the frame to its end.
    """
    seen = Observation()
    kept = (fx.clean_text(F.col("instruction")) != "") & (fx.clean_text(F.col("output")) != "")
    return (
        raw.observe(
            seen,
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if(kept).alias("rows_kept"),
            F.count_if(~kept).alias("rows_dropped"),
        ),
        seen,
    )


def check_keys(df: DataFrame, key: str) -> None:
    """Refuse NULL and repeated keys: a join on them would lose or multiply rows."""
    seen = df.agg(
        F.count("*").alias("rows"), F.count(key).alias("set"), F.count_distinct(key).alias("distinct")
    ).first()
    empty, repeated = seen["rows"] - seen["set"], seen["set"] - seen["distinct"]
    if empty or repeated:
        raise ValueError(f"{key} must be unique: {empty} rows without one, {repeated} rows repeat one")


def pair_digest() -> Column:
    """What equal pairs of instruction and input share, and different ones do not."""
    whole = F.concat_ws(":", F.length("instruction").cast("string"), F.col("instruction"), F.col("input_text"))
    return F.unhex(F.sha2(whole, 256))


def index_rows(cleaned: DataFrame) -> DataFrame:
    """(order_key, row_id, is_exact_duplicate) for every cleaned row.

    Works on keys and a digest of (instruction, input_text), never on the
    texts.  The first copy of each pair is found by an aggregation that
    combines before it shuffles, and copies are the rows that are not the
    first of their pair: a join on a unique key, whatever a pair's share.
    """
    # Staged narrow, so that the texts are read once and the range sampling
    # below looks at keys only.
    pairs = stage(cleaned.select("order_key", pair_digest().alias("pair")), "pairs")
    check_keys(pairs, "order_key")
    firsts = (
        pairs.groupBy("pair")
        .agg(F.min("order_key").alias("order_key"))
        .select("order_key", F.lit(0).alias("__copy"))
    )
    rows = dense_positions(pairs.select("order_key"), ["order_key"], "row_id")
    return rows.join(firsts, "order_key", "left").select(
        "order_key", "row_id", F.coalesce("__copy", F.lit(1)).alias("is_exact_duplicate")
    )


def number_rows(cleaned: DataFrame) -> DataFrame:
    """Cleaned rows with dense ``row_id`` and ``is_exact_duplicate``.

    The repartitioning is the shuffle the join needs anyway; asking for it by
    name keeps the text work after the join spread out even where the input
    is a few large files and the index is small enough to broadcast.
    """
    return (
        cleaned.repartition("order_key")
        .join(index_rows(cleaned), "order_key")
        .drop("order_key")
    )


def engineer(df: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Attach structural, readability and rule-class features."""
    small_batches(df.sparkSession)
    instruction, output = F.col("instruction"), F.col("output")
    df = df.withColumns(
        {
            "instruction_clean": fx.normalise(instruction),
            "has_input": fx.has_input(F.col("input_text")),
            "instruction_word_count": fx.word_count(instruction),
            "output_word_count": fx.word_count(output),
            "sentence_count": fx.sentence_count(output),
            "is_code_like": fx.looks_like_code(
                output, cfg.code_markers, cfg.code_marker_min_hits
            ),
            "prompt_type_rule": fx.categorize_prompt(instruction),
        }
    )
    words, sentences = F.col("output_word_count"), F.col("sentence_count")
    df = df.withColumns(
        {
            "words_per_sentence": fx.words_per_sentence(words, sentences),
            "flesch_score": F.when(
                F.col("is_code_like") == 0, fx.flesch(output, words, sentences)
            ),
        }
    )
    return df.withColumn("readability_level", fx.readability_level(F.col("flesch_score")))


def enrich(raw: DataFrame, cfg: AuditConfig) -> DataFrame:
    return engineer(number_rows(clean(raw)), cfg)
