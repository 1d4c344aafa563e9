"""Schemas of the raw corpus and of the fact table."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("order_key", T.LongType()),
        T.StructField("instruction", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
    ]
)

QUALITY_FLAGS = (
    "flag_truncated",
    "flag_too_short",
    "flag_empty_ish",
    "flag_repetitive",
    "flag_readability_outlier",
)

_DECIMAL = T.DecimalType(8, 2)

# Names and order of the columns of the fact table.
FACT = T.StructType(
    [
        T.StructField("row_id", T.LongType(), False),
        T.StructField("instruction", T.StringType()),
        T.StructField("input_text", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("has_input", T.IntegerType()),
        T.StructField("instruction_word_count", T.IntegerType()),
        T.StructField("output_word_count", T.IntegerType()),
        T.StructField("sentence_count", T.IntegerType()),
        T.StructField("words_per_sentence", _DECIMAL),
        T.StructField("prompt_type_rule", T.StringType()),
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("cluster_label", T.StringType()),
        T.StructField("flesch_score", _DECIMAL),
        T.StructField("readability_level", T.StringType()),
        T.StructField("is_code_like", T.IntegerType()),
        T.StructField("is_exact_duplicate", T.IntegerType()),
        T.StructField("is_near_duplicate", T.IntegerType()),
        T.StructField("duplicate_of", T.LongType()),
        T.StructField("flag_truncated", T.IntegerType()),
        T.StructField("flag_too_short", T.IntegerType()),
        T.StructField("flag_empty_ish", T.IntegerType()),
        T.StructField("flag_repetitive", T.IntegerType()),
        T.StructField("flag_readability_outlier", T.IntegerType()),
        T.StructField("n_flags", T.IntegerType()),
        T.StructField("adequacy_score", T.IntegerType()),
    ]
)

FACT_COLUMNS = tuple(FACT.names)
