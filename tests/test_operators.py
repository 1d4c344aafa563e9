"""Numbering, ranking, tiling and lookups against Spark's plain forms."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chaffsieve import AuditConfig
from chaffsieve.functions.numeric import percent, ratio, to_numeric
from chaffsieve.operators.clean import clean, cleaning_counts, enrich, number_rows
from chaffsieve.operators.lookup import keyed_lookup, top_k_per_group
from chaffsieve.operators.order import assign_ntile, dense_positions, value_ladder
from chaffsieve.sources.staging import stage

CFG = AuditConfig()
TINY = replace(CFG, broadcast_rows=3, hot_rows=10)


def test_dense_positions_do_not_depend_on_partitioning(spark):
    keys = random.Random(1).sample(range(-(10**12), 10**12), 3000)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    want = {k: i + 1 for i, k in enumerate(sorted(keys))}
    for parts in (1, 3, 11):
        got = dense_positions(df.repartition(parts), ["k"], "pos").collect()
        assert {r["k"]: r["pos"] for r in got} == want


def test_cleaning_and_exact_duplicates(spark, raw):
    df = raw(
        [
            ("A", "x", "o1"), ("a", "x", "o2"), (" A ", "x ", "o3"), ("A", "", "o4"),
            (None, "x", "o5"), ("B", None, "  "), ("A", "x", "o6"), ("2:A", "x", "o7"),
        ]
    ).withColumn("text", F.lit("t"))
    rows = number_rows(clean(df)).orderBy("row_id").collect()
    assert [r["row_id"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r["is_exact_duplicate"] for r in rows] == [0, 0, 1, 0, 1, 0]
    assert "text" not in rows[0].asDict() and rows[0]["input_text"] == "x"
    assert cleaning_counts(df.withColumnRenamed("text", "t")).first().asDict() == {
        "rows_read": 8, "rows_kept": 6, "rows_dropped": 2,
    }


def test_one_pair_may_hold_most_rows(spark, raw):
    df = raw([("same", "", f"o{i}") for i in range(400)] + [("other", "", "o")])
    assert number_rows(clean(df)).agg(F.sum("is_exact_duplicate")).first()[0] == 399


def test_enrich_features(spark, raw):
    rows = enrich(raw([("Write it", "", "One two three. Four!"), ("Why", "i", "{ x; }")]), CFG)
    prose, code = rows.orderBy("row_id").collect()
    assert (prose["output_word_count"], prose["sentence_count"]) == (4, 2)
    assert prose["words_per_sentence"] == 2.0
    assert prose["flesch_score"] == pytest.approx(206.835 - 1.015 * 2 - 84.6 * 4 / 4, abs=0.006)
    assert (code["is_code_like"], code["flesch_score"]) == (1, None)
    assert code["readability_level"] == "not scored" and code["has_input"] == 1


@pytest.mark.parametrize("rows", [1, 3, 4, 10, 1000])
def test_ntile_matches_the_window(spark, rows):
    rng = random.Random(rows)
    values = [(i, rng.choice([1, 1, 1, 2, 3, 50])) for i in range(rows)]
    df = spark.createDataFrame(values, "row_id bigint, v int")
    want = df.select("row_id", F.ntile(4).over(Window.orderBy("v", "row_id")).alias("q")).collect()
    got = assign_ntile(df, "v", "row_id", 4, "q").select("row_id", "q").collect()
    assert {r["row_id"]: r["q"] for r in got} == {r["row_id"]: r["q"] for r in want}


def test_ladder_gives_rank_and_percent_rank(spark):
    rng = random.Random(5)
    df = spark.createDataFrame(
        [(i, rng.choice("ab") if i else None, rng.randrange(9)) for i in range(300)],
        "row_id int, g string, v int",
    )
    w = Window.partitionBy("g").orderBy("v")
    want = df.select("g", "v", F.rank().over(w).alias("r"), F.percent_rank().over(w).alias("p"))
    ladder = value_ladder(df, ["g"], ["v"])
    rungs = ladder.select(
        "g", "v", (F.col("n_before") + 1).alias("r"),
        F.coalesce(F.try_divide(F.col("n_before"), F.col("n_total") - 1), F.lit(0.0)).alias("p"),
    )
    assert sorted(map(str, rungs.collect())) == sorted(map(str, want.distinct().collect()))


@pytest.mark.parametrize("cfg", [CFG, TINY])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_keyed_lookup_survives_hot_and_null_keys(spark, cfg, how):
    rng = random.Random(3)
    keys = [7] * 200 + [None] * 150 + [rng.randrange(20) for _ in range(200)]
    big = spark.createDataFrame(list(enumerate(keys)), "id int, k int")
    counts = big.filter("k is null or k < 15").groupBy("k").agg(F.count("*").alias("copies"))
    table = stage(counts.withColumn("name", F.concat(F.lit("n"), F.coalesce("k", F.lit(-1)))), "t")
    got = keyed_lookup(big, table, ["k"], "copies", cfg, how).select("id", "k", "name").collect()
    named = {i: f"n{-1 if k is None else k}" for i, k in enumerate(keys) if k is None or k < 15}
    if how == "left":
        named = {i: named.get(i) for i in range(len(keys))}
    assert {r["id"]: r["name"] for r in got} == named and len(got) == len(named)


def test_top_k_per_group(spark):
    df = spark.range(500).selectExpr("id", "id % 3 as g", "(id * 37) % 101 as v")
    got = top_k_per_group(df, ["g"], [F.desc("v"), "id"], "id", 20, CFG)
    w = Window.partitionBy("g").orderBy(F.desc("v"), "id")
    want = df.withColumn("position", F.row_number().over(w)).filter("position <= 20")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_exact_ratios(spark):
    cases = [(1, 3, 33.33), (1, 8, 12.5), (5, 1000, 0.5), (12345, 100000, 12.35), (0, 5, 0.0)]
    df = spark.createDataFrame(cases, "a bigint, b bigint, want double")
    for r in df.withColumn("got", percent(F.col("a"), F.col("b"), 2)).collect():
        assert r["got"] == r["want"]
    signed = spark.createDataFrame([(-25, 10), (25, 10), (-1, 100), (1, 0)], "a int, b int")
    got = [r[0] for r in signed.select(ratio(F.col("a"), F.col("b"), 0)).collect()]
    assert got == [-3.0, 3.0, 0.0, None] and str(got[2]) == "0.0"


def test_to_numeric(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), (None,)], "t string")
    assert [r[0] for r in df.select(to_numeric(F.col("t"))).collect()] == [1.5, None, None, None]
