"""What near duplicates and staged tables leave on disk, and the work they are dealt to."""

import random
import time
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pytest
from pyspark.sql import functions as F

from chaffsieve import AuditConfig
from chaffsieve.operators import neardup, tfidf
from chaffsieve.operators.neardup import near_duplicates
from chaffsieve.sources import staging
from chaffsieve.sources.staging import settle, stage

CFG = AuditConfig()
SCHEMA = "row_id bigint, cluster_id int, instruction_clean string"


def texts(seed, n=60):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfgh" for b in "aeiou"]
    return [(i, i % 2, " ".join(rng.choices([*words, "the", "a", "é", ""], k=rng.randrange(0, 30)))) for i in range(1, n + 1)]


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def test_shuffles_go_with_the_write(spark):
    before = shuffle_files(spark)
    kept = stage(spark.range(1000).repartition(3, "id"), "spread")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert kept.count() == 1000
    assert spark.conf.get(staging._CLEANUP) == "false"


def test_settled_tables_leave_nothing_of_their_way(spark):
    before = len(staging._written)
    kept = settle(spark, "sum", lambda: stage(spark.range(5), "way").selectExpr("sum(id) AS n"))
    assert [p.rsplit("/", 1)[1][:3] for p in staging._written[before:]] == ["sum"]
    assert kept.first()["n"] == 10


def test_near_duplicates_keep_only_their_result(spark):
    before = len(staging._written)
    found = near_duplicates(spark.createDataFrame(texts(1), SCHEMA), CFG)
    assert [p.rsplit("/", 1)[1][:15] for p in staging._written[before:]] == ["near-duplicates"]
    found.collect()


def test_rounds_hold_each_pair_of_blocks_once_and_few_copies(spark):
    sizes = range(1, 10)
    chunks = spark.createDataFrame([(f"g{n}", b, n) for n in sizes for b in range(n)], "grp string, block int, blocks int")
    met = Counter()
    for nearest, farthest in neardup._rounds(max(sizes)):
        rows = neardup._units(chunks, nearest, farthest).collect()
        assert max(Counter((r["grp"], r["block"]) for r in rows).values()) <= 2 * neardup._DISTANCES
        met.update((r["grp"], r["low"], r["high"], r["block"]) for r in rows)
    want = {(f"g{n}", a, b, c) for n in sizes for a, b in combinations_with_replacement(range(n), 2) for c in (a, b)}
    assert set(met) == want and set(met.values()) == {1}


def test_parts_of_the_terms_are_all_terms(spark):
    rows = [*texts(2), (99, 0, None), (100, 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    text = F.col("instruction_clean")

    def cells(column):
        listed = df.select("row_id", column.alias("terms"))
        return sorted(tuple(r) for r in listed.select("row_id", F.inline("terms")).collect())

    want = cells(tfidf.term_counts(tfidf.term_list(text, CFG.stop_words)))
    assert cells(tfidf.counted_terms(text, CFG.stop_words)) == want
    assert sorted(c for p in range(3) for c in cells(tfidf.counted_terms(text, CFG.stop_words, p, 3))) == want


def test_counting_in_parts_gives_the_same_vocabulary(spark, monkeypatch):
    df = spark.createDataFrame(texts(3), SCHEMA)
    whole = sorted(map(tuple, tfidf.vocabulary(df, "cluster_id", CFG).collect()))
    monkeypatch.setattr(tfidf, "_LARGE", -1)
    assert sorted(map(tuple, tfidf.vocabulary(df, "cluster_id", CFG).collect())) == whole


def test_vectors_in_place_are_those_of_the_join(spark):
    df = spark.createDataFrame([*texts(4), (98, 0, "ba ba"), (99, 0, "ba ba ba ba")], SCHEMA)
    words = tfidf.vocabulary(df, "cluster_id", CFG)

    def rows(make):
        found = {r["row_id"]: r for r in make(df, "cluster_id", words, CFG).collect()}
        same = {}
        for i in sorted(found):
            same.setdefault((found[i]["group_key"], bytes(found[i]["vector_key"])), []).append(i)
        return {i: (r["group_key"], r["norm"], r["ranks"], r["counts"]) for i, r in found.items()}, sorted(same.values())

    assert rows(tfidf._vectors_in_place) == rows(tfidf._vectors_by_join)


@pytest.mark.parametrize("kind", ["<i4", "<i8", "<f8"])
def test_squeezed_numbers_come_back(kind):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 1000):
        values = rng.integers(-9, 1 << 20, n).astype(kind)
        assert np.array_equal(neardup._unsqueeze(neardup._squeeze(values, kind), n, kind), values)


def test_steps_of_ranks_come_back():
    sizes = np.array([3, 1, 2, 4])
    ranks = np.array([1, 5, 9, 7, 2, 20000, 3, 4, 5, 6], np.int32)
    assert np.array_equal(neardup._from_steps(neardup._steps(ranks, sizes), sizes), ranks)


def test_few_terms_have_a_place_each(spark):
    df = spark.createDataFrame(texts(5), SCHEMA)
    words = tfidf.vocabulary(df, "cluster_id", CFG)
    vecs = tfidf._vectors_in_place(df, "cluster_id", words, CFG)
    chunks, _ = neardup._blocks(vecs, neardup.representatives(vecs), words, CFG)
    most = dict(vecs.groupBy("group_key").agg(F.max(F.element_at("ranks", -1))).collect())
    assert {(r["grp"], r["places"]) for r in chunks.collect()} == {(str(k), min(n, 128)) for k, n in most.items()}
