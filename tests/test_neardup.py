"""Near duplicates against brute force over all pairs."""

import math
import random
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from chaffsieve import AuditConfig
from chaffsieve.operators import neardup
from chaffsieve.operators.neardup import flag_near_duplicates, near_duplicates
from chaffsieve.operators.quality import root_of
from chaffsieve.operators.tfidf import weighted_terms
from chaffsieve.sources import staging

CFG = AuditConfig()


def brute_force(rows, cfg, threshold, rule):
    """rows: (row_id, group, cleaned text) -> {row_id: (duplicate_of, similarity)}."""
    groups = defaultdict(list)
    for row_id, group, text in rows:
        if group is not None:
            words = [w for w in text.split() if len(w) > 1 and w not in cfg.stop_words]
            grams = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
            groups[group].append((row_id, Counter(grams)))
    found = {}
    for block in groups.values():
        df = Counter(t for _, c in block for t in c)
        total = Counter()
        for _, c in block:
            total.update(c)
        vocab = sorted((t for t in df if df[t] >= cfg.min_df), key=lambda t: (-total[t], t))
        vocab = set(vocab[: cfg.max_features])
        vecs = []
        for row_id, c in block:
            v = {t: n * (math.log((1 + len(block)) / (1 + df[t])) + 1)
                 for t, n in c.items() if t in vocab}
            norm = math.sqrt(sum(x * x for x in v.values()))
            vecs.append((row_id, {t: x / norm for t, x in v.items()}))
        for row_id, v in vecs:
            best = None
            for other, w in vecs:
                if other == row_id or (rule == "any_earlier" and other > row_id):
                    continue
                sim = round(sum(x * w.get(t, 0.0) for t, x in v.items()), 9)
                if sim >= threshold and (best is None or (-sim, other) < (-best[1], best[0])):
                    best = (other, sim)
            if best and best[0] < row_id:
                found[row_id] = best
    return found


def corpus(seed, n=260):
    """Templates, shuffles, near copies and a group of copies holding a third."""
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "klmn"]
    common = words[:10]
    out = []
    for i in range(1, n + 1):
        kind = rng.random()
        if kind < 0.33:
            text = "write short poem mountain river"
        elif kind < 0.5 and out:
            base = rng.choice(out)[2].split()
            if base and rng.random() < 0.7:
                base[rng.randrange(len(base))] = rng.choice(words)
            text = " ".join(base)
        elif kind < 0.75:
            text = "write short poem about " + " ".join(rng.choices(common, k=rng.randrange(1, 9)))
        else:
            text = " ".join(rng.choices(words, k=rng.randrange(0, 14)))
        out.append((i, rng.choice([0, 0, 1, None]), text))
    return out


VARIANTS = {
    "default": CFG,
    "all levels": replace(CFG, signature_stop=0),
    "two levels": replace(CFG, signature_stop=2, signature_depth=2),
    "split postings": replace(CFG, posting_block=3, signature_depth=1),
    "split, deep": replace(CFG, posting_block=2, signature_stop=1),
    "no broadcasts": replace(CFG, broadcast_rows=40, hot_rows=20, posting_block=5),
    "no broadcast bytes": replace(CFG, broadcast_bytes=0, hot_rows=20),
    "all rows long": replace(CFG, inline_terms=0),
    "some rows long": replace(CFG, inline_terms=9, posting_block=4, signature_stop=2),
    "small vocabulary": replace(CFG, max_features=25, topk_salts=3),
    "whole vocabulary": replace(CFG, max_features=None),
}


@pytest.mark.parametrize("rule", ["nearest", "any_earlier"])
def test_parallel_vectors_are_copies(spark, rule):
    one = replace(CFG, max_features=1)
    rows = [(1, 0, "alpha"), (2, 0, "alpha alpha"), (3, 0, "alpha alpha"), (4, 0, "alpha alpha")]
    schema = "row_id bigint, cluster_id int, instruction_clean string"
    got = near_duplicates(spark.createDataFrame(rows, schema), one, rule=rule).collect()
    assert {(r["row_id"], r["duplicate_of"]) for r in got} == {(2, 1), (3, 1), (4, 1)}
    # Few terms, often repeated: proportional counts all over.
    rng = random.Random(5)
    words = ["red", "blue", "green", "grey"]
    rows = [
        (i, i % 2, " ".join(w for w in words for _ in range(rng.choice([0, 0, 1, 2, 4]))))
        for i in range(1, 200)
    ]
    for k in (2, 4, 9):
        cfg = replace(CFG, max_features=k, topk_salts=2)
        got = near_duplicates(spark.createDataFrame(rows, schema), cfg, rule=rule).collect()
        want = brute_force(rows, cfg, cfg.duplicate_threshold, rule)
        assert {r["row_id"]: r["duplicate_of"] for r in got} == {i: v[0] for i, v in want.items()}


@pytest.mark.parametrize("name", VARIANTS)
def test_nearest_matches_brute_force(spark, name):
    cfg = VARIANTS[name]
    rows = corpus(len(name))
    df = spark.createDataFrame(rows, "row_id bigint, cluster_id int, instruction_clean string")
    for threshold in (0.9, 0.6) if name in ("default", "all levels") else (0.9,):
        got = near_duplicates(df, cfg, threshold=threshold).collect()
        want = brute_force(rows, cfg, threshold, "nearest")
        assert {r["row_id"]: r["duplicate_of"] for r in got} == {k: v[0] for k, v in want.items()}
        assert len(got) == len(want)
        for r in got:
            assert r["similarity"] == pytest.approx(want[r["row_id"]][1], abs=2e-9)


def test_any_earlier_matches_brute_force(spark):
    rows = corpus(99)
    df = spark.createDataFrame(rows, "row_id bigint, cluster_id int, instruction_clean string")
    got = near_duplicates(df, CFG, rule="any_earlier").collect()
    want = brute_force(rows, CFG, CFG.duplicate_threshold, "any_earlier")
    assert {r["row_id"]: r["duplicate_of"] for r in got} == {k: v[0] for k, v in want.items()}


def test_edge_blocks(spark):
    rows = [
        (1, 0, "alpha beta gamma"), (2, 0, "alpha beta gamma"), (3, 0, "alpha beta gamma"),
        (4, 1, "alpha beta gamma"),
        (5, 2, "the of and"), (6, 2, "the of and"),
        (7, 3, ""), (8, 3, ""),
        (9, None, "alpha beta"), (10, None, "alpha beta"),
    ]
    df = spark.createDataFrame(rows, "row_id bigint, cluster_id int, instruction_clean string")
    flagged = flag_near_duplicates(df, CFG).orderBy("row_id").collect()
    assert [r["is_near_duplicate"] for r in flagged] == [0, 1, 1] + [0] * 7
    assert [r["duplicate_of"] for r in flagged[:4]] == [None, 1, 1, None]


def test_rule_class_groups_without_clusters(spark):
    rows = [(1, "Other", "red blue green"), (2, "Advice", "red blue green"),
            (3, "Other", "red blue green")]
    df = spark.createDataFrame(rows, "row_id bigint, prompt_type_rule string, instruction_clean string")
    assert [tuple(r)[:2] for r in near_duplicates(df, CFG).collect()] == [(3, 1)]
    with pytest.raises(ValueError):
        near_duplicates(df, CFG, rule="latest")


def test_chains_end_at_unflagged_rows(spark):
    rows = corpus(7)
    df = spark.createDataFrame(rows, "row_id bigint, cluster_id int, instruction_clean string")
    flagged = flag_near_duplicates(df, CFG, threshold=0.6)
    links = {r["row_id"]: r["duplicate_of"] for r in flagged.collect()}
    assert all(v is None or v < k for k, v in links.items())

    def end(i):
        return i if links[i] is None else end(links[i])

    roots = {r["row_id"]: r["root"] for r in root_of(flagged, CFG).collect()}
    assert roots == {i: end(i) for i, v in links.items() if v is not None}


def test_result_does_not_depend_on_partitioning(spark):
    rows = corpus(11)
    df = spark.createDataFrame(rows, "row_id bigint, cluster_id int, instruction_clean string")
    seen = {
        frozenset(map(tuple, near_duplicates(df.repartition(n, F.rand(n)), CFG).collect()))
        for n in (1, 5)
    }
    assert len(seen) == 1


def test_long_rows_travel_once(spark):
    """What is staged on the way has no row per term or pair, however long the texts are."""
    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bcdfgh" for b in "aeiou" for c in "klmn"]
    rows = [(i, 0, " ".join(rng.choices(words, k=200))) for i in range(1, 121)]
    df = spark.createDataFrame(rows, "row_id bigint, cluster_id int, instruction_clean string")
    before = len(staging._written)
    near_duplicates(df, replace(CFG, inline_terms=9)).collect()
    made = {p.rsplit("/", 1)[1]: spark.read.parquet(p).count() for p in staging._written[before:]}
    words_only = ("vocabulary", "term-counts", "cuts")
    assert max(n for name, n in made.items() if not name.startswith(words_only)) <= len(rows)


def test_texts_are_spread_before_their_terms_are_listed(spark):
    df = spark.createDataFrame(corpus(3), "row_id bigint, cluster_id int, instruction_clean string")
    plan = weighted_terms(df, "cluster_id", CFG)._jdf.queryExecution().optimizedPlan().toString()
    # What is printed further down runs earlier.
    assert 0 < plan.index("Generate inline") < plan.index("RepartitionByExpression [row_id")


def test_products_of_chunks_share_their_room():
    rng = np.random.default_rng(1)
    shapes = [(7, 5), (3, 11), (12, 12), (1, 1)]
    for m, n in shapes:
        a, b = (rng.random((rows, 4)).astype(np.float32) for rows in (m, n))
        assert np.allclose(neardup._products(a, b), a @ b.T)
    held = neardup._room
    neardup._products(np.ones((12, 2), np.float32), np.ones((12, 2), np.float32))
    assert neardup._room is held
