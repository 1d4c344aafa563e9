"""Flags, score, report, views."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from chaffsieve import AuditConfig
from chaffsieve.operators import quality as ql
from chaffsieve.operators.sample import review_sample, sample_rows
from chaffsieve.plans.views import VIEWS, register_views
from chaffsieve.schema import FACT, QUALITY_FLAGS
from chaffsieve.sources.sinks import select_fact

CFG = AuditConfig()


def fact_frame(spark, rows):
    """Fact rows from dicts; what a row leaves out gets a plain default."""
    base = {f.name: 0 for f in FACT.fields}
    base |= {"instruction": "do it", "input_text": "", "output": "done.", "cluster_id": 0,
             "prompt_type_rule": "Other", "readability_level": "easy", "adequacy_score": 100,
             "duplicate_of": None, "flesch_score": 50.0, "words_per_sentence": 1.0}
    full = [base | {"row_id": i + 1} | r for i, r in enumerate(rows)]
    for r in full:
        r.setdefault("cluster_label", None)
        if r["cluster_label"] == 0:
            r["cluster_label"] = f"cluster_{r['cluster_id']}"
    schema = ", ".join(
        f"{f.name} double" if f.dataType.typeName() == "decimal" else f"{f.name} {f.dataType.simpleString()}"
        for f in FACT.fields
    )
    data = [tuple(r[f.name] for f in FACT.fields) for r in full]
    return select_fact(spark.createDataFrame(data, schema))


def rows_of(view, fact, cfg=CFG):
    return VIEWS[view](fact, cfg).collect()


@pytest.mark.parametrize("flags, score", [(0, 100), (2, 60), (5, 0)])
def test_adequacy(spark, flags, score):
    row = [1] * flags + [0] * (5 - flags)
    df = spark.createDataFrame([tuple(row)], ", ".join(f"{f} int" for f in QUALITY_FLAGS))
    got = ql.score_adequacy(df, CFG).first()
    assert (got["n_flags"], got["adequacy_score"]) == (flags, score)
    harsh = ql.score_adequacy(df, replace(CFG, flag_penalty=30)).first()
    assert harsh["adequacy_score"] == max(0, 100 - 30 * flags)


def test_fences_match_linear_quantiles(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 1, 2]), int(rng.random() < 0.1),
             round(rng.gauss(50, 20) * (8 if rng.random() < 0.05 else 1), 2))
            for i in range(600)]
    rows += [(600, 3, 0, 12.34), (601, None, 0, 1.0), (602, 1, 0, None)]
    df = spark.createDataFrame(rows, "row_id int, cluster_id int, is_code_like int, flesch_score double")
    got = {r["row_id"]: r["flag_readability_outlier"]
           for r in ql.flag_readability_outliers(df, CFG).collect()}
    for g in (0, 1, 2, 3):
        block = [(i, s) for i, c, code, s in rows if c == g and code == 0 and s is not None]
        q1, q3 = np.quantile([s for _, s in block], [0.25, 0.75])
        for i, s in block:
            assert got[i] == int(s < q1 - 1.5 * (q3 - q1) or s > q3 + 1.5 * (q3 - q1))
    assert got[601] == got[602] == 0 and sum(got.values()) > 5
    assert all(got[i] == 0 for i, _, code, _ in rows if code)


def test_report_counts_a_row_once(spark):
    fact = fact_frame(spark, [
        {"is_exact_duplicate": 1, "is_near_duplicate": 1, "adequacy_score": 40, "cluster_id": 1},
        {"is_near_duplicate": 1, "flag_truncated": 1, "adequacy_score": 80},
        {"adequacy_score": 60}, {}, {},
    ])
    r = ql.audit_report(fact, CFG).first()
    assert (r["total_rows"], r["duplicate_rows_union"], r["low_adequacy_rows"]) == (5, 2, 2)
    assert (r["recommended_drop_rows"], r["rows_remaining_after_clean"]) == (3, 2)
    assert (r["duplicate_pct"], r["mean_adequacy"]) == (40.0, 76.0)
    assert r["flag_counts"]["flag_truncated"] == 1
    assert r["cluster_sizes"] == {"cluster_0": 4, "cluster_1": 1}


def test_report_on_nothing_and_without_labels(spark):
    empty = ql.audit_report(fact_frame(spark, [{}]).filter("false"), CFG).first()
    assert empty["total_rows"] == 0 and empty["duplicate_pct"] is None
    bare = ql.audit_report(fact_frame(spark, [{}]).drop("cluster_label"), CFG).first()
    assert bare["cluster_sizes"] == {}


def test_worst_by_cluster_keeps_ties(spark):
    fact = fact_frame(spark, [{"output_word_count": 5}] * 25 + [{"output_word_count": 9}] * 3
                      + [{"cluster_id": None, "output_word_count": i} for i in range(30)])
    got = rows_of("v_worst_by_cluster", fact)
    tied = [r for r in got if r["cluster_label"] == "cluster_0"]
    assert len(tied) == 25 and {r["rk"] for r in tied} == {1}
    assert sorted(r["rk"] for r in got if r["cluster_label"] != "cluster_0") == list(range(1, 21))


def test_length_quartile_sizes(spark):
    got = rows_of("v_length_quality", fact_frame(spark, [{"output_word_count": 4}] * 10))
    assert [(r["quartile"], r["n_rows"]) for r in got] == [(1, 3), (2, 3), (3, 2), (4, 2)]


def test_cleaning_impact_prefers_duplicates(spark):
    fact = fact_frame(spark, [
        {"is_near_duplicate": 1, "adequacy_score": 20}, {"adequacy_score": 60}, {}, {},
    ])
    got = {r["disposition"]: (r["n_rows"], r["pct_of_cluster"]) for r in rows_of("v_cleaning_impact", fact)}
    assert got == {"drop_duplicate": (1, 25.0), "drop_low_quality": (1, 25.0), "keep": (2, 50.0)}


def test_deviation_of_a_lone_row(spark):
    got = rows_of("v_deviation_from_cluster", fact_frame(spark, [{"output_word_count": 7}]))[0]
    assert (got["cluster_avg_len"], got["deviation"], got["pct_rank_in_cluster"]) == (7.0, 0.0, 0.0)


def test_averages_skip_null_scores(spark):
    fact = fact_frame(spark, [{"flesch_score": None}, {"flesch_score": -10.15}, {"flesch_score": -10.15}])
    assert rows_of("v_cluster_composition", fact)[0]["avg_readability"] == -10.2


def test_duplicate_pairs_show_both_rows(spark):
    fact = fact_frame(spark, [{"instruction": "x" * 100}]
                      + [{"is_near_duplicate": 1, "duplicate_of": 1, "instruction": "y"}] * 40)
    for cfg in (CFG, replace(CFG, broadcast_rows=1, hot_rows=3)):
        got = rows_of("v_duplicate_pairs", fact, cfg)
        assert len(got) == 40
        assert {(r["kept_row"], r["kept_instruction"]) for r in got} == {(1, "x" * 90)}


def test_views_can_be_read_by_name(spark):
    fact = fact_frame(spark, [{"flag_truncated": 1}, {}])
    register_views(fact, CFG)
    got = {r["flag_name"]: r["pct"] for r in spark.table("v_flag_prevalence").collect()}
    assert got["truncated"] == 50.0 and got["empty_ish"] == 0.0 and len(got) == 5
    assert all(spark.catalog.tableExists(v) for v in VIEWS)


def test_samples_are_exact_and_stable(spark):
    ids = spark.range(1, 5001).withColumnRenamed("id", "row_id")
    a = {r[0] for r in sample_rows(ids.repartition(3), 700, seed=1).collect()}
    b = {r[0] for r in sample_rows(ids.repartition(7), 700, seed=1).collect()}
    c = {r[0] for r in sample_rows(ids, 700, seed=2).collect()}
    assert len(a) == 700 and a == b and a != c
    assert sample_rows(ids, 10_000).count() == 5000


def test_review_sample_draws_low_scorers(spark):
    fact = fact_frame(spark, [{"adequacy_score": 100 - 20 * (i % 4)} for i in range(120)])
    got = review_sample(fact, CFG).collect()
    assert len(got) == 20 and all(r["adequacy_score"] <= 60 for r in got)
    assert review_sample(fact.filter("row_id < 5"), CFG).count() == 2
