"""Rows added later, stages taken over, views and layouts that last."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from chaffsieve import AuditConfig
from chaffsieve.operators.order import quantiles_by_sketch, sketched_quantiles
from chaffsieve.plans import increments, stored_views
from chaffsieve.plans.audit import audit, build_fact, enrich
from chaffsieve.sources import sinks

CFG = replace(AuditConfig(), k_min=2, k_max=3, restarts=2)


@pytest.fixture(scope="module")
def corpus(raw):
    rows = [(f"Explain thing {i % 37} of kind {i % 5}", "ctx" if i % 4 == 0 else "", f"Answer {i}. " * (i % 9 + 1)) for i in range(90)]
    return raw(rows + [("", "", "dropped"), ("kept", "", "one more")])


def rows_of(df):
    columns = ["row_id", "instruction", "is_exact_duplicate", "output_word_count", "flag_too_short"]
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_batches_equal_the_whole_corpus(spark, corpus, tmp_path):
    root = str(tmp_path / "grown")
    parts = [corpus.filter("order_key < 200"), corpus.filter("order_key < 0"), corpus.filter("order_key >= 200")]
    for part in parts:
        increments.append_batch(spark, root, increments.next_batch(spark, root), part, CFG)
    assert rows_of(increments.read_rows(spark, root)) == rows_of(enrich(corpus, CFG))
    # A batch that runs again replaces itself.
    increments.append_batch(spark, root, 2, parts[2], CFG)
    assert rows_of(increments.read_rows(spark, root)) == rows_of(enrich(corpus, CFG))
    # The digests meet shuffled where the batch is not small.
    increments.append_batch(spark, root, 2, parts[2], replace(CFG, broadcast_rows=1))
    assert rows_of(increments.read_rows(spark, root)) == rows_of(enrich(corpus, CFG))
    with pytest.raises(ValueError, match="does not come after"):
        increments.append_batch(spark, root, 3, parts[0], CFG)
    with pytest.raises(FileNotFoundError):
        increments.read_rows(spark, str(tmp_path / "none"))


def test_a_stream_goes_on_where_it_stopped(spark, corpus, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "state")
    for low, high in ((0, 150), (150, 400), (400, 9999)):
        corpus.filter(f"order_key >= {low} AND order_key < {high}").coalesce(1).write.mode("append").parquet(folder)
        increments.append_stream(spark, folder, root, CFG).awaitTermination()
    assert rows_of(increments.read_rows(spark, root)) == rows_of(enrich(corpus, CFG))


def test_a_killed_audit_goes_on_after_its_last_stage(spark, corpus, tmp_path):
    out = str(tmp_path / "audit")

    def killed(df):
        raise RuntimeError("the driver went away")

    with pytest.raises(RuntimeError):
        audit(corpus, out, CFG, vectors=killed, views=False)
    result = audit(corpus, out, CFG, views=False, resume=True)
    assert result.reused == ["enriched"] and result.cleaning is None
    whole = audit(corpus, str(tmp_path / "whole"), CFG, views=False, resume=True)
    assert whole.reused == [] and whole.cleaning == {"rows_read": 92, "rows_kept": 91, "rows_dropped": 1}
    key = lambda r: r["row_id"]
    assert sorted(result.fact.collect(), key=key) == sorted(whole.fact.collect(), key=key)
    again = audit(corpus, out, CFG, views=False, resume=True)
    assert again.reused == ["enriched", "clusters", "flagged"]
    # Other settings or other rows make a stage stale, another order does not.
    made = sinks.made_of(spark, out, "enriched")
    assert made == sinks.fingerprint(corpus.repartition(5), "enriched", repr(CFG))
    assert made != sinks.fingerprint(corpus, "enriched", repr(replace(CFG, min_output_words=3)))
    assert made != sinks.fingerprint(corpus.filter("order_key > 0"), "enriched", repr(CFG))
    assert audit(corpus.filter("order_key < 40"), out, CFG, cluster=False, views=False, resume=True).reused == []


@pytest.mark.parametrize("texts", [["你好", "再见"] * 6, ["one same text"] * 9, ["red apple", "blue sky"] * 5, []])
def test_an_audit_survives_what_cannot_be_clustered(spark, raw, tmp_path, texts):
    result = audit(raw([(t, "", "An answer of some words.") for t in texts]), str(tmp_path), AuditConfig(), views=False)
    assert any(p.startswith("clustering: ") for p in result.problems)
    found = [r["cluster_id"] for r in result.fact.collect()]
    # Words that every row has weigh nothing, so equal texts have no vector either.
    assert len(found) == len(texts) and (set(found) <= {-1}) == ("red apple" not in texts)
    assert len(set(found)) == (2 if "red apple" in texts else min(len(texts), 1))


def test_stored_views_see_later_loads(spark, corpus):
    fact = build_fact(corpus.withColumn("cluster_id", (F.col("order_key") % 3).cast("int")), CFG)
    sinks.load_fact_table(fact.filter("row_id <= 50"), "grows")
    names = stored_views.create_views(spark, "grows", CFG, "grown_")
    assert len(names) == 9
    assert spark.table("grown_v_flag_prevalence").filter("flag_name = 'too_short'").first()["n"] <= 50
    assert spark.table("grown_v_cluster_composition").agg(F.sum("row_count")).first()[0] == 50
    sinks.load_fact_table(fact.filter("row_id > 50"), "grows", truncate=False)
    assert spark.table("grown_v_cluster_composition").agg(F.sum("row_count")).first()[0] == 91


def test_a_table_by_cluster_is_replaced_and_read_in_parts(spark, corpus):
    fact = build_fact(corpus.withColumn("cluster_id", (F.col("order_key") % 3).cast("int")), CFG)
    assert sinks.load_fact_by_cluster(fact, "laid_out") == 91
    one = fact.filter("cluster_id = 1")
    assert sinks.load_fact_by_cluster(one.limit(5), "laid_out") == 5
    sizes = dict(spark.table("laid_out").groupBy("cluster_id").count().collect())
    assert sizes[1] == 5 and sizes[0] + sizes[2] == 91 - one.count()
    wanted = spark.table("laid_out").filter("cluster_id = 2 AND row_id > 60")
    files = lambda df: df.select(F.input_file_name()).distinct().count()
    assert files(wanted) < files(spark.table("laid_out"))
    plan = wanted._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cluster_id" in plan and "GreaterThan(row_id,60)" in plan


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles_by_sketch_are_exact(spark, accuracy):
    rng = np.random.default_rng(1)
    rows = [(g, int(v)) for g in (1, 2, None) for v in rng.lognormal(3, 2, 700)] + [(3, 5), (4, None), (2, None)]
    df = spark.createDataFrame(rows, "g int, v bigint")
    shares = [0.0, 0.25, 0.5, 0.99, 1.0]
    found = {(r["g"], r["share"]): (r["v"], r["n"]) for r in quantiles_by_sketch(df, "g", "v", shares, accuracy).collect()}
    for g in (1, 2, 3, None):
        values = sorted(v for x, v in rows if x == g and v is not None)
        for s in shares:
            at = max(int(np.ceil(round(s * len(values), 6))), 1)
            assert found[g, s] == (values[at - 1], len(values))
    assert len(found) == 4 * len(shares)
    for r in sketched_quantiles(df, "g", "v", shares, accuracy).collect():
        assert r["low"] <= found[r["g"], r["share"]][0] <= r["high"]
    assert quantiles_by_sketch(df.limit(0), "g", "v", shares).collect() == []
