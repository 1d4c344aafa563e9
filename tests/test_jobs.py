"""Sinks, the whole audit, streaming."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from chaffsieve import AuditConfig
from chaffsieve.operators.cluster import model_vectors, precomputed_vectors
from chaffsieve.plans.audit import audit, build_fact, enrich, reflag, rename, store_views
from chaffsieve.plans.views import VIEWS
from chaffsieve.schema import FACT_COLUMNS
from chaffsieve.sources import sinks
from chaffsieve.sources.corpus import corpus_from_conversations, limit_rows, load_corpus
from chaffsieve.streaming.features import enrich_stream

CFG = replace(AuditConfig(), k_min=2, k_max=3, restarts=1)

TOPICS = [
    "Write a poem about the quiet sea",
    "Explain how volcanoes erupt in detail",
    "List seven famous mountain rivers",
    "What causes winter storms",
]


@pytest.fixture(scope="module")
def corpus(raw):
    rows = []
    for i in range(120):
        text = f"{TOPICS[i % 4]} number {'abcdefghij'[i % 10]}{'klmnop'[i % 6]}"
        output = "Yes." if i % 9 == 0 else f"This is answer {i}. It has \"quotes\", commas,\nand lines " * 3
        rows.append((text, "ctx" if i % 5 == 0 else "", output))
    return raw(rows + [("", "", "x"), ("y", "", None)])


def test_load_corpus(spark, corpus, tmp_path):
    corpus.drop("input").withColumnRenamed("order_key", "seq").write.parquet(f"{tmp_path}/c")
    got = load_corpus(spark, f"{tmp_path}/c", "seq", limit=5)
    assert got.columns == ["order_key", "instruction", "input", "output"]
    assert sorted(r["order_key"] for r in got.collect()) == [0, 7, 14, 21, 28]
    with pytest.raises(KeyError):
        load_corpus(spark, f"{tmp_path}/c")
    assert limit_rows(corpus, 0).count() == 0


def test_audit_end_to_end(spark, corpus, tmp_path):
    out = str(tmp_path / "audit")
    result = audit(corpus, out, CFG, load=lambda f: sinks.load_fact_table(f, "fact_full"))
    assert result.loaded == 120 and result.fact.columns == list(FACT_COLUMNS)
    assert set(result.view_status.values()) == {"ok"} and len(result.view_status) == 9
    report = result.report.first()
    impact = spark.read.option("header", True).csv(f"{out}/views/v_cleaning_impact")
    assert impact.agg(F.sum(F.col("n_rows").cast("int"))).first()[0] == report["total_rows"] == 120
    [line] = [r[0] for r in spark.read.text(f"{out}/audit_summary").collect()]
    assert json.loads(line)["total_rows"] == 120
    [line] = [r[0] for r in spark.read.text(f"{out}/cluster_selection").collect()]
    assert sum(json.loads(line)["sizes"].values()) == 120
    ids = [r[0] for r in result.fact.select("row_id").collect()]
    assert sorted(ids) == list(range(1, 121))
    assert sinks.read_enriched(spark, out, "flagged", limit=7).count() == 7
    # texts with quotes, commas and line breaks survive the CSV
    options = dict(header=True, multiLine=True, escape='"')
    sample = spark.read.options(**options).csv(f"{out}/enriched_sample")
    want = {r["row_id"]: r["output"] for r in result.fact.collect()}
    assert {int(r["row_id"]): r["output"] for r in sample.collect()} == want


def test_audit_without_clustering_groups_by_rule(spark, corpus, tmp_path):
    result = audit(corpus, str(tmp_path), CFG, limit=50, cluster=False, views=False)
    rows = result.fact.collect()
    assert len(rows) == 50 and {r["cluster_id"] for r in rows} == {None}
    assert result.report.first()["cluster_sizes"] == {}


def test_missing_model_and_failing_load_are_reported(spark, corpus, tmp_path):
    def no_model(df):
        raise ImportError("no encoder installed")

    def no_table(fact):
        raise RuntimeError("no such table")

    result = audit(corpus, str(tmp_path), CFG, vectors=no_model, load=no_table, views=False)
    assert result.selection is None and result.loaded is None
    assert [p.split(":")[0] for p in result.problems] == ["clustering skipped", "load failed"]
    assert result.fact.count() == 120


def test_a_model_missing_on_the_workers_is_reported(spark, corpus, tmp_path):
    def absent():
        import no_such_encoder

        return no_such_encoder.load

    def encode(df):
        return model_vectors(df, absent, CFG)

    result = audit(corpus, str(tmp_path), CFG, vectors=encode, views=False)
    assert result.selection is None and "no_such_encoder" in result.problems[0]
    assert {r["cluster_id"] for r in result.fact.collect()} == {None}

    def broken(df):
        return df.select("row_id", F.raise_error(F.lit("bad vectors")).alias("features"))

    with pytest.raises(Exception, match="bad vectors"):
        audit(corpus, str(tmp_path / "b"), CFG, vectors=broken, views=False)


def test_finished_audits_are_renamed_and_flagged_again(spark, corpus, tmp_path):
    out = str(tmp_path / "audit")
    wordless = corpus.limit(1).selectExpr("-1L AS order_key", "'123 456' AS instruction", "input", "output")
    first = audit(corpus.unionByName(wordless), out, CFG, views=False)
    assert first.fact.filter("cluster_id = -1 AND cluster_label = 'unassigned'").count() == 1
    ids = [r[0] for r in first.fact.select("cluster_id").distinct().collect()]
    names = {i: f"topic {i}" for i in ids if i >= 0}
    renamed = rename(spark, out, names, CFG, load=lambda f: sinks.load_fact_table(f, "fact_renamed"))
    assert renamed.loaded == 121 and set(renamed.view_status.values()) == {"ok"}
    labels = {r["cluster_id"]: r["cluster_label"] for r in renamed.fact.collect()}
    assert labels == {**names, -1: "unassigned"}

    strict = replace(CFG, min_output_words=10_000)
    # Flagging again replaces the stage that the first result reads.
    before = {r["row_id"]: r for r in first.fact.collect()}
    again = reflag(spark, out, strict, views=False)
    for r in again.fact.collect():
        assert r["flag_too_short"] == 1 and r["cluster_label"] == labels[r["cluster_id"]]
        assert (r["cluster_id"], r["duplicate_of"]) == (before[r["row_id"]]["cluster_id"], before[r["row_id"]]["duplicate_of"])
    stored = store_views(again.fact, CFG, "kept_")
    assert len(stored) == 9
    short = spark.table("kept_v_flag_prevalence").filter("flag_name = 'too_short'").first()
    assert short["n"] == 121


def test_keys_must_be_unique(spark, raw):
    rows = raw([("a", "", "x"), ("b", "", "y"), ("c", "", "z")])
    twice = rows.withColumn("order_key", F.when(F.col("order_key") == 7, 0).otherwise(F.col("order_key")))
    with pytest.raises(ValueError, match="0 rows without one, 1 rows repeat one"):
        enrich(twice, CFG)
    missing = rows.withColumn("order_key", F.when(F.col("order_key") > 0, F.col("order_key")))
    with pytest.raises(ValueError, match="1 rows without one"):
        enrich(missing, CFG)


def test_keys_of_any_type_keep_their_order(spark, raw, tmp_path):
    rows = raw([(t, "", "o") for t in ("d", "b", "a", "c")])
    rows.withColumn("when", F.expr("timestamp_millis(order_key)")).drop("order_key").write.parquet(f"{tmp_path}/t")
    rows.withColumn("part", F.expr("cast(order_key / 100 as decimal(10, 4))")).drop("order_key").write.parquet(f"{tmp_path}/d")
    for path, key in (("t", "when"), ("d", "part")):
        got = load_corpus(spark, f"{tmp_path}/{path}", key)
        found = {r["row_id"]: r["instruction"] for r in enrich(got, CFG).collect()}
        assert [found[i] for i in (1, 2, 3, 4)] == ["d", "b", "a", "c"]
        assert sorted(r["instruction"] for r in limit_rows(got, 2).collect()) == ["b", "d"]


def test_long_conversations_keep_their_keys_apart(spark, tmp_path):
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}") for c in (1, 2) for t in range(998, 1006)]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = corpus_from_conversations(spark, str(tmp_path))
    assert got.count() == got.select("order_key").distinct().count() == 8


def test_loading_refuses_another_table(spark, corpus):
    fact = build_fact(corpus.withColumn("cluster_id", F.lit(0)), CFG)
    fact.withColumnRenamed("row_id", "id").limit(0).write.saveAsTable("not_facts")
    with pytest.raises(ValueError, match="not_facts is not a fact table"):
        sinks.load_fact_table(fact, "not_facts")
    assert spark.table("not_facts").count() == 0


def test_audit_with_given_vectors_and_names(spark, corpus, tmp_path):
    vectors = precomputed_vectors(
        spark.range(1, 121).select(
            "id", F.array(F.lit(1.0), (F.col("id") % 2).cast("double")).alias("v")
        ),
        "id", "v",
    )
    names = {0: "zero", 1: "one", 2: "two"}
    result = audit(corpus, str(tmp_path), CFG, vectors=vectors, names=names, views=False)
    got = {(r["row_id"] % 2, r["cluster_label"]) for r in result.fact.collect()}
    assert len(got) == 2 and {n for _, n in got} <= set(names.values())


def test_loading(spark, corpus):
    fact = build_fact(corpus.withColumn("cluster_id", F.lit(0)), CFG)
    assert sinks.load_fact_table(fact, "facts") == 120
    assert sinks.load_fact_table(fact, "facts") == 120
    assert sinks.load_fact_table(fact, "facts", truncate=False) == 240
    assert dict(spark.table("facts").dtypes)["flesch_score"] == "decimal(8,2)"
    with pytest.raises(RuntimeError, match="expected 3"):
        sinks.verify_load(spark.table("facts"), 3)
    with pytest.raises(KeyError, match="n_flags"):
        sinks.select_fact(fact.drop("n_flags"))


def test_scores_that_do_not_fit_become_null(spark, corpus):
    fact = build_fact(corpus.withColumn("cluster_id", F.lit(0)), CFG).limit(3)
    odd = fact.withColumn("flesch_score", F.when(F.col("row_id") % 2 == 0, F.lit("nan")).otherwise("-1e9"))
    assert {r["flesch_score"] for r in sinks.coerce_fact(odd).collect()} == {None}


def test_one_failing_view_does_not_stop_the_export(spark, corpus, tmp_path):
    fact = build_fact(corpus.withColumn("cluster_id", F.lit(0)), CFG)

    def broken(fact, cfg):
        raise ValueError("no such view")

    views = {"v_broken": broken, "v_flag_prevalence": VIEWS["v_flag_prevalence"]}
    status = sinks.export_views(fact, views, str(tmp_path), CFG)
    assert status["v_broken"].startswith("failed") and status["v_flag_prevalence"] == "ok"


def test_features_on_a_stream(spark, corpus, tmp_path):
    corpus.write.parquet(f"{tmp_path}/in")
    query = (
        enrich_stream(spark, f"{tmp_path}/in", CFG)
        .writeStream.format("memory").queryName("streamed").outputMode("append")
        .option("checkpointLocation", f"{tmp_path}/cp").start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    columns = ["instruction_clean", "sentence_count", "flesch_score", "flag_repetitive"]
    batch = enrich(corpus, CFG).select(*columns).collect()
    streamed = spark.table("streamed").select(*columns).collect()
    assert sorted(map(str, streamed)) == sorted(map(str, batch)) and len(batch) == 120
