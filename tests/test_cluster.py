"""Vectors, fits, assignment, exemplars, labels."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from chaffsieve import AuditConfig
from chaffsieve.operators import cluster as km

CFG = replace(AuditConfig(), k_min=2, k_max=4, restarts=1)


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    centers = np.eye(3) * 10
    points = [centers[i % 3] + rng.normal(size=3) for i in range(90)]
    rows = [(i + 1, [float(x) for x in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id bigint, v array<double>")


def test_precomputed_vectors_are_unit(spark, blobs):
    unit = km.precomputed_vectors(blobs, "id", "v").first()["features"]
    assert np.linalg.norm(unit.toArray()) == pytest.approx(1.0)


def test_model_vectors(spark):
    def toy_model():
        """Stands in for a user's sentence encoder."""

        def predict(texts):
            return np.array([[len(t), t.count("a") + 1.0] for t in texts], dtype=np.float32)

        return predict

    df = spark.createDataFrame([(1, "banana"), (2, "xyz")], "row_id bigint, instruction string")
    got = {r["row_id"]: r["features"].toArray() for r in km.model_vectors(df, toy_model, CFG).collect()}
    assert got[1] == pytest.approx(np.array([6, 4]) / np.sqrt(52), abs=1e-6)
    assert got[2] == pytest.approx(np.array([3, 1]) / np.sqrt(10), abs=1e-6)


def test_sweep_finds_the_blobs(spark, blobs):
    points = km.precomputed_vectors(blobs, "id", "v")
    best, model, scores = km.sweep_k(points, CFG)
    assert best == 3 and [r["k"] for r in scores.collect()] == [2, 3, 4]
    found = {r["row_id"]: r["cluster_id"] for r in km.assign(points, model).collect()}
    assert all(found[i] == found[i + 3] for i in range(1, 88))


def test_given_centroids_agree_with_the_model(spark, blobs, monkeypatch):
    points = km.precomputed_vectors(blobs, "id", "v")
    model = km.fit_kmeans(points, 3, CFG)
    centroids = km.centroid_table(model, spark)
    a = {r["row_id"]: r["cluster_id"] for r in km.assign(points, model).collect()}
    b = {r["row_id"]: r["cluster_id"] for r in km.assign_to_centroids(points, centroids).collect()}
    assert a == b
    # Any number of centroids, in blocks of any size; equal ones go to the smaller id.
    many = [(100 + i, r["features"].toArray().tolist()) for i, r in enumerate(points.collect())]
    many += [(1000 + i, v) for i, v in many]
    table = spark.createDataFrame(many, "cluster_id int, centroid array<double>")
    for block in (1 << 20, 7):
        monkeypatch.setattr(km, "_BLOCK", block)
        found = km.assign_to_centroids(points, table).collect()
        assert all(r["distance"] == 0 and r["cluster_id"] < 1000 for r in found)


def test_silhouette_is_the_pairwise_one(spark, blobs):
    points = km.precomputed_vectors(blobs, "id", "v")
    assigned = points.withColumn("cluster_id", (F.col("row_id") % 4).cast("int"))
    rows = assigned.collect()
    x = np.array([r["features"].toArray() for r in rows])
    own = np.array([r["cluster_id"] for r in rows])
    d = 1 - x @ x.T
    scores = []
    for i in range(len(x)):
        same = own == own[i]
        a = d[i][same].sum() / (same.sum() - 1)
        b = min(d[i][own == c].mean() for c in set(own) - {own[i]})
        scores.append((b - a) / max(a, b))
    assert km.silhouette(assigned) == pytest.approx(np.mean(scores), abs=1e-9)


def test_exemplars_nearest_first_and_empty(spark):
    members = spark.createDataFrame(
        [(i, Vectors.dense([float(i)]), i % 2) for i in range(40)], ["row_id", "features", "cluster_id"]
    ).withColumn("cluster_id", F.col("cluster_id").cast("int"))
    texts = spark.range(40).select(
        F.col("id").alias("row_id"), F.concat(F.lit("t"), "id", F.repeat(F.lit("x"), 200)).alias("instruction")
    )
    centroids = spark.createDataFrame([(0, [0.0]), (1, [39.0]), (2, [5.0])], "cluster_id int, centroid array<double>")
    got = {r["cluster_id"]: r["exemplars"] for r in km.exemplars(texts, members, centroids, CFG).collect()}
    assert [t.rstrip("x") for t in got[0]] == [f"t{i}" for i in range(0, 20, 2)]
    assert [t.rstrip("x") for t in got[1]] == [f"t{i}" for i in range(39, 19, -2)]
    assert got[2] == [] and {len(t) for t in got[0]} == {110}


def test_relabel_names_unknown_ids(spark):
    df = spark.createDataFrame([(1, 0), (2, 3)], "row_id bigint, cluster_id int")
    named = km.relabel_clusters(df, {0: "zero", 3: "three", 9: "unused"}).collect()
    assert {r["cluster_id"]: r["cluster_label"] for r in named} == {0: "zero", 3: "three"}
    with pytest.raises(KeyError, match="3"):
        km.relabel_clusters(df, {0: "zero"})


def test_rows_of_no_cluster_need_no_name(spark):
    df = spark.createDataFrame([(1, 0), (2, -1)], "row_id bigint, cluster_id int")
    named = km.relabel_clusters(df, {0: "zero"}).collect()
    assert {r["cluster_id"]: r["cluster_label"] for r in named} == {0: "zero", -1: "unassigned"}
    many = spark.range(300).select(F.col("id").cast("int").alias("cluster_id"))
    with pytest.raises(KeyError, match="299 cluster ids"):
        km.relabel_clusters(many, {0: "zero"})


def test_sparse_and_dense_vectors_have_the_same_exemplars(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(size=(60, 8)) * (rng.random((60, 8)) < 0.4)
    sparse = [(i, Vectors.sparse(8, {int(j): float(v[j]) for j in np.flatnonzero(v)}), i % 3) for i, v in enumerate(values)]
    dense = [(i, Vectors.dense(v), i % 3) for i, v in enumerate(values)]
    texts = spark.range(60).select(F.col("id").alias("row_id"), F.col("id").cast("string").alias("instruction"))
    centroids = spark.createDataFrame([(c, values[c::3].mean(axis=0).tolist()) for c in range(3)], "cluster_id int, centroid array<double>")
    found = []
    for rows in (sparse, dense):
        members = spark.createDataFrame(rows, ["row_id", "features", "cluster_id"]).withColumn("cluster_id", F.col("cluster_id").cast("int"))
        found.append({r["cluster_id"]: r["exemplars"] for r in km.exemplars(texts, members, centroids, CFG).collect()})
    assert found[0] == found[1]


def test_a_sample_keeps_its_partitions(spark):
    from chaffsieve.operators.sample import draw, sample_rows

    rows = spark.range(0, 5000, 1, 16).withColumnRenamed("id", "row_id")
    picked = sample_rows(rows, 700, seed=3)
    assert picked.rdd.getNumPartitions() > 1
    want = rows.withColumn("d", draw("row_id", 3)).orderBy("d", "row_id").limit(700)
    assert {r["row_id"] for r in picked.collect()} == {r["row_id"] for r in want.collect()}


def test_the_fit_uses_all_rows_unless_told_otherwise(spark, monkeypatch):
    texts = [f"word{i % 7} thing{i % 5}" for i in range(90)]
    df = spark.createDataFrame([(i + 1, t, t) for i, t in enumerate(texts)], "row_id bigint, instruction string, instruction_clean string")
    seen = []
    sweep = km.sweep_k
    monkeypatch.setattr(km, "sweep_k", lambda points, cfg: seen.append(points.count()) or sweep(points, cfg))
    km.cluster_corpus(df, replace(CFG, fit_sample=None, k_max=2))
    km.cluster_corpus(df, replace(CFG, fit_sample=40, k_max=2))
    assert seen == [90, 40]
    defaults = AuditConfig()
    assert (defaults.fit_sample, defaults.restarts) == (None, 10)


def test_rows_without_words_stay_unassigned(spark):
    texts = ["red apple", "red apple pie", "blue sky", "blue sky wide", "", "green tea"] * 5
    df = spark.createDataFrame(
        [(i + 1, t, t) for i, t in enumerate(texts)],
        "row_id bigint, instruction string, instruction_clean string",
    )
    clusters, record = km.cluster_corpus(df, CFG)
    got = {r["row_id"]: (r["cluster_id"], r["cluster_label"]) for r in clusters.collect()}
    assert len(got) == 30
    assert all((got[i + 1] == (-1, "unassigned")) == (t == "") for i, t in enumerate(texts))
    r = record.first()
    assert sum(r["sizes"].values()) == 30 and r["best_k"] in r["silhouette_by_k"]
    assert set(r["exemplars"]) == {str(i) for i in range(r["best_k"])}
