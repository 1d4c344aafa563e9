"""Many fits in shared scans against fits one by one in numpy."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from chaffsieve import AuditConfig
from chaffsieve.operators import cluster as km
from chaffsieve.operators import kmeans

CFG = replace(AuditConfig(), k_min=2, k_max=5, restarts=2)


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, x):
    rows = [(i, Vectors.dense(v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, ["row_id", "features"]).repartition(3)


def lloyd(x, c, most=300, tolerance=1e-4):
    """(centres, sizes, cost, steps) as a model has them after its last pass."""
    for step in range(1, most + 1):
        gaps = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        own = gaps.argmin(axis=1)
        after = np.array([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        if np.linalg.norm(after - c, axis=1).max() <= tolerance:
            break
        c = after
    return c, np.bincount(own, minlength=len(c)), gaps.min(axis=1).sum(), step


def clustered(n=600, k=4, spread=0.05, dims=6):
    rng = np.random.default_rng(2)
    return unit(rng.normal(size=(k, dims))[rng.integers(k, size=n)] + spread * rng.normal(size=(n, dims)))


@pytest.fixture(scope="module")
def even():
    return unit(np.random.default_rng(1).normal(size=(400, 8)))


@pytest.mark.parametrize("kind", ["even", "clustered"])
def test_shared_scans_equal_fits_one_by_one(spark, even, kind):
    x = even if kind == "even" else clustered()
    packed = kmeans.blocks(frame(spark, x))
    vectors, weights = kmeans.candidates(packed, 20, 4, 7)
    assert weights.sum() == len(x) and len(np.unique(vectors, axis=0)) == len(vectors)
    starts = [kmeans.seeds(vectors, weights, k, s) for k in (2, 3, 5, 7) for s in range(3)]
    held = kmeans.balls(packed, vectors, ball_rows=32)
    together = kmeans.advance(held, starts, 300)
    for start, model in zip(starts, together):
        centers, sizes, cost, steps = lloyd(x, start)
        assert model.cost == pytest.approx(cost, rel=1e-9) and model.steps == steps
        assert model.sizes.tolist() == sizes.tolist() and np.allclose(model.centers, centers)
        [alone] = kmeans.advance(held, [start], 300)
        assert alone.cost == pytest.approx(model.cost, rel=1e-12)
        assert model.cost + model.between == pytest.approx((x * x).sum(), rel=1e-9)


def test_single_precision_takes_half_the_bytes_and_the_same_turns(spark):
    rng = np.random.default_rng(5)
    x = unit(rng.normal(size=(900, 6))).astype(np.float32).astype(np.float64)
    # Points as near to two centres as doubles can tell, and copies of centres.
    start = x[:5] / 2
    middle = (start[0] + start[1]) / 2
    x = np.concatenate((x, (middle + 1e-7 * rng.normal(size=(200, 6))).astype(np.float32).astype(np.float64), x[:50]))
    held = kmeans.balls(kmeans.blocks(frame(spark, x)), x[:3], ball_rows=64)
    assert held.rows.selectExpr("sum(octet_length(data))").first()[0] == 4 * x.size
    [found], _ = kmeans.one_pass(held, [start])
    gaps = (start**2).sum(axis=1) - 2 * x @ start.T
    assert found.sizes.tolist() == np.bincount(gaps.argmin(axis=1), minlength=5).tolist()
    for model, first in zip(kmeans.advance(held, [start, x[10:18]], 300), (start, x[10:18])):
        centers, sizes, cost, _ = lloyd(x, first)
        assert model.cost == pytest.approx(cost, rel=1e-5) and np.allclose(model.centers, centers, atol=1e-3)
    doubles = kmeans.blocks(frame(spark, x + 1e-12))
    assert doubles.selectExpr("sum(octet_length(data))").first()[0] == 8 * x.size


def test_balls_save_distances_where_points_cluster(spark):
    x = clustered(spread=0.01)
    packed = kmeans.blocks(frame(spark, x))
    vectors, _ = kmeans.candidates(packed, 20, 4, 7)
    held = kmeans.balls(packed, vectors, ball_rows=64)
    centers = np.array([x[0], *(x[((x - x[0]) ** 2).sum(axis=1).argsort()[[-1, -2]]])])
    models, looked_at = kmeans.one_pass(held, [centers])
    assert looked_at < len(x) * len(centers) / 2
    assert models[0].cost == pytest.approx(((x[:, None] - centers) ** 2).sum(axis=2).min(axis=1).sum(), rel=1e-9)


def test_silhouettes_of_all_models_are_the_pairwise_ones(spark, even):
    packed = kmeans.blocks(frame(spark, even))
    vectors, weights = kmeans.candidates(packed, 20, 4, 7)
    held = kmeans.balls(packed, vectors)
    models = kmeans.advance(held, [kmeans.seeds(vectors, weights, k, 1) for k in (2, 4, 6)], 50)
    models.append(kmeans.advance(held, [even[:1]], 1)[0])
    found = kmeans.silhouettes(held, models)
    assert found[-1] is None
    d = 1 - even @ even.T
    for model, score in zip(models[:-1], found):
        own = ((even[:, None] - model.centers) ** 2).sum(axis=2).argmin(axis=1)
        each = []
        for i in range(len(even)):
            same = own == own[i]
            a = d[i][same].sum() / max(same.sum() - 1, 1)
            b = min(d[i][own == c].mean() for c in set(own.tolist()) - {own[i]})
            each.append((b - a) / max(a, b) if same.sum() > 1 else 0.0)
        assert score == pytest.approx(np.mean(each), abs=1e-9)


def test_copies_and_few_different_vectors(spark):
    x = unit(np.array([[1.0, 0.0], [0.0, 1.0]]))[[0] * 300 + [1] * 5]
    models, scores = kmeans.fit_many(frame(spark, x), [(2, 0), (9, 0)], CFG)
    assert [len(m.centers) for m in models] == [2, 2] and models[0].cost == pytest.approx(0, abs=1e-9)
    assert sorted(models[0].sizes.tolist()) == [5, 300] and scores[0] == pytest.approx(1.0)
    assert kmeans.fit_many(frame(spark, x).limit(0), [(2, 0)], CFG) == ([], [])
    best, model, table = km.sweep_k(frame(spark, x), CFG)
    assert best == 2 and [r["k"] for r in table.collect()] == [2]
    best, model, table = km.sweep_k(frame(spark, x[:300]), CFG)
    assert best == 1 and len(model.centers) == 1 and table.count() == 0


def sparse_rows(n, dims, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        at = np.sort(rng.choice(dims, size=int(rng.integers(0, 6)), replace=False))
        rows.append((i, Vectors.sparse(dims, at.tolist(), rng.normal(size=len(at)).tolist())))
    return rows


def test_sparse_vectors_meet_centres_as_dense_ones_do(spark, monkeypatch):
    rows = sparse_rows(80, 50)
    centers = spark.createDataFrame(
        [(c, np.random.default_rng(c).normal(size=50).tolist()) for c in range(9)], "cluster_id int, centroid array<double>"
    )
    dense = [(i, Vectors.dense(v.toArray())) for i, v in rows]
    mixed = [r if i % 2 else d for i, (r, d) in enumerate(zip(rows, dense))]
    frames = [spark.createDataFrame(r, ["row_id", "features"]) for r in (rows, dense, mixed)]
    want = {
        i: min((float(np.linalg.norm(v.toArray() - c["centroid"])), c["cluster_id"]) for c in centers.collect()) for i, v in rows
    }
    for limit in (1 << 20, 3):
        monkeypatch.setattr(kmeans, "_CELLS", limit)
        for df in frames:
            for cfg in (CFG, replace(CFG, centroid_bytes=1000)):
                got = km.assign_to_centroids(df, centers, cfg).collect()
                assert len(got) == 80
                for r in got:
                    assert (pytest.approx(r["distance"], abs=1e-9), r["cluster_id"]) == want[r["row_id"]]


def test_folding_keeps_angles_and_loses_no_row(spark):
    rows = [r for r in sparse_rows(200, 60_000) if r[1].numNonzeros()]
    rows += [(1000 + i, Vectors.sparse(60_000, [i, i + 1], [1.0, 1.0])) for i in range(0, 3000, 2)]
    folded = kmeans.fold(spark.createDataFrame(rows, ["row_id", "features"]), 512).collect()
    x = {r["row_id"]: r["features"].toArray() for r in folded}
    assert len(x) == len(rows) and all(np.linalg.norm(v) == pytest.approx(1) for v in x.values())
    ids = [i for i, _ in rows[:150]]
    wide = unit(np.array([v.toArray() for _, v in rows[:150]]))
    narrow = np.array([x[i] for i in ids])
    assert np.abs(wide @ wide.T - narrow @ narrow.T).max() < 0.6
    assert np.abs(wide @ wide.T - narrow @ narrow.T).mean() < 0.05


TEXTS = {
    "wordless": ["你好", "再见", "谢谢"] * 4,
    "one text": ["the same words"] * 12,
    "two texts": ["red apple pie", "blue evening sky"] * 6,
    "empty": [],
}


@pytest.mark.parametrize("kind", TEXTS)
def test_any_corpus_can_be_clustered(spark, kind):
    texts = TEXTS[kind]
    cleaned = ["" if kind == "wordless" else t for t in texts]
    df = spark.createDataFrame(
        [(i + 1, t, c) for i, (t, c) in enumerate(zip(texts, cleaned))],
        "row_id bigint, instruction string, instruction_clean string",
    )
    clusters, record = km.cluster_corpus(df, AuditConfig())
    found = {r["row_id"]: r["cluster_id"] for r in clusters.collect()}
    note = record.first()["note"]
    assert len(found) == len(texts) and note
    if kind in ("wordless", "empty"):
        assert set(found.values()) <= {-1}
    else:
        assert len(set(found.values())) == len(set(texts))
        assert all((found[i + 1] == found[j + 1]) == (a == b) for i, a in enumerate(texts) for j, b in enumerate(texts))
