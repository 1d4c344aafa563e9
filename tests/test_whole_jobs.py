"""Queries do their whole job: all rows come out, and no single task takes them all."""

import glob

import numpy as np
import pyarrow.parquet as pq

from chaffsieve.operators import cluster as km
from chaffsieve.operators import kmeans
from chaffsieve.plans.queries import QUERIES
from chaffsieve.sources import staging
from chaffsieve.sources.staging import scratch_root


def test_fit_returns_every_row(spark):
    base = f"{scratch_root(spark)}/fit-rows"
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)], i % 3) for i in range(40)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(
        f"{base}/embeddings.parquet"
    )
    found = QUERIES["fit_kmeans"](spark, base).collect()
    assert sorted(r["row_id"] for r in found) == list(range(40))
    assert all(r["at_nearest"] and r["rows_fitted"] == 40 for r in found)


def test_streamed_loads_are_written_by_many_tasks(spark):
    base = f"{scratch_root(spark)}/stream-tables"
    texts = [(i, f"Line {i % 7}. Words of row {i}.", "en", "s", 9) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(6).write.parquet(f"{base}/documents.parquet")
    turns = [(1, 0, "user", "Ask."), (1, 1, "assistant", "Reply.")]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(
        f"{base}/conversations.parquet"
    )
    spark.createDataFrame([(1, "http://a.b/c", "<p>x</p>")], "page_id bigint, url string, html string").write.parquet(
        f"{base}/pages.parquet"
    )
    before = set(glob.glob(f"{scratch_root(spark)}/stream-in-*/part-*"))
    found = QUERIES["streamed_duplicates"](spark, base).collect()
    assert len(found) == 62
    assert len(set(glob.glob(f"{scratch_root(spark)}/stream-in-*/part-*")) - before) > 3


def test_a_pass_sends_a_row_per_model(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(64)]
    points = km.precomputed_vectors(spark.createDataFrame(rows, "id bigint, v array<double>"), "id", "v")
    packed = kmeans.blocks(points.repartition(8))
    starts = [rng.normal(size=(3, 4)) for _ in range(9)]
    held = kmeans.balls(packed, starts[0], ball_rows=4)
    many = kmeans.Balls(held.rows.repartition(8).localCheckpoint(), 8)
    assert kmeans.pass_rows(many, starts).count() == len(starts)
    models, _ = kmeans.one_pass(many, starts)
    assert [int(m.sizes.sum()) for m in models] == [64] * len(starts)


def test_points_are_read_in_small_groups(spark):
    rows = spark.range(6000).selectExpr("id", "transform(sequence(1, 512), i -> sin(id * 512 + i)) AS v").coalesce(1)
    packed = kmeans.blocks(km.precomputed_vectors(rows, "id", "v"))
    path = next(p for p in reversed(staging._written) if "point-blocks" in p)
    for file in glob.glob(f"{path}/*.parquet"):
        found = pq.ParquetFile(file).metadata
        sizes = [found.row_group(i).total_byte_size for i in range(found.num_row_groups)]
        assert max(sizes) < 20 << 20, sizes
    assert packed.selectExpr("sum(n)").first()[0] == 6000
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 256
