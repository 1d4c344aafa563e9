"""One runnable query per operator, over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.operators import clean as cl
from chaffsieve.operators import cluster as km
from chaffsieve.operators import kmeans
from chaffsieve.operators import quality as ql
from chaffsieve.operators.neardup import near_duplicates
from chaffsieve.operators.order import (
    assign_ntile,
    dense_positions,
    quantiles_by_sketch,
    sketched_quantiles,
)
from chaffsieve.operators.sample import review_sample, sample_rows
from chaffsieve.operators.tfidf import weighted_terms
from chaffsieve.plans import increments, stored_views
from chaffsieve.plans.audit import audit, build_fact, enrich, flag, reflag, rename
from chaffsieve.plans.views import VIEWS
from chaffsieve.schema import QUALITY_FLAGS
from chaffsieve.sources import corpus, sinks
from chaffsieve.sources.corpus import CLUSTER_NAMES
from chaffsieve.sources.sinks import select_fact
from chaffsieve.sources.staging import scratch_root, settle, shared, stage

CFG = AuditConfig()
# So few terms per group that the limit binds on any of the test tables.
SMALL_VOCABULARY = replace(CFG, max_features=40)

Query = Callable[[SparkSession, str], DataFrame]

# Staged once per application and data folder, the way the views of a loaded
# corpus share its fact table.


def enriched(spark: SparkSession, base: str) -> DataFrame:
    return shared(
        spark,
        (base, "enriched"),
        lambda: settle(spark, "enriched", lambda: enrich(corpus.corpus_mixed(spark, base), CFG)),
    )


def enriched_whole(spark: SparkSession, base: str) -> DataFrame:
    """Documents alone, their whole texts as instructions."""
    return shared(
        spark,
        (base, "enriched-whole"),
        lambda: settle(
            spark, "whole-texts", lambda: enrich(corpus.corpus_from_documents(spark, base, whole=True), CFG)
        ),
    )


def fact(spark: SparkSession, base: str) -> DataFrame:
    def build() -> DataFrame:
        named = km.relabel_clusters(enriched(spark, base), CLUSTER_NAMES)
        return settle(spark, "fact", lambda: select_fact(flag(named, CFG)))

    return shared(spark, (base, "fact"), build)


def full_build(spark: SparkSession, base: str) -> DataFrame:
    """The fact table from the raw tables, sharing nothing."""
    return build_fact(corpus.corpus_mixed(spark, base), CFG, CLUSTER_NAMES)


def _cleaned(spark: SparkSession, base: str) -> DataFrame:
    return cl.number_rows(cl.clean(corpus.corpus_mixed(spark, base)))


def _digest(df: DataFrame) -> DataFrame:
    return df.withColumn("output_md5", F.md5("output")).drop("output")


def _features(df: DataFrame) -> DataFrame:
    return df.select(
        "row_id",
        "instruction_clean",
        "has_input",
        "instruction_word_count",
        "output_word_count",
        "sentence_count",
        "words_per_sentence",
        "is_code_like",
        "flag_truncated",
        "flag_too_short",
        "flag_empty_ish",
        "flag_repetitive",
    )


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the absent pointer as 0."""
    return df.withColumns(
        {
            "words_per_sentence": F.col("words_per_sentence").cast("double"),
            "flesch_score": F.col("flesch_score").cast("double"),
            "duplicate_of": F.coalesce("duplicate_of", F.lit(0)),
        }
    )


def _rounded(found: DataFrame) -> DataFrame:
    return found.withColumn("similarity", F.round("similarity", 6))


def _fences(spark: SparkSession, base: str) -> DataFrame:
    fences = ql.readability_fences(enriched(spark, base), "cluster_id")
    return fences.select("cluster_id", "n", *[(F.col(c) / 800).alias(c) for c in ("q1", "q3", "lo", "hi")])


def _report(spark: SparkSession, base: str) -> DataFrame:
    return _flat(ql.audit_report(fact(spark, base), CFG))


def _flat(report: DataFrame) -> DataFrame:
    """The report's struct as columns, its map as text."""
    sizes = F.transform(
        F.array_sort(F.map_entries("cluster_sizes")),
        lambda e: F.concat_ws("=", e["key"], e["value"]),
    )
    return report.select("*", *[f"flag_counts.{f}" for f in QUALITY_FLAGS]).drop(
        "flag_counts"
    ).withColumn("cluster_sizes", F.array_join(sizes, ";"))


def _points(spark: SparkSession, base: str) -> DataFrame:
    table = spark.read.parquet(f"{base}/embeddings.parquet")
    return km.precomputed_vectors(
        table.withColumnRenamed("label", "cluster_id"), "vec_id", "embedding", ["cluster_id"]
    )


def _assigned(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """(assignment to the nearest label mean, the label means)."""
    points = _points(spark, base)
    centroids = km.centroids_of(points)
    return km.assign_to_centroids(points, centroids), centroids


def _encoder():
    """Stands in for a user's sentence model: characters, and a letter's number."""

    def predict(texts):
        return np.array([[len(t), t.count("e") + 1] for t in texts], dtype=np.float32)

    return predict


def _model_vectors(spark: SparkSession, base: str) -> DataFrame:
    found = km.model_vectors(enriched(spark, base), _encoder, CFG)
    x = vector_to_array("features")
    return found.select("row_id", F.round(x[0], 6).alias("x0"), F.round(x[1], 6).alias("x1"))


def _members(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    found, centroids = _assigned(spark, base)
    points = _points(spark, base).drop("cluster_id")
    return points.join(found.select("row_id", "cluster_id"), "row_id"), centroids


def _silhouette(spark: SparkSession, base: str) -> DataFrame:
    members, _ = _members(spark, base)
    return spark.createDataFrame([(round(km.silhouette(members), 6),)], "silhouette double")


def _exemplars(spark: SparkSession, base: str, whole: bool = False) -> DataFrame:
    members, centroids = _members(spark, base)
    texts = corpus.corpus_from_documents(spark, base, whole=whole).select(
        F.col("order_key").alias("row_id"), "instruction"
    )
    # At small scales there are more vectors than documents.
    members = members.join(texts.select("row_id"), "row_id", "left_semi")
    lists = km.exemplars(texts, members, centroids.drop("n"), CFG)
    return lists.select(
        "cluster_id", F.posexplode("exemplars").alias("position", "exemplar")
    ).withColumn("position", (F.col("position") + 1).cast("bigint"))


def _squares(model: km.Model) -> float:
    """Within and between clusters: together the squared lengths of all points, whatever the clusters."""
    return round(model.cost + model.between, 6)


def _fit(spark: SparkSession, base: str) -> DataFrame:
    """Every row, whether it went to its nearest centre, and the fit's totals beside it."""
    points = _points(spark, base).drop("cluster_id")
    model = km.fit_kmeans(points, 7, CFG)
    nearest = km.assign_to_centroids(points, km.centroid_table(model, spark))
    both = km.assign(points, model).join(
        nearest.select("row_id", F.col("cluster_id").alias("nearest")).dropDuplicates(["row_id"]), "row_id"
    )
    return both.select(
        "row_id",
        (F.col("cluster_id") == F.col("nearest")).alias("at_nearest"),
        F.lit(len(model.centers)).cast("bigint").alias("n_clusters"),
        F.lit(int(model.sizes.sum())).cast("bigint").alias("rows_fitted"),
        F.lit(_squares(model)).alias("squares"),
    )


def _sweep(spark: SparkSession, base: str) -> DataFrame:
    points = _points(spark, base).drop("cluster_id")
    best, model, scores = km.sweep_k(points, CFG)
    assigned = stage(km.assign(points, model), "swept")
    score = km.silhouette(assigned)
    every = Window.partitionBy()  # one row per k
    return scores.select(
        F.col("k").cast("bigint").alias("k"),
        F.col("silhouette").between(-1, 1).alias("score_in_range"),
        F.count_if(
            (F.col("k") == best)
            & (F.col("silhouette") == F.max("silhouette").over(every))
            & (F.abs(F.col("silhouette") - F.lit(score)) < 1e-9)
        )
        .over(every)
        .alias("n_best"),
        F.lit(assigned.filter(F.col("cluster_id") < best).count()).alias("rows_assigned"),
        F.lit(_squares(model)).alias("squares"),
    )


# Deterministic starts for Lloyd's steps: the means of the rows of a label, of a remainder.
STARTS = {"label": "cluster_id", "remainder": "row_id % 6"}
STEPS = 3


def _kmeans_steps(spark: SparkSession, base: str) -> DataFrame:
    """Some steps from several starts, all advanced by the same scans."""
    points = _points(spark, base)
    starts = []
    for group in STARTS.values():
        means = km.centroids_of(points.withColumn("start", F.expr(group)), "start").orderBy("start")
        starts.append(np.array([r["centroid"] for r in means.collect()]))  # a row per label or remainder
    rows = []
    packed = kmeans.blocks(points)
    held = kmeans.balls(packed, np.concatenate(starts))
    for step in range(1, STEPS + 1):
        models, _ = kmeans.one_pass(held, starts)
        for name, model in zip(STARTS, models):
            rows += [
                (name, step, c, int(n), round(model.cost, 6)) for c, n in enumerate(model.sizes.tolist())
            ]
        starts = [kmeans.moved(m) for m in models]
    return spark.createDataFrame(rows, "start string, step bigint, place bigint, n bigint, cost double")


def _cluster_corpus(rows: DataFrame) -> DataFrame:
    clustered, _ = km.cluster_corpus(rows, CFG)
    return clustered.select("row_id", (F.col("cluster_label") == "unassigned").alias("is_unassigned"))


def _quartile(spark: SparkSession, base: str) -> DataFrame:
    narrow = enriched(spark, base).select("row_id", "output_word_count")
    return assign_ntile(narrow, "output_word_count", "row_id", 4, "quartile").select(
        "row_id", F.col("quartile").cast("bigint").alias("quartile")
    )


def _limit(spark: SparkSession, base: str) -> DataFrame:
    rows = corpus.limit_rows(corpus.corpus_mixed(spark, base), 100)
    return _digest(rows.select("order_key", "instruction", "input", "output"))


def _row_id(spark: SparkSession, base: str) -> DataFrame:
    keys = cl.clean(corpus.corpus_mixed(spark, base)).select("order_key")
    return dense_positions(keys, ["order_key"], "row_id").select("order_key", "row_id")


def _exact(raw: DataFrame) -> DataFrame:
    index = cl.index_rows(cl.clean(raw))
    return index.select("row_id", "is_exact_duplicate")


def _exact_count(raw: DataFrame) -> DataFrame:
    return _exact(raw).agg(F.sum("is_exact_duplicate").alias("exact_duplicates"))


def _tfidf(rows: DataFrame) -> DataFrame:
    return weighted_terms(rows, "cluster_id", CFG).select(
        F.col("group_key").alias("cluster_id"),
        "row_id",
        "term",
        F.col("tf").cast("bigint").alias("tf"),
        F.round("weight", 6).alias("weight"),
    )


def _outliers(spark: SparkSession, base: str) -> DataFrame:
    flagged = ql.flag_readability_outliers(enriched(spark, base), CFG)
    return flagged.select("row_id", "flag_readability_outlier")


def _review(spark: SparkSession, base: str) -> DataFrame:
    return _digest(review_sample(fact(spark, base), CFG))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(header=True, multiLine=True, escape='"').csv(path)


def _saved_stage(spark: SparkSession, base: str) -> DataFrame:
    out = _folder(spark, "saved")
    sinks.write_enriched(enriched(spark, base), out, "enriched")
    return _features(sinks.read_enriched(spark, out, "enriched"))


def _sample_csv(spark: SparkSession, base: str) -> DataFrame:
    out = _folder(spark, "sample-csv")
    sinks.write_sample_csv(fact(spark, base), out, CFG)
    return _read_csv(spark, out).select(
        F.col("row_id").cast("bigint").alias("row_id"),
        "instruction",
        F.md5("output").alias("output_md5"),
        F.col("adequacy_score").cast("bigint").alias("adequacy_score"),
    )


def _review_csv(spark: SparkSession, base: str) -> DataFrame:
    out = _folder(spark, "review-csv")
    sinks.write_review_csv(review_sample(fact(spark, base), CFG), out)
    return _read_csv(spark, out).select(
        F.col("row_id").cast("bigint").alias("row_id"),
        F.md5("output").alias("output_md5"),
        *[F.col(c).cast("bigint").alias(c) for c in ("n_flags", "adequacy_score", *QUALITY_FLAGS)],
    )


def _audit_json(spark: SparkSession, base: str) -> DataFrame:
    out = _folder(spark, "audit-json")
    report = ql.audit_report(fact(spark, base), CFG)
    sinks.write_json(report, out)
    return _flat(spark.read.schema(report.schema).json(out))


def _loaded(spark: SparkSession, base: str) -> DataFrame:
    table = f"fact_{uuid.uuid4().hex}"
    sinks.load_fact_table(fact(spark, base), table)
    return _plain(spark.table(table))


def _exported(spark: SparkSession, base: str) -> DataFrame:
    out = _folder(spark, "views")
    status = sinks.export_views(fact(spark, base), VIEWS, out, CFG)
    counts = [
        _read_csv(spark, f"{out}/{name}").agg(
            F.lit(name).alias("view"), F.lit(said).alias("status"), F.count("*").alias("row_count")
        )
        for name, said in status.items()
    ]
    found = counts[0]
    for more in counts[1:]:
        found = found.unionByName(more)
    return found


# Views with an order, and the columns that name their rows.
ORDERED = {
    "v_cluster_composition": ["cluster_label"],
    "v_rule_vs_cluster": ["prompt_type_rule"],
    "v_duplicate_rate": ["cluster_label"],
    "v_length_quality": ["quartile"],
    "v_cleaning_impact": ["cluster_label", "disposition"],
}


def _ordered(spark: SparkSession, base: str) -> DataFrame:
    """Where each row of the ordered views stands; they have a row per cluster or class."""
    found = None
    for name, key in ORDERED.items():
        placed = VIEWS[name](fact(spark, base), CFG).select(
            F.lit(name).alias("view"),
            F.concat_ws("/", *[F.col(c).cast("string") for c in key]).alias("row_name"),
            F.monotonically_increasing_id().alias("at"),
        )
        found = placed if found is None else found.unionByName(placed)
    place = F.row_number().over(Window.partitionBy("view").orderBy("at")).cast("bigint")
    return found.select("view", "row_name", place.alias("place"))


def _view(name: str) -> Query:
    return lambda spark, base: VIEWS[name](fact(spark, base), CFG)


# ---- jobs, loads and stored views ------------------------------------------


def _loaded_corpus(spark: SparkSession, base: str) -> DataFrame:
    """A corpus under another key column, saved and read as a user's would be."""
    out = _folder(spark, "corpus")
    corpus.corpus_mixed(spark, base).drop("cluster_id").withColumnRenamed("order_key", "seq").write.parquet(out)
    return _digest(corpus.load_corpus(spark, out, "seq"))


def _quantiles(spark: SparkSession, base: str) -> DataFrame:
    found = quantiles_by_sketch(enriched(spark, base), "cluster_id", "output_word_count", SHARES, accuracy=50)
    return found.select("cluster_id", "share", "n", F.col("output_word_count").cast("bigint").alias("words"))


def _sketch_bounds(spark: SparkSession, base: str) -> DataFrame:
    """How many rows lie below and within each bracket of the sketch: the rank asked for is in between."""
    rows = enriched(spark, base).select("cluster_id", "output_word_count")
    brackets = sketched_quantiles(rows, "cluster_id", "output_word_count", SHARES, accuracy=50)
    met = rows.join(F.broadcast(brackets.withColumnRenamed("cluster_id", "c")), F.expr("cluster_id <=> c"))
    rank = F.ceil(F.round(F.col("share") * F.col("n"), 6))
    return (
        met.groupBy("cluster_id", "share", "n")
        .agg(
            F.count_if(F.expr("output_word_count < low")).alias("below"),
            F.count_if(F.expr("output_word_count <= high")).alias("upto"),
        )
        .select("cluster_id", "share", "n", ((F.col("below") < rank) & (rank <= F.col("upto"))).alias("holds_rank"))
    )


SHARES = [0.25, 0.5, 0.9]


def _observed(spark: SparkSession, base: str) -> DataFrame:
    """What cleaning counted while its rows were written."""
    rows, seen = cl.counted(corpus.corpus_mixed(spark, base))
    cl.clean(rows).write.parquet(_folder(spark, "observed"))
    return spark.createDataFrame([seen.get], "rows_read bigint, rows_kept bigint, rows_dropped bigint")


def _missing(spark: SparkSession, base: str) -> DataFrame:
    """The fact columns that the first stage does not have yet, with the rows that wait for them."""
    rows = enriched(spark, base)
    names = [(c,) for c in sinks.missing_columns(rows)]
    return rows.agg(F.count("*").alias("row_count")).join(
        F.broadcast(spark.createDataFrame(names, "missing string")), how="cross"
    )


def _cluster_json(spark: SparkSession, base: str) -> DataFrame:
    """A selection record of label clusters, saved as JSON and read back."""
    members, centroids = _members(spark, base)
    out = _folder(spark, "cluster-json")
    texts = corpus.corpus_from_documents(spark, base).select(F.col("order_key").alias("row_id"), "instruction")
    members = members.join(texts.select("row_id"), "row_id", "left_semi")
    scores = spark.createDataFrame([], "k int, silhouette double")
    record = km.selection_record(None, scores, km.exemplars(texts, members, centroids.drop("n"), CFG), members)
    sinks.write_json(record, out)
    saved = spark.read.schema(km.SELECTION_JSON).json(out)
    sizes = saved.select(F.explode("sizes").alias("cluster", "n"))
    lists = saved.select(F.explode("exemplars").alias("cluster", "texts"))
    return sizes.join(lists, "cluster").select(
        F.col("cluster").cast("int").alias("cluster_id"), "n", F.get("texts", F.lit(0)).alias("nearest"), F.size("texts").alias("shown")
    )


def _audited(spark: SparkSession, base: str) -> str:
    """A finished audit of the mixed corpus with the clusters it brings along."""

    def build() -> str:
        out = _folder(spark, "audit")
        raw = corpus.corpus_mixed(spark, base)
        # Killed after the first stage, then run to its end.
        sinks.write_enriched(
            enrich(raw, CFG), out, "enriched", sinks.fingerprint(raw, "enriched", repr(CFG))
        )
        result = audit(raw, out, CFG, cluster=False, names=CLUSTER_NAMES, views=False, resume=True)
        if result.reused != ["enriched"]:
            raise RuntimeError(f"stages taken over: {result.reused}")
        return out

    return shared(spark, (base, "audit"), build)


def _resumed(spark: SparkSession, base: str) -> DataFrame:
    return _plain(select_fact(sinks.read_enriched(spark, _audited(spark, base), "flagged")))


def _renamed_then_reflagged(spark: SparkSession, base: str) -> DataFrame:
    """Clusters found, named, and the rows flagged again: the names stay."""
    out = _folder(spark, "renamed")
    strict = replace(CFG, k_min=len(CLUSTER_NAMES), k_max=len(CLUSTER_NAMES), min_output_words=10_000)
    raw = corpus.corpus_mixed(spark, base)
    # One direction per cluster that the corpus brings along, so that these are found again.
    first = enriched(spark, base).select("row_id", "cluster_id")
    axes = F.transform(F.sequence(F.lit(0), F.lit(len(CLUSTER_NAMES) - 1)), lambda i: (i == F.col("cluster_id")).cast("double"))
    vectors = km.precomputed_vectors(first.withColumn("axis", axes), "row_id", "axis")
    audit(raw.drop("cluster_id"), out, strict, vectors=vectors, views=False)
    found = sinks.read_enriched(spark, out, "clusters").join(first.withColumnRenamed("cluster_id", "brought"), "row_id")
    pairs = found.select("cluster_id", "brought").distinct().collect()  # one row per cluster
    rename(spark, out, {r["cluster_id"]: CLUSTER_NAMES[r["brought"]] for r in pairs}, strict, views=False)
    again = reflag(spark, out, replace(strict, min_output_words=CFG.min_output_words), views=False)
    return _plain(again.fact).drop("cluster_id")


def _halves(spark: SparkSession, base: str) -> list[DataFrame]:
    """The mixed corpus in three parts, one after the other by key."""
    raw = corpus.corpus_mixed(spark, base)
    last = raw.agg(F.max("order_key")).first()[0]
    key, third = F.col("order_key"), last // 3
    return [raw.filter(key <= third), raw.filter((key > third) & (key <= 2 * third)), raw.filter(key > 2 * third)]


def _incremental(spark: SparkSession, base: str) -> DataFrame:
    """A corpus audited in parts that were added one by one."""
    root = _folder(spark, "increments")
    for part in _halves(spark, base):
        increments.append_batch(spark, root, increments.next_batch(spark, root), part, CFG)
    named = km.relabel_clusters(increments.read_rows(spark, root), CLUSTER_NAMES)
    return _plain(select_fact(flag(stage(named, "increments"), CFG)))


def _streamed(spark: SparkSession, base: str) -> DataFrame:
    """Exact duplicates of a corpus that arrives in three loads."""
    root, folder = _folder(spark, "stream-state"), _folder(spark, "stream-in")
    for part in _halves(spark, base):
        part.drop("cluster_id").write.mode("append").parquet(folder)
        increments.append_stream(spark, folder, root, CFG).awaitTermination()
    return increments.read_rows(spark, root).select("row_id", "is_exact_duplicate")


def _stored(spark: SparkSession, base: str) -> str:
    """Prefix of views that were created before the second half of the fact table was loaded."""

    def build() -> str:
        name = f"stored_{uuid.uuid4().hex}"
        rows = fact(spark, base)
        even = F.col("row_id") % 2 == 0
        sinks.load_fact_table(rows.filter(even), name)
        stored_views.create_views(spark, name, CFG, f"{name}_")
        sinks.load_fact_table(rows.filter(~even), name, truncate=False)
        return f"{name}_"

    return shared(spark, (base, "stored-views"), build)


def _stored_view(name: str) -> Query:
    return lambda spark, base: spark.table(f"{_stored(spark, base)}{name}")


def _by_cluster(spark: SparkSession, base: str) -> DataFrame:
    """A fact table laid out by cluster, one cluster of which was loaded wrongly and then again."""
    table = f"by_cluster_{uuid.uuid4().hex}"
    rows = fact(spark, base)
    sinks.load_fact_by_cluster(rows, table)
    one = rows.filter("cluster_id = 1")
    sinks.load_fact_by_cluster(one.filter("row_id % 3 = 0"), table)
    sinks.load_fact_by_cluster(one, table)
    return _plain(spark.table(table).select(*rows.columns))


QUERIES: dict[str, Query] = {
    "clean_corpus": lambda s, d: _digest(_cleaned(s, d)).drop("is_exact_duplicate"),
    "corpus_with_text_column": lambda s, d: _digest(
        cl.number_rows(
            cl.clean(corpus.corpus_mixed(s, d).withColumn("text", F.upper("instruction")))
        )
    ).drop("is_exact_duplicate"),
    "cleaning_counts": lambda s, d: cl.cleaning_counts(corpus.corpus_mixed(s, d)),
    "limit_rows": _limit,
    "row_id": _row_id,
    "exact_duplicates": lambda s, d: _exact(corpus.corpus_mixed(s, d)),
    "exact_duplicates_whole_text": lambda s, d: _exact(
        corpus.corpus_from_documents(s, d, whole=True)
    ),
    "exact_duplicate_count": lambda s, d: _exact_count(corpus.corpus_mixed(s, d)),
    "exact_duplicate_count_whole_text": lambda s, d: _exact_count(
        corpus.corpus_from_documents(s, d, whole=True)
    ),
    "text_features": lambda s, d: _features(enrich(corpus.corpus_mixed(s, d), CFG)),
    "conversation_features": lambda s, d: _features(
        enrich(corpus.corpus_from_conversations(s, d), CFG)
    ),
    "page_features": lambda s, d: _features(enrich(corpus.corpus_from_pages(s, d), CFG)),
    "flesch_readability": lambda s, d: enriched(s, d).select(
        "row_id", "flesch_score", "readability_level"
    ),
    "rule_category": lambda s, d: enriched(s, d).select("row_id", "prompt_type_rule"),
    "rule_baseline": lambda s, d: ql.rule_baseline(enriched(s, d)),
    "tfidf_weights": lambda s, d: _tfidf(enriched(s, d)),
    "tfidf_weights_whole_text": lambda s, d: _tfidf(enriched_whole(s, d)),
    "near_duplicates": lambda s, d: _rounded(near_duplicates(enriched(s, d), CFG)),
    "near_duplicates_small_vocabulary": lambda s, d: _rounded(
        near_duplicates(enriched(s, d), SMALL_VOCABULARY)
    ),
    "near_duplicates_whole_text": lambda s, d: _rounded(
        near_duplicates(enriched_whole(s, d), CFG)
    ),
    "near_duplicates_small_vocabulary_whole_text": lambda s, d: _rounded(
        near_duplicates(enriched_whole(s, d), SMALL_VOCABULARY)
    ),
    "near_duplicates_any_earlier_whole_text": lambda s, d: _rounded(
        near_duplicates(enriched_whole(s, d), CFG, rule="any_earlier")
    ),
    "near_duplicates_by_rule_whole_text": lambda s, d: _rounded(
        near_duplicates(enriched_whole(s, d), CFG, group="prompt_type_rule")
    ),
    "near_duplicates_any_earlier": lambda s, d: _rounded(
        near_duplicates(enriched(s, d), CFG, rule="any_earlier")
    ),
    "near_duplicates_by_rule": lambda s, d: _rounded(
        near_duplicates(enriched(s, d), CFG, group="prompt_type_rule")
    ),
    "readability_fences": _fences,
    "readability_outliers": _outliers,
    "adequacy": lambda s, d: fact(s, d).select("row_id", "n_flags", "adequacy_score"),
    "low_adequacy": lambda s, d: ql.low_adequacy_rows(fact(s, d), CFG).select(
        "row_id", "n_flags", "adequacy_score"
    ),
    "select_fact": lambda s, d: _plain(full_build(s, d)),
    "relabel_clusters": lambda s, d: km.relabel_clusters(_cleaned(s, d), CLUSTER_NAMES).select(
        "row_id", "cluster_id", "cluster_label"
    ),
    "cluster_sizes": lambda s, d: ql.cluster_sizes(fact(s, d)),
    "flagged_per_cluster": lambda s, d: ql.flagged_per_cluster(fact(s, d)),
    "length_quartile": _quartile,
    "duplicate_roots": lambda s, d: ql.root_of(fact(s, d), CFG),
    "review_sample": _review,
    "sample_rows": lambda s, d: sample_rows(enriched(s, d).select("row_id"), 200, seed=CFG.seed),
    "audit_report": _report,
    "saved_stage": _saved_stage,
    "sample_csv": _sample_csv,
    "review_csv": _review_csv,
    "audit_json": _audit_json,
    "loaded_fact": _loaded,
    "exported_views": _exported,
    "ordered_views": _ordered,
    **{name: _view(name) for name in VIEWS},
    "assign_clusters": lambda s, d: _assigned(s, d)[0].withColumn(
        "distance", F.round("distance", 6)
    ),
    "silhouette": _silhouette,
    "cluster_exemplars": _exemplars,
    "cluster_exemplars_whole_text": lambda s, d: _exemplars(s, d, whole=True),
    "model_vectors": _model_vectors,
    "fit_kmeans": _fit,
    "sweep_k": _sweep,
    "kmeans_steps": _kmeans_steps,
    "loaded_corpus": _loaded_corpus,
    "quantiles_by_sketch": _quantiles,
    "sketch_bounds": _sketch_bounds,
    "cleaning_counts_observed": _observed,
    "missing_columns": _missing,
    "default_labels": lambda s, d: km.default_labels(enriched(s, d)).select("row_id", "cluster_id", "cluster_label"),
    "cluster_json": _cluster_json,
    "resumed_audit": _resumed,
    "renamed_then_reflagged": _renamed_then_reflagged,
    "incremental_fact": _incremental,
    "streamed_duplicates": _streamed,
    "fact_by_cluster": _by_cluster,
    **{f"stored_{name}": _stored_view(name) for name in VIEWS},
    "cluster_corpus": lambda s, d: _cluster_corpus(enriched(s, d)),
    "cluster_corpus_whole_text": lambda s, d: _cluster_corpus(enriched_whole(s, d)),
}
