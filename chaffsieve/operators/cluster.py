"""Stage 2: vectors, K-Means sweep, assignment, exemplars, labels."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chaffsieve.config import AuditConfig
from chaffsieve.functions.text import preview
from chaffsieve.operators.kmeans import Model, dense_rows, fit_many, fold, products
from chaffsieve.operators.lookup import keyed_lookup, top_k_per_group
from chaffsieve.operators.sample import sample_rows
from chaffsieve.sources.staging import stage

UNASSIGNED = -1

UNASSIGNED_LABEL = "unassigned"

# Products a task holds while it compares vectors with centroids, some 8 MB.
_BLOCK = 1 << 20


# ---- vectors: each returns (id, features) with unit length -----------------


def precomputed_vectors(
    df: DataFrame, id_col: str, array_col: str, keep: Iterable[str] = ()
) -> DataFrame:
    """Vectors that already exist as an array column, with further columns on request."""
    raw = df.select(
        F.col(id_col).alias("row_id"),
        array_to_vector(F.col(array_col).cast("array<double>")).alias("raw"),
        *keep,
    )
    return Normalizer(p=2.0, inputCol="raw", outputCol="features").transform(raw).drop("raw")


def model_vectors(
    df: DataFrame, make_predict: Callable, cfg: AuditConfig, text: str = "instruction"
) -> DataFrame:
    """Vectors from a user's model: ``make_predict()`` loads it once per worker."""
    encode = predict_batch_udf(
        make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=cfg.embed_batch
    )
    return precomputed_vectors(
        df.select("row_id", encode(F.col(text)).alias("vector")), "row_id", "vector"
    )


def hashed_vectors(df: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Without a model: hashed TF-IDF of the cleaned instruction.

    Words that share a bucket of ``embed_dims`` count as one.  Texts without
    words give zero vectors; they stay unassigned.  No text gives no vector.
    """
    words = df.select(
        "row_id", F.filter(F.split("instruction_clean", " "), lambda w: w != "").alias("words")
    )
    if words.isEmpty():
        return words.select("row_id", array_to_vector(F.array().cast("array<double>")).alias("features"))
    steps = Pipeline(
        stages=[
            HashingTF(inputCol="words", outputCol="tf", numFeatures=cfg.embed_dims),
            IDF(inputCol="tf", outputCol="tfidf"),
            Normalizer(p=2.0, inputCol="tfidf", outputCol="features"),
        ]
    )
    return steps.fit(words).transform(words).select("row_id", "features")


def _nonzero() -> Column:
    return F.exists(F.unwrap_udt("features")["values"], lambda x: x != 0)


# ---- fits ------------------------------------------------------------------


def fit_kmeans(points: DataFrame, k: int, cfg: AuditConfig) -> Model:
    """The cheapest of ``restarts`` fits, each run until it converges."""
    models, _ = fit_many(points, [(k, r) for r in range(cfg.restarts)], cfg)
    return min(models, key=lambda m: m.cost)  # the first of equally cheap ones


def silhouette(assigned: DataFrame, cluster: str = "cluster_id") -> float:
    """Mean cosine silhouette, in time linear in the rows."""
    return ClusteringEvaluator(
        featuresCol="features", predictionCol=cluster, distanceMeasure="cosine"
    ).evaluate(assigned)


def sweep_k(
    points: DataFrame, cfg: AuditConfig, ks: Iterable[int] | None = None
) -> tuple[int, Model, DataFrame]:
    """(best k, its model, frame of (k, silhouette)); the smaller k wins ties.

    All restarts of all ``ks`` advance in the same scans.  A k beyond the
    number of different points counts as that number; with fewer than two
    clusters there is nothing to compare, and the frame is empty.
    """
    jobs = [(k, r) for k in ks or range(cfg.k_min, cfg.k_max + 1) for r in range(cfg.restarts)]
    models, scores = fit_many(points, jobs, cfg)
    best: dict[int, tuple[float, Model]] = {}
    for model, score in zip(models, scores):
        k = len(model.centers)
        if score is not None and (k not in best or score > best[k][0]):
            best[k] = (score, model)
    frame = points.sparkSession.createDataFrame(
        [(k, score) for k, (score, _) in sorted(best.items())], "k int, silhouette double"
    )
    if not best:
        return 1, models[0], frame
    k = max(sorted(best), key=lambda k: best[k][0])
    return k, best[k][1], frame


# ---- assignment ------------------------------------------------------------


def assign(points: DataFrame, model: Model) -> DataFrame:
    """``points`` (row_id, features) with the cluster_id of their nearest centre."""
    found = _nearest(np.arange(len(model.centers), dtype=np.int32), model.centers)
    return points.select("row_id", "features", found(F.unwrap_udt("features"))["cluster_id"].alias("cluster_id"))


def centroids_of(points: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """(cluster, n, centroid): mean vector per cluster."""
    return points.groupBy(cluster).agg(
        F.count("*").alias("n"),
        vector_to_array(Summarizer.mean(F.col("features"))).alias("centroid"),
    )


def centroid_table(model: Model, spark) -> DataFrame:
    """One row per cluster, empty ones included."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.centers)]
    return spark.createDataFrame(rows, "cluster_id int, centroid array<double>")


def _nearest(ids: np.ndarray, centers: np.ndarray) -> Callable[[Column], Column]:
    """(cluster_id, distance) of the nearest of some centres, for an unwrapped vector column."""
    squares = (centers * centers).sum(axis=1)

    @F.arrow_udf("cluster_id int, distance double")
    def nearest(vectors: pa.Array) -> pa.Array:
        best = np.zeros(len(vectors), np.int64)
        gap = np.zeros(len(vectors))
        step = max(1, _BLOCK // len(centers))
        for at in range(0, len(vectors), step):
            part = vectors.slice(at, step)
            along, lengths = products(part, centers)
            near = (squares - 2 * along).argmin(axis=1)
            rows = np.arange(len(near))
            best[at : at + step] = near
            gap[at : at + step] = lengths + squares[near] - 2 * along[rows, near]
        # What is nearly nothing may be rounding: taken again, coordinate by coordinate.
        close = np.flatnonzero(gap < 1e-6 * (1 + squares[best]))
        for i in range(0, len(close), 1024):
            some = close[i : i + 1024]
            x = dense_rows(vectors.take(pa.array(some)))
            x = np.pad(x, ((0, 0), (0, centers.shape[1] - x.shape[1])))
            gap[some] = ((x - centers[best[some]]) ** 2).sum(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(ids[best], pa.int32()), pa.array(np.sqrt(np.maximum(gap, 0)))], names=["cluster_id", "distance"]
        )

    return nearest


def assign_to_centroids(points: DataFrame, centroids: DataFrame, cfg: AuditConfig | None = None) -> DataFrame:
    """(row_id, cluster_id, distance) of the nearest centroid, however many there are.

    Centroids reach the tasks in parts of at most ``centroid_bytes``, one scan
    each; sparse vectors stay sparse.  Ties go to the smallest cluster id.
    """
    cfg = cfg or AuditConfig()
    table = stage(centroids.select("cluster_id", "centroid"), "centroid-table")
    size = table.agg(F.count("*").alias("n"), F.max(F.size("centroid")).alias("dims")).first()
    per_part = max(1, cfg.centroid_bytes // (8 * (size["dims"] or 1)))
    parts = max(1, -(-size["n"] // per_part))
    found = None
    for part in range(parts):
        # A part has about ``per_part`` rows.
        rows = table.filter(F.pmod(F.xxhash64("cluster_id"), F.lit(parts)) == part).collect()
        if not rows:
            continue
        rows.sort(key=lambda r: r["cluster_id"])
        ids = np.array([r["cluster_id"] for r in rows], dtype=np.int32)
        nearest = _nearest(ids, np.array([r["centroid"] for r in rows], dtype=np.float64))
        here = points.select("row_id", nearest(F.unwrap_udt("features")).alias("found")).select("row_id", "found.*")
        found = here if found is None else found.unionByName(here)
    if parts == 1:
        return found
    return found.groupBy("row_id").agg(F.min(F.struct("distance", "cluster_id")).alias("best")).select(
        "row_id", "best.cluster_id", "best.distance"
    )


def _squared_gap() -> Column:
    """Squared distance of ``features`` to the column ``centroid``; a sparse vector stays sparse."""
    square = lambda s, x: s + x * x
    vector = F.unwrap_udt("features")
    dense = F.aggregate(
        F.zip_with(vector["values"], "centroid", lambda a, b: a - b), F.lit(0.0), square
    )
    along = F.aggregate(
        F.zip_with(vector["indices"], vector["values"], lambda i, x: x * F.get(F.col("centroid"), i)),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    sparse = (
        F.aggregate(vector["values"], F.lit(0.0), square)
        + F.aggregate("centroid", F.lit(0.0), square)
        - 2 * along
    )
    return F.when(vector["type"] == 1, dense).otherwise(F.greatest(sparse, F.lit(0.0)))


def exemplars(
    texts: DataFrame, members: DataFrame, centroids: DataFrame, cfg: AuditConfig
) -> DataFrame:
    """(cluster_id, exemplars): the members nearest each centroid, nearest first.

    ``members`` holds row_id, features, cluster_id; ``texts`` row_id and
    instruction.  A cluster without members has an empty list.
    """
    sized = centroids.join(
        members.groupBy("cluster_id").agg(F.count("*").alias("n")), "cluster_id", "left"
    ).fillna(0, ["n"])
    table = stage(sized.select("cluster_id", "centroid", "n"), "centroids")
    near = keyed_lookup(members, table, ["cluster_id"], "n", cfg).select(
        "row_id", "cluster_id", _squared_gap().alias("gap")
    )
    top = top_k_per_group(near, ["cluster_id"], ["gap", "row_id"], "row_id", cfg.exemplars, cfg)
    # At most `exemplars` rows per cluster from here on, of any number of clusters.
    top = stage(top, "nearest-members")
    side = F.broadcast(top) if top.count() <= cfg.broadcast_rows else top
    named = texts.select("row_id", "instruction").join(side, "row_id").select(
        "cluster_id",
        F.struct("position", preview(F.col("instruction"), cfg.exemplar_chars).alias("text")).alias(
            "item"
        ),
    )
    lists = named.groupBy("cluster_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return table.join(lists, "cluster_id", "left").select(
        "cluster_id",
        F.coalesce(F.col("items.text"), F.array().cast("array<string>")).alias("exemplars"),
    )


# ---- labels ----------------------------------------------------------------


def default_labels(df: DataFrame) -> DataFrame:
    """cluster_<id> until someone has read the exemplars; rows of no cluster are unassigned."""
    named = F.concat(F.lit("cluster_"), F.col("cluster_id"))
    label = F.when(F.col("cluster_id") == UNASSIGNED, UNASSIGNED_LABEL).otherwise(named)
    return df.withColumn("cluster_label", label)


def relabel_clusters(df: DataFrame, names: dict[int, str]) -> DataFrame:
    """Names from a map; every id in use must be in it, extra names are fine.

    Rows of no cluster need no name.
    """
    names = {UNASSIGNED: UNASSIGNED_LABEL, **names}
    unknown = df.filter(~F.col("cluster_id").isin(*names) | F.col("cluster_id").isNull())
    unnamed = unknown.groupBy("cluster_id").count()
    missing = sorted((r[0] for r in unnamed.limit(20).collect()), key=str)
    if missing:
        raise KeyError(f"{unnamed.count()} cluster ids without a name, among them {missing}")
    pairs = [F.lit(x) for item in names.items() for x in item]
    return df.withColumn(
        "cluster_label", F.element_at(F.create_map(*pairs), F.col("cluster_id"))
    )


# ---- the stage -------------------------------------------------------------


def cluster_corpus(
    df: DataFrame, cfg: AuditConfig, vectors: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """((row_id, cluster_id, cluster_label) of every row, one-row selection record).

    Fits on all rows, or on ``fit_sample`` of them if that is set, and assigns
    every row.  Rows without a usable vector get cluster -1.  Where no vector
    is usable, or all are equal, there is nothing to choose: the record says
    so in ``note``.
    """
    points = stage(hashed_vectors(df, cfg) if vectors is None else vectors, "vectors-dense")
    usable = points.filter(_nonzero())
    dims = F.coalesce(F.unwrap_udt("features")["size"], F.size(F.unwrap_udt("features")["values"]))
    widest = usable.agg(F.max(dims)).first()[0]
    if widest is None:
        out = stage(default_labels(df.select("row_id", F.lit(UNASSIGNED).alias("cluster_id"))), "assigned")
        spark = df.sparkSession
        none = spark.createDataFrame([], "k int, silhouette double")
        lists = spark.createDataFrame([], "cluster_id int, exemplars array<string>")
        return out, selection_record(None, none, lists, out, "no row has a usable vector")
    if widest > cfg.fold_above:
        usable = stage(fold(usable, cfg.fold_dims), "vectors-folded").filter(_nonzero())
    fit_on = usable
    if cfg.fit_sample is not None:
        fit_on = stage(sample_rows(usable, cfg.fit_sample, seed=cfg.seed), "fit-sample")
    best, model, scores = sweep_k(fit_on, cfg)
    note = None
    if best < cfg.k_min:
        note = f"only {len(model.centers)} different vectors: k is {best}"

    members = assign(usable, model)
    every = df.select("row_id").join(members.select("row_id", "cluster_id"), "row_id", "left")
    out = stage(
        default_labels(
            every.withColumn("cluster_id", F.coalesce("cluster_id", F.lit(UNASSIGNED)))
        ),
        "assigned",
    )
    lists = exemplars(df, members, centroid_table(model, df.sparkSession), cfg)
    return out, selection_record(best, scores, lists, out, note)


def attach_clusters(df: DataFrame, clusters: DataFrame) -> DataFrame:
    """Put cluster columns on rows; both sides have unique row ids."""
    return df.drop("cluster_id", "cluster_label").join(clusters, "row_id")


# A selection record read back from JSON, where the keys of maps are text.
SELECTION_JSON = (
    "best_k int, note string, silhouette_by_k map<string,double>, "
    "exemplars map<string,array<string>>, sizes map<string,bigint>"
)


def selection_record(
    best: int | None, scores: DataFrame, lists: DataFrame, clustered: DataFrame, note: str | None = None
) -> DataFrame:
    """Chosen k, silhouette per k, exemplars and sizes per cluster, and what was odd, as one row."""
    sizes = clustered.groupBy("cluster_id").agg(F.count("*").alias("n"))
    # A handful of rows each, stacked and folded into one.
    parts = (
        scores.select(F.struct("k", "silhouette").alias("score"))
        .unionByName(
            lists.select(F.struct(F.col("cluster_id").cast("string"), "exemplars").alias("texts")),
            allowMissingColumns=True,
        )
        .unionByName(
            sizes.select(F.struct("cluster_id", "n").alias("size")), allowMissingColumns=True
        )
    )

    def fold(name: str) -> Column:
        return F.map_from_entries(F.sort_array(F.collect_list(name)))

    return parts.agg(
        F.lit(best).cast("int").alias("best_k"),
        F.lit(note).cast("string").alias("note"),
        fold("score").alias("silhouette_by_k"),
        fold("texts").alias("exemplars"),
        fold("size").alias("sizes"),
    )
