"""The stages as functions of data frames, and the whole audit."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.operators import clean as _clean
from chaffsieve.operators import cluster as _cluster
from chaffsieve.operators import quality as _quality
from chaffsieve.operators.neardup import flag_near_duplicates
from chaffsieve.operators.sample import review_sample
from chaffsieve.plans.views import VIEWS
from chaffsieve.sources import sinks
from chaffsieve.sources.corpus import limit_rows
from chaffsieve.sources.staging import passing, settle


def enrich(raw: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Stage 1: cleaned, numbered rows with every feature the texts give."""
    return _quality.row_flags(_clean.enrich(raw, cfg), cfg)


# The flags that thresholds decide and one row settles.
ROW_FLAGS = ("flag_truncated", "flag_too_short", "flag_empty_ish", "flag_repetitive")


def flag(df: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Stage 3: near duplicates, flags, score."""
    return _quality.flag_quality(flag_near_duplicates(df, cfg), cfg)


def with_cluster_columns(df: DataFrame) -> DataFrame:
    """Empty cluster columns where clustering was skipped, so that loading works."""
    if "cluster_id" in df.columns:
        return df
    return df.withColumns(
        {"cluster_id": F.lit(None).cast("int"), "cluster_label": F.lit(None).cast("string")}
    )


def build_fact(raw: DataFrame, cfg: AuditConfig, names: dict[int, str] | None = None) -> DataFrame:
    """The staged fact table of a corpus that already carries cluster ids, or none."""
    spark = raw.sparkSession

    def build() -> DataFrame:
        enriched = settle(spark, "enriched", lambda: enrich(raw, cfg))
        if "cluster_id" in enriched.columns:
            enriched = (
                _cluster.default_labels(enriched)
                if names is None
                else _cluster.relabel_clusters(enriched, names)
            )
        return sinks.select_fact(with_cluster_columns(flag(enriched, cfg)))

    return settle(spark, "fact", build)


def missing_module(error: Exception) -> str | None:
    """The message of an import that failed, here or in a task; None for any other error."""
    if isinstance(error, ImportError):
        return str(error)
    raised = re.findall(r"^(?:ModuleNotFoundError|ImportError): (.*)$", str(error), re.M)
    return raised[-1] if raised else None


@dataclass
class AuditResult:
    fact: DataFrame
    report: DataFrame
    baseline: DataFrame
    selection: DataFrame | None = None
    review: DataFrame | None = None
    view_status: dict[str, str] = field(default_factory=dict)
    loaded: int | None = None
    problems: list[str] = field(default_factory=list)
    # Stages that were taken over from an earlier run.
    reused: list[str] = field(default_factory=list)
    # Rows read, kept and dropped, counted while they were cleaned.
    cleaning: dict[str, int] | None = None


def _stage(
    spark: SparkSession, out: str, name: str, key: str, resume: bool, reused: list[str], build: Callable[[], DataFrame]
) -> DataFrame:
    """A saved stage that was made of the same, or a new one."""
    if resume and sinks.made_of(spark, out, name) == key:
        reused.append(name)
        return sinks.read_enriched(spark, out, name)
    with passing(spark):
        return sinks.write_enriched(build(), out, name, key)


def _vectors_key(vectors: DataFrame | Callable | None) -> str | None:
    """What tells vectors apart; None for a function, whose results are not known before it runs."""
    if vectors is None:
        return "hashed"
    if callable(vectors):
        return None
    return sinks.fingerprint(vectors.select("row_id", F.unwrap_udt("features").alias("features")))


def audit(
    raw: DataFrame,
    out: str,
    cfg: AuditConfig,
    limit: int | None = None,
    cluster: bool = True,
    vectors: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    names: dict[int, str] | None = None,
    load: Callable[[DataFrame], int] | None = None,
    views: bool = True,
    resume: bool = False,
) -> AuditResult:
    """All stages, each saved under ``out``, then load and exports.

    With ``resume`` stages that an earlier run finished are taken over if
    they were made of the same rows with the same settings, and everything
    after the first that was not is made anew.  Clusters of vectors from a
    function are never taken over.

    ``vectors`` replaces the hashed text vectors: a frame (row_id, features)
    or a function of the enriched frame that makes one.  If its model is not
    installed, rows are grouped by rule class instead.  ``load`` writes the
    fact table somewhere and returns its row count; a failing load is
    reported and the exports still run.
    """
    problems: list[str] = []
    if limit is not None:
        raw = limit_rows(raw, limit)
    spark, reused = raw.sparkSession, []
    key = sinks.fingerprint(raw, "enriched", repr(cfg))
    observed, counts = _clean.counted(raw)
    df = _stage(spark, out, "enriched", key, resume, reused, lambda: enrich(observed, cfg))
    cleaning = None if reused else counts.get
    baseline = _quality.rule_baseline(df)

    selection = None
    if cluster:
        clusters = None
        try:
            made_with = _vectors_key(vectors)
            of = None if made_with is None else sinks.derived(key, "clusters", made_with)
            if resume and of is not None and sinks.made_of(spark, out, "clusters") == of:
                reused.append("clusters")
                clusters = sinks.read_enriched(spark, out, "clusters")
                selection = spark.read.schema(_cluster.SELECTION_JSON).json(f"{out}/cluster_selection")
            else:
                given = vectors(df) if callable(vectors) else vectors
                if given is not None:
                    given.limit(1).collect()  # a model loads in a task, and may not be there
        except Exception as error:
            missing = missing_module(error)
            if missing is None:
                raise
            problems.append(f"clustering skipped: {missing}")
        else:
            if clusters is None:
                clusters, selection = _cluster.cluster_corpus(df, cfg, given)
                sinks.write_json(selection, f"{out}/cluster_selection")
                # Saved narrow; the texts are joined and written once, with the flags.
                of = of or sinks.derived(key, "clusters", uuid.uuid4().hex)
                clusters = sinks.write_enriched(clusters, out, "clusters", of)
            note = selection.first()["note"]
            if note is not None:
                problems.append(f"clustering: {note}")
            if names is not None:
                clusters = _named(clusters, names)
                save_names(spark, out, names)
            key = of
            df = _cluster.attach_clusters(df, clusters)

    elif "cluster_id" in df.columns:
        # The corpus brought its clusters along.
        df = _cluster.default_labels(df) if names is None else _cluster.relabel_clusters(df, names)

    flagged = sinks.derived(key, "flagged", repr(sorted((names or {}).items())))
    result = _report(lambda: flag(df, cfg), "flagged", out, cfg, load, views, flagged, resume, reused, spark)
    result.baseline, result.selection, result.reused, result.cleaning = baseline, selection, reused, cleaning
    result.problems[:0] = problems
    return result


def save_names(spark: SparkSession, out: str, names: dict[int, str]) -> None:
    """Keep names beside the clusters they are for: later stages of the same clusters use them."""
    rows = spark.createDataFrame(sorted(names.items()), "cluster_id int, cluster_label string")
    sinks.write_enriched(rows, out, "cluster_names", sinks.made_of(spark, out, "clusters"))


def saved_names(spark: SparkSession, out: str) -> dict[int, str] | None:
    """The names given to the saved clusters; None if there are none, or they are for other clusters."""
    of = sinks.made_of(spark, out, "cluster_names")
    if of is None or of != sinks.made_of(spark, out, "clusters"):
        return None
    # A row per cluster.
    return {r["cluster_id"]: r["cluster_label"] for r in sinks.read_enriched(spark, out, "cluster_names").collect()}


def _named(df: DataFrame, names: dict[int, str] | None) -> DataFrame:
    return df if names is None else _cluster.relabel_clusters(df, names)


def _report(
    build: Callable[[], DataFrame],
    stage_name: str,
    out: str,
    cfg: AuditConfig,
    load: Callable[[DataFrame], int] | None,
    views: bool,
    key: str,
    resume: bool,
    reused: list[str],
    spark: SparkSession,
) -> AuditResult:
    """Save flagged rows as a stage, then everything that is derived from them."""
    df = _stage(spark, out, stage_name, key, resume, reused, build)
    report = _quality.audit_report(df, cfg)
    sinks.write_json(report, f"{out}/audit_summary")
    review = review_sample(df, cfg)
    sinks.write_review_csv(review, f"{out}/review_sample")
    sinks.write_sample_csv(df, f"{out}/enriched_sample", cfg)

    fact = sinks.select_fact(with_cluster_columns(df))
    result = AuditResult(fact, report, _quality.rule_baseline(df), review=review)
    if load is not None:
        try:
            result.loaded = load(fact)
        except Exception as error:
            result.problems.append(f"load failed: {error}")
    if views:
        result.view_status = sinks.export_views(fact, VIEWS, f"{out}/views", cfg)
    return result


def rename(
    spark: SparkSession,
    out: str,
    names: dict[int, str],
    cfg: AuditConfig,
    load: Callable[[DataFrame], int] | None = None,
    views: bool = True,
) -> AuditResult:
    """Name the clusters of a finished audit: nothing is fitted or flagged again.

    Names usually come from reading the exemplars.  They are kept beside the
    clusters, so that flagging again keeps them.  The renamed rows are a
    stage of their own, since the flagged ones are read meanwhile; reports,
    samples and views are written anew.
    """
    df = sinks.read_enriched(spark, out, "flagged")
    renamed = _cluster.relabel_clusters(df, names)
    key = sinks.derived(sinks.made_of(spark, out, "flagged") or "", "renamed", repr(sorted(names.items())))
    result = _report(lambda: renamed, "renamed", out, cfg, load, views, key, False, [], spark)
    save_names(spark, out, names)
    return result


def reflag(
    spark: SparkSession,
    out: str,
    cfg: AuditConfig,
    load: Callable[[DataFrame], int] | None = None,
    views: bool = True,
) -> AuditResult:
    """Flag the saved rows of an audit again, with other thresholds: features and clusters stay."""
    df = sinks.read_enriched(spark, out, "enriched")
    key = sinks.made_of(spark, out, "enriched") or ""
    if sinks.has_stage(spark, out, "clusters"):
        clusters = _named(sinks.read_enriched(spark, out, "clusters"), saved_names(spark, out))
        df = _cluster.attach_clusters(df, clusters)
        key = sinks.made_of(spark, out, "clusters") or ""
    kept = [c for c in df.columns if c not in ROW_FLAGS]
    again = df.select(*kept)
    flagged = sinks.derived(key, "flagged again", repr(cfg))
    return _report(lambda: flag(again, cfg), "flagged", out, cfg, load, views, flagged, False, [], spark)


def store_views(fact: DataFrame, cfg: AuditConfig, prefix: str = "") -> list[str]:
    """The views as tables of the session's catalog, readable by name in later sessions.

    ``prefix`` may name a database, with its dot; temporary views of a session
    hide tables of the same name.
    """
    names = []
    for name, view in VIEWS.items():
        view(fact, cfg).write.mode("overwrite").saveAsTable(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names
