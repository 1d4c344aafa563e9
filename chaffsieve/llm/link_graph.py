"""URL rules, and propagation over the host graph where no rule speaks.

Pages judged by a rule are the seeds: an allowed page trusts its host, a
blocked page distrusts it.  Trust is a personalised PageRank along links, from
linking to linked host; distrust is the same walk over reversed links, so a
host that links to blocked ones is distrusted.  Both are in units of seed
pages.  A page without a rule is blocked if its host's distrust exceeds its
trust, else allowed.

Edges are the absolute links of the pages' HTML, counted per pair of hosts,
and, in both directions, the step from a host to the crawled host one label up
(www.a.example.com and a.example.com).  Everything after the link extraction
is one row per host or edge.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count
from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chaffsieve.llm.tables import meet
from chaffsieve.sources.staging import stage

DAMPING = 0.85
TOLERANCE = 1e-3  # of the seed mass that may still move in a step
STEPS_PER_TABLE = 5  # joins between two written tables
THRESHOLD = 1.0  # distrust per trust from which a host is blocked

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    """A host, a path its pages' paths begin with, and ``allow`` or ``block``."""

    host: str
    path: str
    verdict: str


def _rest(url: Column) -> Column:
    """What follows the first ``://``; NULL if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(host: Column) -> Column:
    """The node of the graph a host stands for: without the user and the port it may be written with."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")


def _suffixes(host: Column) -> Column:
    """a.b.c, b.c, c."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def _ruled(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """(page_id, host, path, rule, ruled): the longest fitting rule and its verdict, or NULLs."""
    spark = pages.sparkSession
    judged = pages.select(
        F.col("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    table = spark.createDataFrame(
        [(r.host, r.path, r.host + r.path, r.verdict) for r in rules],
        "suffix string, rule_path string, rule string, verdict string",
    )
    hosts = judged.select("host").distinct()
    # Rules are met by host, once per host and suffix; a page then tries its host's.
    fitting = (
        hosts.withColumn("suffix", F.explode(_suffixes(F.col("host"))))
        .join(table, "suffix")
        .groupBy("host")
        .agg(
            F.array_sort(
                F.collect_list(F.struct((-F.length("rule")).alias("order"), "rule", "rule_path", "verdict"))
            ).alias("rules")
        )
    )
    judged = meet(judged, stage(fitting, "host-rules"), ["host"], "left")
    best = F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"]))
    judged = judged.withColumn("best", F.try_element_at(best, F.lit(1)))
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("ruled"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target, links) between different crawled hosts, users and ports left out."""
    here = node_of(host_of(F.col("url"))).alias("source")
    hosts = stage(pages.select(here).distinct().filter("source <> ''"), "hosts")
    known = hosts.withColumnRenamed("source", "target")
    found = pages.select(
        here, F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)))).alias("target")
    )
    found = found.select("source", F.translate(node_of(F.col("target")), _UPPER, _LOWER).alias("target"))
    links = found.filter("source <> '' AND source <> target").groupBy("source", "target").agg(
        F.count("*").alias("links")
    )
    links = meet(links, known, ["target"], "left_semi").select("source", "target", "links")
    parent = F.expr("substring(source, instr(source, '.') + 1)")
    up = hosts.filter(F.instr("source", ".") > 0).select("source", parent.alias("target"))
    up = meet(up, known, ["target"], "left_semi").select("source", "target", F.lit(1).cast("bigint").alias("links"))
    down = up.select(F.col("target").alias("source"), F.col("source").alias("target"), "links")
    return links.union(up).union(down).groupBy("source", "target").agg(F.sum("links").alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) from ``edges`` and ``seeds`` (host, allowed, blocked).

    Trust walks along links, distrust against them; what reaches a host
    without a way on is dropped, so the sums never exceed the seeds.  Steps
    repeat until every host that can be reached has been, and as often as
    damping needs to bring any mass down to TOLERANCE of itself.  Neither looks
    at sums over all hosts, so seeds elsewhere do not end a walk early.
    """
    ways = edges.select("source", "target", "links", F.lit("trust").alias("kind")).union(
        edges.select(F.col("target"), F.col("source"), "links", F.lit("distrust"))
    )
    out = ways.groupBy("source", "kind").agg(F.sum("links").alias("out"))
    ways = meet(ways, stage(out, "out-links"), ["source", "kind"])
    ways = stage(
        ways.select(
            F.col("source").alias("host"), "kind", "target", (F.col("links") / F.col("out")).alias("share")
        ),
        "ways",
    )
    start = seeds.select("host", F.lit("trust").alias("kind"), F.col("allowed").cast("double").alias("mass"))
    start = start.union(seeds.select("host", F.lit("distrust"), F.col("blocked").cast("double")))
    start = stage(start.filter("mass > 0"), "seeds")
    steps = ceil(log(TOLERANCE) / log(damping))
    reached = start.count()

    # The walk as a sum over its length: each step moves a shrinking mass on.
    moving = start
    arrived = [start.withColumn("mass", F.col("mass") * (1 - damping))]
    for at in count():
        moving = (
            moving.join(ways, ["host", "kind"])
            .groupBy(F.col("target").alias("host"), "kind")
            .agg(F.sum(F.col("mass") * F.col("share") * damping).alias("mass"))
        )
        if at % STEPS_PER_TABLE == STEPS_PER_TABLE - 1:
            moving = stage(moving, "moving")
        arrived.append(moving.withColumn("mass", F.col("mass") * (1 - damping)))
        if at % STEPS_PER_TABLE == STEPS_PER_TABLE - 1:
            together = arrived[0]
            for more in arrived[1:]:
                together = together.unionByName(more)
            arrived = [stage(together.groupBy("host", "kind").agg(F.sum("mass").alias("mass")), "arrived")]
            # Hosts are reached in order of distance: none within a table's steps, none later.
            before, reached = reached, arrived[0].count()
            if moving.isEmpty() or (at + 1 >= steps and reached == before):
                break
    together = arrived[0]
    for more in arrived[1:]:
        together = together.unionByName(more)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0.0))
    return together.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))


def judge(pages: DataFrame, rules: list[Rule], threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict.

    A rule fits its host and all subdomains if the path begins with the
    rule's; the longest host and path together win.  Hosts that differ in a
    port are one in the graph, and apart for rules and in the result.  A NULL url, or one
    without ``://``, has an empty host and path, no rule, and is allowed: no
    host speaks against it.  A NULL html has no links.  Rows are judged one by
    one, repeated rows count as seeds of their own; an empty table gives no
    rows; other columns are ignored.
    """
    ruled = _ruled(pages, rules).withColumn("node", node_of(F.col("host")))
    seeds = ruled.filter("node <> ''").groupBy(F.col("node").alias("host")).agg(
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"),
    )
    mass = propagate(stage(host_edges(pages), "edges"), stage(seeds, "host-seeds"))
    bad = stage(mass.filter(F.col("distrust") > F.col("trust") * threshold).select(F.col("host").alias("node"), F.lit("block").alias("spread")), "blocked-hosts")
    return meet(ruled, bad, ["node"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "spread", F.lit("allow")).alias("verdict")
    )
