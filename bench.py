"""Headline queries, one JSON line.

``audit_fact`` builds the fact table from the raw tables end to end; the views
then read that table, as they would read a loaded one.  Stage timings share
the enriched table.  Every result is fully computed (noop sink).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from chaffsieve.operators import quality as ql
from chaffsieve.operators.cluster import cluster_corpus
from chaffsieve.operators.neardup import near_duplicates
from chaffsieve.plans import queries as q
from chaffsieve.plans.audit import enrich
from chaffsieve.plans.views import VIEWS
from chaffsieve.sources.corpus import corpus_from_documents, corpus_mixed
from chaffsieve.sources.staging import release, stage


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # JVM and Python start-up stay out of the figures.
    spark.range(1000).selectExpr("sum(id)").collect()

    timings: dict[str, float] = {}

    def timed(name, build):
        start = time.perf_counter()
        df = build()
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        return df

    fact = timed("audit_fact", lambda: q.full_build(spark, base))
    for name, view in VIEWS.items():
        timed(name, lambda: view(fact, q.CFG))
    timed("audit_report", lambda: ql.audit_report(fact, q.CFG))

    enriched = timed("enrich", lambda: stage(enrich(corpus_mixed(spark, base), q.CFG), "bench"))
    timed("rule_baseline", lambda: ql.rule_baseline(enriched))
    timed("near_duplicates", lambda: near_duplicates(enriched, q.CFG))
    whole = stage(enrich(corpus_from_documents(spark, base, whole=True), q.CFG), "bench-whole")
    timed("near_duplicates_whole_text", lambda: near_duplicates(whole, q.CFG))
    timed("readability_outliers", lambda: ql.flag_readability_outliers(enriched, q.CFG))
    timed("assign_clusters", lambda: q.QUERIES["assign_clusters"](spark, base))
    timed("fit_kmeans", lambda: q.QUERIES["fit_kmeans"](spark, base))
    timed("sweep_k", lambda: q.QUERIES["sweep_k"](spark, base))
    timed("cluster_corpus", lambda: cluster_corpus(enriched, q.CFG)[0])

    release(spark)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
