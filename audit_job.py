"""spark-submit audit_job.py CORPUS OUT [options]"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from chaffsieve import AuditConfig
from chaffsieve.plans.audit import audit, reflag, rename, store_views
from chaffsieve.plans.stored_views import create_views
from chaffsieve.sources.corpus import load_corpus
from chaffsieve.sources.sinks import load_fact_table
from chaffsieve.sources.staging import release


def main() -> None:
    ap = argparse.ArgumentParser(description="Audit an instruction corpus.")
    ap.add_argument("corpus", help="parquet with instruction, input, output")
    ap.add_argument("out", help="folder for stages, reports and views")
    ap.add_argument("--order-key", default="order_key", help="unique column that orders the rows")
    ap.add_argument("--table", default="instruction_corpus", help="catalog table to load")
    ap.add_argument("--limit", type=int, help="first rows only, for a smoke run")
    ap.add_argument("--skip-clustering", action="store_true")
    ap.add_argument("--skip-load", action="store_true")
    ap.add_argument("--append", action="store_true", help="add to the loaded table's rows")
    ap.add_argument("--names", help="JSON map of cluster ids to names: rename a finished audit")
    ap.add_argument("--reflag", action="store_true", help="flag the saved rows of an audit again")
    ap.add_argument("--store-views", metavar="PREFIX", help="also save the views as tables")
    ap.add_argument("--create-views", metavar="PREFIX", help="also create catalog views over the loaded table")
    ap.add_argument("--resume", action="store_true", help="take over the stages a killed run finished")
    args = ap.parse_args()

    spark = SparkSession.builder.appName("corpus-audit").getOrCreate()
    cfg = AuditConfig()
    load = None if args.skip_load else lambda fact: load_fact_table(fact, args.table, not args.append)
    if args.names:
        names = {int(k): v for k, v in json.loads(args.names).items()}
        result = rename(spark, args.out, names, cfg, load=load)
    elif args.reflag:
        result = reflag(spark, args.out, cfg, load=load)
    else:
        raw = load_corpus(spark, args.corpus, args.order_key)
        result = audit(
            raw, args.out, cfg, limit=args.limit, cluster=not args.skip_clustering, load=load, resume=args.resume
        )
    if args.store_views is not None:
        store_views(result.fact, cfg, args.store_views)
    if args.create_views is not None:
        create_views(spark, args.table, cfg, args.create_views)
    result.baseline.show(truncate=False)
    result.report.show(truncate=False, vertical=True)
    for problem in result.problems:
        print(problem)
    for view, status in result.view_status.items():
        print(view, status)
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
