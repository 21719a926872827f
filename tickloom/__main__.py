"""Command line: ``spark-submit`` this module, or ``python -m tickloom`` for a local run."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from tickloom.operators.activity import activity_rollup, as_responses
from tickloom.plans import pipeline
from tickloom.plans.ingest import run_ingestion
from tickloom.session import get_session
from tickloom.sources.companies import companies
from tickloom.streaming import follow_corrections, follow_rewritten_files, land_incremental


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tickloom", description=__doc__)
    parser.add_argument("--master", help="Spark master; left to spark-submit by default")
    parser.add_argument("--shuffle-partitions", type=int)
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="land a batch of responses of one source and day")
    ingest.add_argument("responses", help="Parquet with columns ticker, payload")
    ingest.add_argument("root")
    ingest.add_argument("source", choices=("stocks", "polygon", "github"))
    ingest.add_argument("day", help="yyyy-MM-dd")

    activity = jobs.add_parser("activity", help="roll repository facts of one day up by company and land the documents")
    activity.add_argument("facts", help="Parquet with columns ticker, repo, date, stars, forks, commits_today, open_prs")
    activity.add_argument("root")
    activity.add_argument("day", help="yyyy-MM-dd")

    process = jobs.add_parser("process", help="raw documents to the combined dataset")
    process.add_argument("raw_dir")
    process.add_argument("out_dir")
    process.add_argument("--layout", choices=pipeline.LAYOUTS, default="files")
    process.add_argument("--quarantine", help="also write refused rows to this folder")

    publish = jobs.add_parser("publish", help="combined dataset to tables, views and checked marts")
    publish.add_argument("out_dir")

    land = jobs.add_parser("land", help="take in bar files that are new since the last run")
    land.add_argument("raw_dir")
    land.add_argument("out")

    correct = jobs.add_parser("correct", help="keep a bar table current from new files")
    correct.add_argument("raw_dir")
    correct.add_argument("table")
    correct.add_argument("--packed", help="pack the files here first, so that files overwritten under their names count")

    pack = jobs.add_parser("pack", help="pack new and rewritten one-document files of all sources")
    pack.add_argument("raw_dir")
    pack.add_argument("packed_dir")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = get_session(master=args.master, shuffle_partitions=args.shuffle_partitions)
    if args.job == "ingest":
        responses = spark.read.schema("ticker string, payload string").parquet(args.responses)
        print(json.dumps(run_ingestion(spark, responses, args.root, args.source, args.day)))
    elif args.job == "activity":
        facts = spark.read.parquet(args.facts).where(F.col("date") == F.lit(args.day).cast("date"))
        documents = as_responses(activity_rollup(facts, companies(spark), args.day))
        print(json.dumps(run_ingestion(spark, documents, args.root, "github", args.day)))
    elif args.job == "process":
        counts = pipeline.run_processing(spark, args.raw_dir, args.out_dir, layout=args.layout, quarantine=args.quarantine)
        print(json.dumps(counts))
        pipeline.sample(spark, args.out_dir).show(truncate=False)
    elif args.job == "publish":
        pipeline.publish_models(spark, args.out_dir)
    elif args.job == "land":
        land_incremental(spark, args.raw_dir, args.out)
    elif args.job == "pack":
        print(json.dumps(pipeline.pack_sources(spark, args.raw_dir, args.packed_dir)))
    elif args.job == "correct" and args.packed:
        print(json.dumps(follow_rewritten_files(spark, args.raw_dir, args.packed, args.table)))
    elif args.job == "correct":
        follow_corrections(spark, args.raw_dir, args.table)


if __name__ == "__main__":
    main()
