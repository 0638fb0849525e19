"""``python -m tablewright JOB --root FOLDER [--source CSV]``."""

from __future__ import annotations

import argparse
import os

from tablewright.operators.ordering import ranked
from tablewright.plans import jobs
from tablewright.plans.games import ROLLUPS, SAMPLE_COLUMNS
from tablewright.session import build_session
from tablewright.sources.tables import JdbcServer

JOBS = ("ingest", "load", "batch", "increments", "marts", "publish", "export", "cluster")


def main() -> None:
    parser = argparse.ArgumentParser(prog="tablewright")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="folder of all tables")
    parser.add_argument("--source", help="CSV file or folder (ingest, load, batch)")
    parser.add_argument("--increments", type=int, default=5)
    parser.add_argument("--jdbc-url", help="database (publish); password in JDBC_PASSWORD")
    parser.add_argument("--jdbc-user")
    parser.add_argument("--master", help="only outside spark-submit, for example local[8]")
    args = parser.parse_args()
    if args.job in ("ingest", "load", "batch") and not args.source:
        parser.error(f"{args.job} needs --source")
    if args.job == "publish" and not args.jdbc_url:
        parser.error("publish needs --jdbc-url")

    spark = build_session(f"tablewright-{args.job}", args.master)
    layout = jobs.Layout(args.root)
    if args.job == "ingest":
        record = jobs.ingest(spark, args.source, layout)
        if record is None:
            print(f"no CSV files in {args.source}")
        else:
            record.show(truncate=False)
    elif args.job == "load":
        jobs.load_raw(spark, args.source, layout).printSchema()
    elif args.job == "batch":
        tables = jobs.batch(spark, args.source, layout)
        tables.pop("processed").select(*SAMPLE_COLUMNS).show(5, truncate=False)
        for spec in ROLLUPS:
            print(spec.name)
            ranked(tables[spec.name], "total_games", spec.key).show(truncate=False)
    elif args.job == "increments":
        jobs.increments(spark, layout, args.increments).orderBy("batch").show()
    elif args.job == "marts":
        jobs.marts(spark, layout).show()
        jobs.most_profitable(spark, layout).show(truncate=False)
    elif args.job == "publish":
        server = JdbcServer(args.jdbc_url, args.jdbc_user, os.environ.get("JDBC_PASSWORD"))
        jobs.publish(spark, layout, server)
    elif args.job == "export":
        jobs.export(spark, layout)
    else:
        for name, table in jobs.cluster(spark, layout).items():
            print(name)
            table.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
