"""Run a batch job: ``spark-submit`` this module, or ``python -m tidemark``."""

from __future__ import annotations

import argparse
import datetime as dt

from .plans import query_tables, star
from .session import build_session, size_of, tune
from .sources import files


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    lake = jobs.add_parser("lake", help="star schema as partitioned Parquet")
    lake.add_argument("--logs", required=True, help="path or glob of JSON activity logs")
    lake.add_argument("--songs", required=True, help="path or glob of JSON songs")
    lake.add_argument("--out", required=True)

    load = jobs.add_parser("load", help="star schema as catalog tables, with the quality gate")
    load.add_argument("--root", required=True, help="folder that holds log_data and song_data")
    load.add_argument("--database", required=True)
    load.add_argument("--variant", choices=("warehouse", "pipeline"), default="pipeline")
    load.add_argument("--run-date", type=dt.date.fromisoformat)

    tables = jobs.add_parser("query-tables", help="keyed query tables from CSV activity logs")
    tables.add_argument("--logs", required=True)
    tables.add_argument("--out", required=True)

    args = parser.parse_args(argv)
    spark = build_session(f"tidemark-{args.job}")
    tune(spark, size_of(spark, args.root if args.job == "load" else args.logs))
    if args.job == "lake":
        star.run_lake(files.read_activity_logs(spark, args.logs),
                      files.read_songs(spark, args.songs), args.out)
    elif args.job == "load":
        star.run_pipeline(spark, args.root, args.database, args.variant, args.run_date)
    else:
        query_tables.run(files.read_activity_csv(spark, args.logs), args.out)


if __name__ == "__main__":
    main()
