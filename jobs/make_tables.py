"""Seeded input tables: spark-submit jobs/make_tables.py users|events --rows N --output DIR"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fluxmill.sources.event_files import write_event_files  # noqa: E402
from fluxmill.sources.synthetic import synth_events, synth_users  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("table", choices=["users", "events"])
    parser.add_argument("--rows", type=int, default=10_000_000)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--output", default="data/")
    parser.add_argument("--partitions", type=int, default=10)
    parser.add_argument("--rate", type=int, default=100, help="events per second of event time")
    parser.add_argument("--start", type=int, default=None, help="first event, epoch seconds (default: now)")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("make-tables").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    keys = spark.range(0, args.rows, 1, args.partitions)
    if args.table == "users":
        synth_users(keys, "id", args.seed).write.mode("overwrite").parquet(args.output)
    else:
        start = int(time.time()) if args.start is None else args.start
        write_event_files(synth_events(keys, "id", start * 1_000_000, args.rate, args.seed), args.output)


if __name__ == "__main__":
    main()
