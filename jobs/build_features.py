"""Feature job: spark-submit jobs/build_features.py --input DIR --output DIR [--partitions N]

Master, memory and parallelism are submit flags.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fluxmill.plans.feature_job import run_feature_job  # noqa: E402
from fluxmill.sources.tables import read_users  # noqa: E402


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", default="data/", help="parquet directory of users")
    parser.add_argument("--output", default="output/", help="receives features/ and metrics/")
    parser.add_argument("--partitions", type=int, default=None, help="balance the output into N files, more for a large table (a shuffle)")
    parser.add_argument("--mode", default="distributed", help="label for the run report")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("feature-table").getOrCreate()
    report = run_feature_job(read_users(spark, args.input), args.output, args.partitions, args.mode)
    report.show(truncate=False)


if __name__ == "__main__":
    main()
