"""The batch feature run: users in, feature table and run report out."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame

from fluxmill.operators.imputation import cast_users
from fluxmill.operators.profiles import fit_profile, profile_rows
from fluxmill.operators.reports import run_metrics
from fluxmill.plans.feature_table import dealt_partitions, transform
from fluxmill.sources.tables import write_features, write_report
from fluxmill.workspace import scratch


def run_feature_job(
    users: DataFrame, output: str, partitions: int | None = None, mode: str = "distributed"
) -> DataFrame:
    """Write `output`/features and `output`/metrics, and return the run report.

    Input rows come from the profile, output rows from the footers of the written files: neither
    count runs the features again or can count a retried task twice. The profile is scratch, which
    is removed once the features are written.
    """
    spark = users.sparkSession
    started = time.time()
    with scratch(spark, "feature-job"):
        profile = fit_profile(cast_users(users))
        input_rows = profile_rows(profile)
        files = dealt_partitions(partitions, input_rows) if partitions else None
        write_features(transform(users, profile, files, input_rows), f"{output}/features")
        seconds = time.time() - started
    output_rows = spark.read.parquet(f"{output}/features").count()
    report = run_metrics(
        spark, mode, files or spark.sparkContext.defaultParallelism, input_rows, output_rows, seconds
    )
    write_report(report, f"{output}/metrics")
    return report
