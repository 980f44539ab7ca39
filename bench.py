"""Timed headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the driver's tables   (default /root/testdata/sf0.1)
BENCH_CPUS    local worker threads            (default 8)
BENCH_ROWS    rows of the feature job at published scale, 0 to leave it out (default 10,000,000)
BENCH_EVENTS  JSON events of the stream job, 0 to leave it out (default 100,000)
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fluxmill.operators.imputation import cast_users  # noqa: E402
from fluxmill.operators.profiles import fit_profile  # noqa: E402
from fluxmill.plans.feature_table import transform  # noqa: E402
from fluxmill.plans.queries import REGISTRY  # noqa: E402
from fluxmill.plans.stream_job import StreamRun, run_available  # noqa: E402
from fluxmill.sources.event_files import write_event_files  # noqa: E402
from fluxmill.sources.synthetic import synth_events, synth_users  # noqa: E402
from fluxmill.sources.tables import read_users, write_features  # noqa: E402
from fluxmill.workspace import new_folder  # noqa: E402

QUERIES = [
    "impute_mean",
    "region_profile",
    "minmax_norm",
    "feature_table",
    "parse_events",
    "dedup_events",
    "window_counts",
    "window_unique_users",
    "window_latency_pct",
    "window_metrics",
    "stream_summary",
    "load_levels",
    "backlog_depth",
    "stream_window_metrics",
    "stream_window_exact",
]
BASELINE_FEATURE_SEC = 189.990


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_to_end(df: DataFrame) -> None:
    """Evaluate every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], None]) -> float:
    started = time.perf_counter()
    action()
    return round(time.perf_counter() - started, 3)


def folder_mb(path: str) -> float:
    return round(sum(f.stat().st_size for f in Path(path).rglob("*.parquet")) / 1e6, 1)


def feature_scale(spark: SparkSession, rows: int, cpus: int) -> dict:
    """The feature job at the scale of the published numbers, by stage, with data sizes."""
    folder = new_folder(spark, "bench-users")

    def generate() -> None:
        synth_users(spark.range(0, rows, 1, 2 * cpus), "id").write.parquet(f"{folder}/users")

    def fit() -> None:
        fitted.append(fit_profile(cast_users(read_users(spark, f"{folder}/users"))))

    def transform_write() -> None:
        write_features(transform(read_users(spark, f"{folder}/users"), fitted[0]), f"{folder}/features")

    fitted = []
    stages = {
        "generate_sec": timed(generate),
        "fit_sec": timed(fit),
        "transform_write_sec": timed(transform_write),
        "recount_sec": timed(lambda: spark.read.parquet(f"{folder}/features").count()),
    }
    job_sec = round(stages["fit_sec"] + stages["transform_write_sec"] + stages["recount_sec"], 3)
    return {
        "rows": rows,
        **stages,
        "feature_job_sec": job_sec,
        "rows_per_sec": round(rows / job_sec),
        "input_mb": folder_mb(f"{folder}/users"),
        "output_mb": folder_mb(f"{folder}/features"),
        "baseline_feature_job_sec_10m": BASELINE_FEATURE_SEC,
    }


def stream_scale(spark: SparkSession, events: int, cpus: int) -> dict:
    """The stream job over a directory of JSON events, all branches and reports included."""
    folder = new_folder(spark, "bench-events")
    start_us = int(time.time()) * 1_000_000 - events * 1_000
    keys = spark.range(0, events, 1, 2 * cpus)
    write_event_files(synth_events(keys, "id", start_us, 1000), f"{folder}/queue")
    run = StreamRun(f"{folder}/queue", f"{folder}/out", glob="part-*.json")
    seconds = timed(lambda: run_available(spark, run))
    return {"events": events, "stream_job_sec": seconds, "events_per_sec": round(events / seconds)}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rows = int(os.environ.get("BENCH_ROWS", "10000000"))
    events = int(os.environ.get("BENCH_EVENTS", "100000"))
    spark = session(cpus)

    seconds = {}
    for name in QUERIES:
        def once(query=REGISTRY[name]) -> None:
            run_to_end(query(spark, folder))

        once()  # class loading and JIT
        seconds[name] = timed(once)

    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    if rows:
        result["feature_job"] = feature_scale(spark, rows, int(cpus))
    if events:
        result["stream_job"] = stream_scale(spark, events, int(cpus))
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
