"""The job scripts, run as users run them, and scratch folders."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fluxmill.operators.imputation import cast_users
from fluxmill.plans.feature_table import feature_table
from fluxmill.workspace import new_folder, scratch, stored
from test_load_directories import fill
from test_streaming import event_text, queue

JOBS = Path(__file__).resolve().parents[1] / "jobs"


def submit(script, *arguments, shared):
    flags = "--master local[2] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2"
    flags += f" --conf spark.checkpoint.dir={shared} pyspark-shell"
    done = subprocess.run(
        [sys.executable, str(JOBS / script), *map(str, arguments)],
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": flags},
        capture_output=True,
        text=True,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_feature_job(spark, tmp_path):
    submit("make_tables.py", "users", "--rows", 2000, "--partitions", 2, "--output", tmp_path / "data", shared=tmp_path / "s")
    submit("build_features.py", "--input", tmp_path / "data", "--output", tmp_path / "out", "--partitions", 3, shared=tmp_path / "s")
    users = spark.read.parquet(str(tmp_path / "data"))
    got = spark.read.parquet(str(tmp_path / "out/features"))
    assert got.count() == 2000 and got.columns == feature_table(users).columns
    rounded = lambda df: df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes])
    assert rounded(got).exceptAll(rounded(feature_table(users))).count() == 0
    report = spark.read.json(str(tmp_path / "out/metrics")).first()
    assert (report.input_rows, report.output_rows, report.partitions) == (2000, 2000, 3)
    assert cast_users(users).count() == 2000
    assert not os.listdir(tmp_path / "s/fluxmill")  # scratch is gone


def test_stream_job_and_load_test(tmp_path):
    queue(tmp_path / "queue", [event_text(i) for i in range(6)] + ["{torn"])
    submit(
        "run_stream.py", "--queue-dir", tmp_path / "queue", "--output", tmp_path / "out", "--available", "--recent", 4,
        "--live", shared=tmp_path / "s",
    )
    read = lambda name: [json.loads(x) for p in (tmp_path / name).glob("part-*.json") for x in p.read_text().splitlines()]
    summary = read("out/summary")
    assert [(r["total_processed"], r["total_errors"]) for r in summary] == [(6, 1)]
    assert read("out/window_metrics")[0]["late_count"] == 6
    fill(tmp_path / "load", {100: [1, 2, 3]})
    out = submit("run_stream.py", "--queue-dir", tmp_path / "load", "--output", tmp_path / "lt", "--load-test", "--consume", shared=tmp_path / "s")
    assert "target_rate" in out and [r["processed"] for r in read("lt/load_levels")] == [3]
    assert not os.listdir(tmp_path / "load/load_100")


def test_scratch_goes_however_the_block_ends(spark):
    kept = stored(spark.range(5), "kept")
    with scratch(spark) as folder:
        inside = stored(spark.range(3), "inside")
        assert new_folder(spark, "x").startswith(folder) and inside.count() == 3
    with pytest.raises(ZeroDivisionError):
        with scratch(spark) as second:
            stored(spark.range(3), "inside")
            1 / 0
    assert not os.path.exists(folder) and not os.path.exists(second) and kept.count() == 5
