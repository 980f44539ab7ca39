"""Sketched window reports and recent latencies on streams against exact ones."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

import bruteforce
from eventdata import START_US, frame, random_events
from fluxmill.operators import reports
from fluxmill.operators import windows as W
from fluxmill.plans import queries, stream_job
from fluxmill.schemas import EVENT_LOG
from fluxmill.streaming import published, recent, rollup, sketches
from fluxmill.workspace import new_folder
from test_streaming import event_text, queue


def large_window(count=60_000, seed=3):
    draw = random.Random(seed)
    shape = random_events(1)[0]
    rows = []
    for i in range(count):
        lag = int(draw.expovariate(1 / 300_000))
        event = START_US + draw.randrange(20_000_000)
        user = draw.randrange(40_000) if i % 50 else None
        rows.append({**shape, "event_id": i, "user_id": user, "event_us": event, "receive_us": event + lag})
    return rows


def test_errors_stay_within_the_stated_bounds(spark):
    rows = large_window()
    table = frame(spark, rows).repartition(12).persist()
    path = new_folder(spark, "test-sketches")
    sketches.start_sketches(spark, path)
    for part in range(6):
        batch = rollup.batch_rows(table.where(F.col("event_id") % 6 == part), 3600, 10)
        for _ in range(1 + part % 2):  # some batches twice
            sketches.add_batch(batch, path, part)
        sketches.compact(spark, path, part, fanout=2)
    got = sketches.read_windows(spark, path, 3600).collect()
    want = bruteforce.windows(rows, 3600, 10)
    assert len(got) == len(want) == 1
    exact = next(iter(want.values()))
    assert (got[0].message_count, got[0].late_count) == (exact["message_count"], exact["late_count"])
    assert got[0].latency_max_ms == exact["latency_max_ms"]
    assert abs(got[0].unique_users - exact["unique_users"]) <= sketches.USER_ERROR * exact["unique_users"]
    latencies = sorted(r["receive_us"] - r["event_us"] for r in rows)
    for percent in (50, 95, 99):
        at = getattr(got[0], f"latency_p{percent}_ms") * 1000
        rank = sum(x <= at for x in latencies) / len(latencies)
        assert abs(rank - percent / 100) <= sketches.RANK_ERROR
    assert sketches.read_table(spark, path, "sketches").count() <= 12  # few rows, however many events
    assert abs(sketches.distinct_users(spark, [path]).first()[0] - exact["unique_users"]) <= sketches.USER_ERROR * 40_000
    table.unpersist()


def test_few_users_are_exact_over_windows_and_runs(spark):
    rows = random_events(300, span_sec=200)
    paths = []
    for run in range(2):
        path = new_folder(spark, "test-sketch-run")
        paths.append(path)
        sketches.start_sketches(spark, path)
        for part in range(3):
            mine = [r for r in rows if r["event_id"] % 6 == 3 * run + part]
            sketches.add_batch(rollup.batch_rows(frame(spark, mine), 30, 10), path, part)
    good = [r for r in rows if not bruteforce.late(r, 30, 10)]
    assert sketches.distinct_users(spark, paths).first()[0] == len({r["user_id"] for r in good})


def test_sketched_summary(spark):
    rows = random_events(400, span_sec=300, ahead=True)
    path = new_folder(spark, "test-sketch-summary")
    sketches.start_sketches(spark, path)
    for part in range(3):
        mine = frame(spark, [r for r in rows if r["event_id"] % 3 == part])
        sketches.add_batch(rollup.batch_rows(mine), path, part)
    got = sketches.read_summary(spark, path).first().asDict()
    want = reports.stream_summary(frame(spark, rows), 1).first().asDict()
    # So few latencies are kept whole: the sketch takes a neighbouring rank at most.
    latencies = sorted((r["receive_us"] - r["event_us"]) / 1000 for r in rows)
    for percent in (50, 95, 99):
        at = got.pop(f"latency_p{percent}_ms")
        want.pop(f"latency_p{percent}_ms")
        rank = int(len(latencies) * percent / 100)
        assert latencies[rank - 2] - 0.01 <= at <= latencies[rank + 1] + 0.01
    assert got == want
    empty = new_folder(spark, "test-sketch-none")
    sketches.start_sketches(spark, empty)
    assert sketches.read_summary(spark, empty).first().total_processed == 0
    assert sketches.read_windows(spark, empty).count() == 0


def test_recent_latencies_over_batches_and_replays(spark):
    rows = random_events(300)
    rows += [{**r, "event_id": 1000 + r["event_id"]} for r in rows[:40]]  # equal receive times
    path = new_folder(spark, "test-recent")
    recent.start_recent(spark, path)
    for part in range(7):
        batch = frame(spark, [r for r in rows if r["event_id"] % 7 == part])
        recent.add_batch(batch, path, part, 25)
        if part in (2, 5):
            recent.add_batch(batch, path, part, 25)
        recent.compact(spark, path, part, 25, fanout=2)
    got = [(r.event_id, r.receive_us, r.latency_us) for r in recent.read_recent(spark, path, 25).collect()]
    order = sorted(rows, key=lambda r: (-r["receive_us"], [-ord(c) for c in str(r["event_id"])]))
    latest = sorted(((r["receive_us"], str(r["event_id"])) for r in rows), reverse=True)[:25]
    assert [(r, e) for e, r, _ in got] == latest and len(order) == 340


def test_stream_run_with_sketches_and_recent_rows(spark, tmp_path):
    queue(tmp_path / "q", [event_text(i) for i in range(8)] + ["{torn"])
    run = stream_job.StreamRun(str(tmp_path / "q"), str(tmp_path / "out"), exact=False, recent_rows=3)
    stream_job.run_available(spark, run)
    row = stream_job.summary(spark, run).first()
    assert (row.total_processed, row.total_errors) == (8, 1) and row.latency_p50_ms > 0
    assert recent.read_recent(spark, run.path("recent"), 3).count() == 3
    report = spark.read.json(run.path("window_metrics")).first()
    assert report.late_count == 8


@pytest.mark.parametrize("name", ["stream_recent_summary", "stream_recent_latency"])
def test_rows_of_a_batch_are_made_once_for_all_tables(spark, tmp_path, monkeypatch, name):
    start = datetime.datetime(2024, 1, 1)
    log = [
        (i, None if i % 13 == 2 else start + datetime.timedelta(minutes=7 * i), i % 5, "click", 1.0, None) for i in range(120)
    ]
    spark.createDataFrame([*log, (None, None, None, None, None, None)], EVENT_LOG).write.parquet(f"{tmp_path}/events.parquet")
    held, seen = [], []
    for module in (rollup, recent):

        def spied(rows, *rest, add=module.add_batch):
            held.append(rows.storageLevel.useMemory)
            seen.append(rows)
            return add(rows, *rest)

        monkeypatch.setattr(module, "add_batch", spied)
    result = queries.REGISTRY[name](spark, str(tmp_path)).collect()
    assert held == [True] * 2 * queries.STREAM_PARTS
    assert not any(rows.storageLevel.useMemory for rows in seen)  # and are let go
    if name == "stream_recent_summary":
        assert result[0].total_processed + result[0].total_errors == 121
    else:
        assert len(result) == 110  # those with a receive time


def test_published_windows_from_sketches(spark):
    rows = sorted(random_events(300, span_sec=300), key=lambda r: r["receive_us"])
    path = new_folder(spark, "test-sketch-published")
    sketches.start_sketches(spark, f"{path}/tables")
    published.start_published(spark, f"{path}/published")
    for number in range(3):
        batch = rollup.batch_rows(frame(spark, rows[number * 100 : number * 100 + 100]), 30, 10).persist()
        sketches.add_batch(batch, f"{path}/tables", number)
        published.publish_batch(batch, f"{path}/tables", f"{path}/published", number, 30, 10, exact=False)
        batch.unpersist()
    clock = rows[-1]["receive_us"]
    want = {k: v for k, v in bruteforce.windows(rows, 30, 10).items() if (k + 60) * 1_000_000 <= clock}
    got = published.read_published(spark, f"{path}/published").withColumn("start", F.unix_seconds(F.to_timestamp("window_start")))
    for r in got.collect():
        exact = want.pop(r.start)
        assert (r.message_count, r.late_count, r.unique_users) == (exact["message_count"], exact["late_count"], exact["unique_users"])
        assert r.latency_max_ms == exact["latency_max_ms"]
    assert not want


def test_window_report_of_no_accepted_event(spark):
    rows = [{**r, "receive_us": r["event_us"] + 10**9} for r in random_events(20)]
    path = new_folder(spark, "test-sketch-late")
    sketches.start_sketches(spark, path)
    sketches.add_batch(rollup.batch_rows(frame(spark, rows), 30, 10), path, 0)
    text = F.to_json("event_counts")
    got = sketches.read_windows(spark, path, 30).withColumn("event_counts", text)
    assert got.exceptAll(W.window_metrics(frame(spark, rows), 30, 10).withColumn("event_counts", text)).count() == 0
