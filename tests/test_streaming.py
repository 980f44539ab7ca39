import json
import os

import pytest
from pyspark.sql import functions as F

import bruteforce
from eventdata import EVENT_ROWS, START_US, frame, random_events
from fluxmill.operators import reports
from fluxmill.operators import windows as W
from fluxmill.operators.dedup import stream_dedup
from fluxmill.plans import stream_job
from fluxmill.sources import event_files as EF
from fluxmill.streaming import asides, rollup
from fluxmill.streaming import windows as live
from fluxmill.streaming.progress import progress_rows
from test_windows import assert_windows
from fluxmill.workspace import new_folder


def write_file(spark, path, rows):
    frame(spark, rows).coalesce(1).write.mode("append").parquet(path)


def receive_ordered(spark, path, rows, files):
    ordered = sorted(rows, key=lambda r: r["receive_us"])
    size = -(-len(ordered) // files)
    for i in range(files):
        write_file(spark, path, ordered[i * size : (i + 1) * size])


def source(spark, path, per_trigger=1):
    return spark.readStream.schema(EVENT_ROWS).option("maxFilesPerTrigger", per_trigger).parquet(path)


def run_live(spark, path, window_sec, max_lag, ahead_sec=0, writer=live.updates_writer):
    aggregates = live.window_aggregates(source(spark, f"{path}/in"), window_sec, max_lag, ahead_sec)
    return live.run_available(writer(aggregates, f"{path}/out", f"{path}/checkpoint"))


def assert_live(spark, path, expected):
    rows = {r.window_start_s: r for r in live.read_windows(spark, f"{path}/out").collect()}
    expected = {k: v for k, v in expected.items() if v["message_count"]}
    assert rows.keys() == expected.keys()
    for start, want in expected.items():
        got = rows[start]
        assert got.message_count == want["message_count"]
        assert got.latency_max_ms == want["latency_max_ms"]
        assert got.n_click == want["event_counts"].get("click", 0)
        assert got.n_unknown == want["event_counts"].get("unknown", 0)
        assert got.n_other == want["event_counts"].get("refund", 0)
        assert got.total_cart_value == pytest.approx(want["total_cart_value"], abs=0.0101)
        assert abs(got.unique_users_approx - want["unique_users"]) <= 2
        assert got.latency_p50_ms_approx == pytest.approx(want["latency_p50_ms"], rel=0.5, abs=2000)


@pytest.mark.parametrize("max_lag", [10, 100])  # below and above the window size
def test_live_windows_equal_batch_over_many_micro_batches(spark, max_lag):
    rows = random_events(400, span_sec=400)
    path = new_folder(spark, "test-live")
    receive_ordered(spark, f"{path}/in", rows, 8)
    run_live(spark, path, 30, max_lag)
    assert_live(spark, path, bruteforce.windows(rows, 30, max_lag))


def test_live_windows_across_a_restart(spark):
    rows = sorted(random_events(300, span_sec=300), key=lambda r: r["receive_us"])
    path = new_folder(spark, "test-restart")
    write_file(spark, f"{path}/in", rows[:140])
    run_live(spark, path, 30, 10)
    write_file(spark, f"{path}/in", rows[140:])
    run_live(spark, path, 30, 10)
    assert_live(spark, path, bruteforce.windows(rows, 30, 10))


def test_closed_windows_are_emitted_once_and_complete(spark):
    rows = random_events(400, span_sec=400)
    path = new_folder(spark, "test-closed")
    receive_ordered(spark, f"{path}/in", rows, 6)
    run_live(spark, path, 30, 10, writer=live.closed_writer)
    versions = spark.read.parquet(f"{path}/out")
    assert versions.groupBy("window_start_s").count().where("count > 1").count() == 0
    expected = bruteforce.windows(rows, 30, 10)
    last = max(r["event_us"] for r in rows if not bruteforce.late(r, 30, 10)) / 1e6
    closed = {k: v for k, v in expected.items() if v["message_count"] and k + 30 <= last - 30}
    got = {r.window_start_s: r.message_count for r in versions.collect()}
    assert got == {k: v["message_count"] for k, v in closed.items()}


def test_a_stamp_from_the_future_does_not_push_others_out(spark):
    rows = random_events(200, span_sec=200)
    stray = {**rows[0], "event_id": 999, "event_us": START_US + 10**12}
    path = new_folder(spark, "test-ahead")
    receive_ordered(spark, f"{path}/in", [*rows, stray], 4)
    run_live(spark, path, 30, 10)
    assert_live(spark, path, bruteforce.windows(rows, 30, 10))
    aside = asides.set_aside(frame(spark, [*rows, stray]), 30, 10)
    assert [r.event_id for r in aside.where("reason = 'ahead'").collect()] == [999]


def test_rollup_equals_batch_exactly(spark):
    rows = random_events(500, span_sec=300, ahead=True)
    path = new_folder(spark, "test-rollup")
    receive_ordered(spark, f"{path}/in", rows, 5)
    live.run_available(rollup.rollup_writer(source(spark, f"{path}/in"), f"{path}/out", f"{path}/cp", 30, 10))
    got = rollup.read_windows(spark, f"{path}/out", 30)
    assert_windows(got, bruteforce.windows(rows, 30, 10))
    batch = W.window_metrics(frame(spark, rows), 30, 10)
    text = F.to_json("event_counts")
    assert got.withColumn("event_counts", text).exceptAll(batch.withColumn("event_counts", text)).count() == 0
    assert rollup.read_summary(spark, f"{path}/out").collect() == reports.stream_summary(frame(spark, rows), 1).collect()


def test_late_rows_are_kept(spark):
    rows = random_events(300, span_sec=200)
    path = new_folder(spark, "test-late")
    receive_ordered(spark, f"{path}/in", rows, 3)
    late_rows = asides.set_aside(source(spark, f"{path}/in"), 30, 10)
    live.run_available(asides.append_writer(late_rows, f"{path}/out", f"{path}/cp"))
    got = {r.window_start_s: r.late_count for r in asides.late_per_window(spark.read.parquet(f"{path}/out")).collect()}
    assert got == {k: v["late_count"] for k, v in bruteforce.windows(rows, 30, 10).items() if v["late_count"]}


def test_dedup_across_micro_batches(spark):
    rows = random_events(60, span_sec=60, max_lag_sec=1)
    replays = [{**r, "receive_us": r["receive_us"] + 5_000_000} for r in rows[::3]]
    replays += [rows[0]] * 40
    path = new_folder(spark, "test-dedup")
    receive_ordered(spark, f"{path}/in", rows + replays, 4)
    unique = stream_dedup(source(spark, f"{path}/in"), 600).select("event_id")
    live.run_available(asides.append_writer(unique, f"{path}/out", f"{path}/cp"))
    assert sorted(r.event_id for r in spark.read.parquet(f"{path}/out").collect()) == [r["event_id"] for r in rows]


def test_stream_dedup_keeps_events_without_an_id(spark):
    rows = [{**r, "event_id": None} for r in random_events(6)]
    path = new_folder(spark, "test-dedup-null")
    receive_ordered(spark, f"{path}/in", rows, 2)
    unique = stream_dedup(source(spark, f"{path}/in"), 600).select("event_us")
    live.run_available(asides.append_writer(unique, f"{path}/out", f"{path}/cp"))
    assert spark.read.parquet(f"{path}/out").count() == 6


def test_stream_run_with_dedup(spark, tmp_path):
    queue(tmp_path / "q", [event_text(i % 4) for i in range(10)] + ["{torn", "{torn"])
    run = stream_job.StreamRun(str(tmp_path / "q"), str(tmp_path / "out"), dedup_sec=60)
    stream_job.run_available(spark, run)
    row = stream_job.summary(spark, run).first()
    assert (row.total_processed, row.total_errors) == (4, 2)


def test_progress_rows(spark):
    path = new_folder(spark, "test-progress")
    receive_ordered(spark, f"{path}/in", random_events(40), 2)
    got = progress_rows(spark, run_live(spark, path, 30, 10)).collect()
    assert sum(r.num_input_rows for r in got) == 40 and any(r.state_rows for r in got)


def event_text(i, stamp="2024-01-02T03:04:05Z"):
    return json.dumps(dict(event_id=f"e{i}", user_id=i % 3, event_type="click", timestamp=stamp, session_time=1.5,
                           page_views=3, clicks=1, cart_value=0.0, device_type="mobile", region="east", income=1.0))


def queue(folder, values, start=0):
    folder.mkdir(parents=True, exist_ok=True)
    for i, text in enumerate(values, start):
        (folder / f"evt_{i:010d}.json").write_text(text)


def test_stream_run_over_event_files(spark, tmp_path):
    queue(tmp_path / "q", [event_text(i) for i in range(6)] + ['{"event_id": "torn', event_text(9, "bad")])
    run = stream_job.StreamRun(str(tmp_path / "q"), str(tmp_path / "out"))
    stream_job.run_available(spark, run)
    first = spark.read.json(run.path("summary")).first()
    assert (first.total_processed, first.total_errors) == (6, 2)
    queue(tmp_path / "q", [event_text(20)], start=100)
    stream_job.run_available(spark, run)
    second = spark.read.json(run.path("summary")).first()
    assert (second.total_processed, second.total_errors) == (7, 2)
    assert second.elapsed_sec > first.elapsed_sec > 0.1
    assert second.throughput_per_s == pytest.approx(7 / second.elapsed_sec, abs=0.06)
    windows = spark.read.json(run.path("window_metrics"))
    assert windows.agg(F.sum("late_count"), F.sum("message_count")).first() == (7, 1)  # the bad stamp counts as now
    assert spark.read.parquet(run.path("quarantine")).count() == 1
    assert spark.read.parquet(run.path("asides")).where("reason = 'late'").count() == 7
    assert spark.read.json(run.path("progress")).count() >= 1


def test_consuming_run(spark, tmp_path):
    for start in (0, 5, 10):
        queue(tmp_path / "q", [event_text(start + i) for i in range(5)], start=start)
        run = stream_job.StreamRun(str(tmp_path / "q"), str(tmp_path / "out"), consume=True, files_per_trigger=2, publish=False)
        stream_job.run_available(spark, run)
    assert stream_job.summary(spark, run).first().total_processed == 15
    assert len(os.listdir(tmp_path / "q")) < 15


def test_timed_run(spark, tmp_path):
    queue(tmp_path / "q", [event_text(i) for i in range(3)])
    run = stream_job.StreamRun(str(tmp_path / "q"), str(tmp_path / "out"))
    stream_job.run_for(spark, run, 12, "1 second")
    assert stream_job.summary(spark, run).first().total_processed == 3


def test_load_test(spark, tmp_path):
    for rate, count in ((100, 4), (1000, 7)):
        queue(tmp_path / f"q/load_{rate}", [event_text(i) for i in range(count)])
    report = stream_job.run_load_test(spark, str(tmp_path / "q"), str(tmp_path / "out"), [100, 1000])
    assert [(r.target_rate, r.processed) for r in report.orderBy("target_rate").collect()] == [(100, 4), (1000, 7)]


def test_consumed_files_can_be_deleted(spark, tmp_path):
    queue(tmp_path / "q", [event_text(i) for i in range(3)])
    for start in (3, 6):
        stream = EF.stream_events(spark, str(tmp_path / "q"), clean_source="delete", files_per_trigger=1)
        live.run_available(asides.append_writer(stream.select("event_id"), str(tmp_path / "out"), str(tmp_path / "cp")))
        queue(tmp_path / "q", [event_text(start)], start=start)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    assert len(os.listdir(tmp_path / "q")) < 5
