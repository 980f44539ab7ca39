"""Windows published while the stream runs, against brute force."""

import json

import pytest
from pyspark.sql import functions as F

import bruteforce
from eventdata import frame, random_events
from fluxmill.plans import stream_job
from fluxmill.streaming import published, rollup
from fluxmill.streaming import windows as live
from fluxmill.workspace import new_folder
from test_streaming import event_text, queue, receive_ordered, source
from test_windows import assert_windows

WINDOW, LAG = 30, 10


def run(spark, path, max_lag=LAG, replay=False, fanout=None):
    published.start_published(spark, f"{path}/published")

    def publish(rows, batch_id):
        for _ in range(1 + replay):
            published.publish_batch(rows, f"{path}/tables", f"{path}/published", batch_id, WINDOW, max_lag)
        if fanout:
            published.compact(spark, f"{path}/published", batch_id, fanout)

    writer = rollup.rollup_writer(source(spark, f"{path}/in"), f"{path}/tables", f"{path}/cp", WINDOW, max_lag, 1, publish)
    live.run_available(writer)


def final(rows, max_lag=LAG):
    """The windows that the last receive time is past, as they stand with all events."""
    clock = max(r["receive_us"] for r in rows)
    wait = (WINDOW + max(WINDOW, max_lag)) * 1_000_000
    return {k: v for k, v in bruteforce.windows(rows, WINDOW, max_lag).items() if k * 1_000_000 + wait <= clock}


def as_report(spark, path):
    kind = "map<string,bigint>"
    return published.read_published(spark, f"{path}/published").withColumn("event_counts", F.from_json("event_counts", kind))


@pytest.mark.parametrize("max_lag, replay, fanout", [(10, False, None), (100, True, 2)])
def test_published_windows_are_the_final_ones(spark, max_lag, replay, fanout):
    rows = random_events(500, span_sec=500)
    path = new_folder(spark, "test-published")
    receive_ordered(spark, f"{path}/in", rows, 4)
    run(spark, path, max_lag, replay, fanout)
    expected = final(rows, max_lag)
    assert len(expected) > 3
    assert_windows(as_report(spark, path), expected)
    log = published.changes(spark, f"{path}/published")
    if max_lag < WINDOW and not fanout:
        back = {r.window_start_s for r in log.where("change = -1").collect()}
        assert back  # late events came for windows published before
        assert log.where("change = 1").groupBy("window_start_s").count().where("count > 1").count() >= len(back)


def test_half_a_stream_then_the_rest(spark):
    rows = sorted(random_events(400, span_sec=400), key=lambda r: r["receive_us"])
    path = new_folder(spark, "test-published-half")
    for begin, end in ((0, 150), (150, 400)):
        frame(spark, rows[begin:end]).coalesce(1).write.mode("append").parquet(f"{path}/in")
        run(spark, path)
        assert_windows(as_report(spark, path), final(rows[:end]))
    assert 0 < len(final(rows[:150])) < len(bruteforce.windows(rows[:150], WINDOW, LAG))


def test_receive_times_that_go_back(spark):
    rows = sorted(random_events(300, span_sec=300), key=lambda r: -r["receive_us"])
    path = new_folder(spark, "test-published-back")
    for begin in (0, 100, 200):
        frame(spark, rows[begin : begin + 100]).coalesce(1).write.mode("append").parquet(f"{path}/in")
        run(spark, path)
    assert_windows(as_report(spark, path), final(rows))


def test_no_events(spark):
    path = new_folder(spark, "test-published-none")
    published.start_published(spark, f"{path}/published")
    rollup.start_rollup(spark, f"{path}/tables")
    published.publish_batch(rollup.batch_rows(frame(spark, [])), f"{path}/tables", f"{path}/published", 0)
    assert published.read_published(spark, f"{path}/published").count() == 0


def test_job_publishes_with_dedup_and_consume(spark, tmp_path):
    for start in (0, 5):
        queue(tmp_path / "q", [event_text((start + i) % 7) for i in range(5)], start=start)
        settings = dict(dedup_sec=600, consume=True, files_per_trigger=4)
        run_ = stream_job.StreamRun(str(tmp_path / "q"), str(tmp_path / "out"), **settings)
        stream_job.run_available(spark, run_)
    rows = published.read_published(spark, run_.path("published")).collect()
    assert [(r.window_start, r.message_count, r.late_count) for r in rows] == [("2024-01-02T03:04:00+00:00", 0, 7)]
    assert json.loads(rows[0].event_counts) == {}
