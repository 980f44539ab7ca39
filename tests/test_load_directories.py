"""Load test directories as one source: rates from paths, receive times from files, consumed once."""

import json
import os

import pytest

from fluxmill.plans import stream_job
from fluxmill.sources import event_files as EF
from test_streaming import event_text, queue

START = 1_704_164_645  # 2024-01-02T03:04:05Z


def stamp(seconds):
    return f"2024-01-02T03:04:{5 + seconds:02d}Z"


def fill(base, lags, start=0):
    """One file for each event; the i-th is sent at second i and received lag seconds later."""
    for rate, seconds in lags.items():
        folder = base / f"load_{rate}"
        queue(folder, [event_text(i, stamp(i)) for i in range(len(seconds))], start)
        for i, lag in enumerate(seconds):
            at = START + i + lag
            os.utime(folder / f"evt_{start + i:010d}.json", (at, at))


def rows(report):
    return {r.target_rate: r for r in report.collect()}


def test_report_of_directories(spark, tmp_path):
    fill(tmp_path, {100: [1, 2, 3, 4], 5000: [10] * 7})
    (tmp_path / "load_100" / "evt_torn.json").write_text('{"event_id": "x')
    os.utime(tmp_path / "load_100" / "evt_torn.json", (START + 3, START + 3))
    (tmp_path / "load_100" / "other.txt").write_text("no event file")
    (tmp_path / "load_old").mkdir()
    (tmp_path / "load_old" / "evt_1.json").write_text(event_text(1))
    got = rows(stream_job.run_load_test(spark, str(tmp_path), str(tmp_path / "out")))
    assert got.keys() == {100, 5000}
    first = got[100]
    size = sum(len(event_text(i, stamp(i))) for i in range(4)) + len('{"event_id": "x')
    assert (first.sent, first.errors, first.processed, first.bytes) == (5, 1, 4, size)
    assert (first.elapsed, first.avg_rate) == (3.0, 1.7)
    assert (first.latency_p50_ms, first.latency_p95_ms, first.latency_p99_ms) == (2000.0, 3000.0, 3000.0)
    assert first.throughput == pytest.approx(4 / 6, abs=0.06) and first.queue_depth_max >= 1
    assert (got[5000].latency_p99_ms, got[5000].errors) == (10_000.0, 0)
    only = rows(stream_job.run_load_test(spark, str(tmp_path), str(tmp_path / "out"), [5000]))
    assert only.keys() == {5000} and only[5000] == got[5000]  # read once only
    assert len(os.listdir(tmp_path / "load_100")) == 6


@pytest.mark.parametrize("files_per_trigger", [None, 2])
def test_consumed_directories_are_empty(spark, tmp_path, files_per_trigger):
    settings = dict(consume=True, files_per_trigger=files_per_trigger)
    fill(tmp_path, {100: [1, 1, 1], 1000: [2]})
    stream_job.run_load_test(spark, str(tmp_path), str(tmp_path / "out"), **settings)
    fill(tmp_path, {100: [5], 1000: [2], 20: [1]}, start=50)  # a directory that was not there before
    got = rows(stream_job.run_load_test(spark, str(tmp_path), str(tmp_path / "out"), **settings))
    assert {rate: r.processed for rate, r in got.items()} == {100: 4, 1000: 2, 20: 1}
    assert [len(os.listdir(tmp_path / f"load_{rate}")) for rate in (100, 1000, 20)] == [0, 0, 0]
    assert [r.target_rate for r in spark.read.json(str(tmp_path / "out/load_levels")).orderBy("target_rate").collect()] == [20, 100, 1000]


def test_no_directory(spark, tmp_path):
    with pytest.raises(ValueError, match="no load_"):
        stream_job.run_load_test(spark, str(tmp_path), str(tmp_path / "out"))


def test_load_levels_take_parsed_events(spark, tmp_path):
    """Rows of parse_events have no payload; their sizes are unknown, all else is reported."""
    from fluxmill.operators import reports

    fill(tmp_path, {100: [1, 2]})
    lines = EF.read_load_lines(spark, str(tmp_path))
    assert lines.count() == 2 and json.loads(lines.first().value)["event_type"] == "click"
    parsed = EF.load_events(lines).drop("size")
    assert rows(reports.load_levels(parsed.withColumnRenamed("load_level", "l"), 1, "l"))[100].bytes == 0
