"""The event log in batches holds every row once: null ids and times, repeated ids, an empty log."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from fluxmill.plans import queries as Q
from fluxmill.schemas import EVENT_LOG
from fluxmill.sources import adapters as A
from fluxmill.sources import tables
from fluxmill.streaming import asides


def event(spark, event_id, ts):
    return {"event_id": event_id, "ts": ts, "user_id": 1, "event_type": "view", "value": 1.0, "props": "{}"}


@pytest.fixture()
def folder(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [event(spark, i, start + timedelta(minutes=7 * ((i * 37) % 200))) for i in range(200)]
    rows += [event(spark, 5, start + timedelta(hours=1))] * 3  # an id four times
    rows += [event(spark, None, start + timedelta(hours=2))] * 4
    rows += [event(spark, 1000 + i, None) for i in range(60)]
    spark.createDataFrame(rows, EVENT_LOG).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_every_row_once(spark, folder, tmp_path):
    def start(stream):
        events = A.events_from_log(stream).select("event_id", "event_us", "receive_us")
        return asides.append_writer(events, f"{tmp_path}/out", f"{tmp_path}/checkpoint")

    Q._as_it_comes(spark, folder, str(tmp_path), start)
    got = Counter(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))
    log = tables.read_event_log(spark, folder)
    assert got == Counter(map(tuple, A.events_from_log(log).select("event_id", "event_us", "receive_us").collect()))
    assert sum(got.values()) == 267


def test_parts_follow_the_receive_time(spark, folder):
    part = Q._receive_part(spark, folder, 5)
    rows = tables.read_event_log(spark, folder).select(part.alias("part"), A.receive_time_us().alias("us")).collect()
    times = [[-1 if r.us is None else r.us for r in rows if r.part == n] for n in range(5)]
    assert sum(map(len, times)) == 267 and all(times)
    assert all(max(before) < min(after) for before, after in zip(times, times[1:]))


@pytest.mark.parametrize("name", ["stream_window_metrics", "stream_closed_windows", "stream_dedup_events"])
def test_empty_log(spark, tmp_path, name):
    spark.createDataFrame([], EVENT_LOG).write.parquet(f"{tmp_path}/events.parquet")
    assert Q.REGISTRY[name](spark, str(tmp_path)).count() == 0
