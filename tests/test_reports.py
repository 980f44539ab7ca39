from collections import Counter

import pytest
from pyspark.sql import functions as F

import bruteforce
from eventdata import START_US, frame, random_events
from fluxmill.functions import traffic
from fluxmill.operators import reports
from fluxmill.operators.backlog import BLOCK, backlog_depth, depth_summary
from fluxmill.operators.dedup import dedup_events


def depths(rows, bucket_sec):
    change = Counter()
    for r in rows:
        change[r["event_us"] // (bucket_sec * 1_000_000)] += 1
        change[r["receive_us"] // (bucket_sec * 1_000_000)] -= 1
    level, series = 0, {}
    for bucket in range(min(change), max(change) + 1):
        level += change[bucket]
        series[bucket] = level
    return series


def test_backlog_over_many_blocks(spark):
    rows = random_events(200, span_sec=5 * BLOCK, max_lag_sec=2 * BLOCK)
    series = depths(rows, 1)
    got = backlog_depth(frame(spark, rows), 1)
    for r in got.collect():
        assert r.depth == series[r.bucket_start_s]
        assert all(series[b] == r.depth for b in range(r.bucket_start_s, r.bucket_start_s + r.held_buckets) if b in series)
    summary = depth_summary(got).first()
    assert summary.queue_depth_max == max(series.values())
    assert summary.queue_depth_avg == pytest.approx(sum(series.values()) / len(series), abs=0.0051)


def test_backlog_per_key(spark):
    rows = random_events(120)
    df = frame(spark, rows).withColumn("level", F.col("event_id") % 2)
    for level in (0, 1):
        series = depths([r for r in rows if r["event_id"] % 2 == level], 5)
        got = {r.bucket_start_s // 5: r.depth for r in backlog_depth(df, 5, ["level"]).where(f"level = {level}").collect()}
        assert all(series[b] == d for b, d in got.items()) and got


def test_summary(spark):
    rows = random_events(500, ahead=True)
    df = frame(spark, rows).withColumn("stamp_ok", F.col("event_id") % 50 != 0)
    got = reports.stream_summary(df, 1).first()
    good = [r["receive_us"] - r["event_us"] for r in rows if r["event_id"] % 50]
    assert (got.total_processed, got.total_errors) == (len(good), len(rows) - len(good))
    for p in (50, 95, 99):
        assert got[f"latency_p{p}_ms"] == pytest.approx(bruteforce.floor_rank(good, p) / 1000, abs=0.0051)
    assert got.latency_max_ms == pytest.approx(max(good) / 1000, abs=0.0051)
    seconds = (max(r["receive_us"] for r in rows) - min(r["receive_us"] for r in rows)) / 1e6
    assert got.throughput_per_s == pytest.approx(len(good) / seconds, abs=0.051)
    assert got.queue_depth_max == max(depths(rows, 1).values())


def test_summary_of_nothing(spark):
    got = reports.stream_summary(frame(spark, []), 1).first()
    assert (got.total_processed, got.total_errors, got.latency_p99_ms, got.queue_depth_max) == (0, 0, 0.0, 0)


@pytest.mark.parametrize("count", [1, 7, 300, 10_000])
def test_recent_latency(spark, count):
    rows = random_events(300)
    for r in rows:
        r["receive_us"] -= r["receive_us"] % 100_000_000  # many ties
    got = [(r.receive_us, r.event_id) for r in reports.recent_latency(frame(spark, rows), count).collect()]
    assert got == sorted(((r["receive_us"], r["event_id"]) for r in rows), reverse=True)[:count]


def test_load_levels(spark):
    rows = random_events(300)
    df = frame(spark, rows).withColumns({"load_level": (F.col("event_id") % 3).cast("int"), "payload": F.lit("abcd")})
    for r in reports.load_levels(df, 1).collect():
        mine = [x for x in rows if x["event_id"] % 3 == r.target_rate]
        lags = [x["receive_us"] - x["event_us"] for x in mine]
        assert (r.sent, r.errors, r.bytes, r.processed) == (len(mine), 0, 4 * len(mine), len(mine))
        assert r.latency_p95_ms == pytest.approx(bruteforce.floor_rank(lags, 95) / 1000, abs=0.0051)
        assert r.queue_depth_max == max(depths(mine, 1).values())


@pytest.mark.parametrize(
    "elapsed, phase, rate",
    [(0, "ramp_up", 1), (10, "ramp_up", 50), (20, "steady", 100), (59, "steady", 100), (60, "burst", 300),
     (75, "steady", 100), (90, "cool_down", 100), (95, "cool_down", 50), (100, "cool_down", 1), (120, "cool_down", 1)],
)
def test_traffic_phase(spark, elapsed, phase, rate):
    fraction = F.lit(elapsed / 100.0)
    row = spark.range(1).select(traffic.phase(fraction).alias("p"), traffic.target_rate(fraction, 100).alias("r")).first()
    assert row.p == phase
    assert abs(row.r - rate) <= 1  # floating point may fall just below a whole rate


def test_dedup_keeps_the_first_received(spark):
    rows = random_events(50)
    copies = [{**r, "receive_us": r["receive_us"] + 1000 * k} for r in rows for k in range(r["event_id"] % 4 + 1)]
    got = dedup_events(frame(spark, copies)).orderBy("event_id").collect()
    assert [(r.event_id, r.receive_us, r.cart_value) for r in got] == [
        (r["event_id"], r["receive_us"], r["cart_value"]) for r in rows
    ]
    assert START_US <= got[0].event_us


def test_dedup_keeps_events_without_an_id(spark):
    rows = [{**r, "event_id": None} for r in random_events(5)]
    assert dedup_events(frame(spark, rows + rows)).count() == 10
