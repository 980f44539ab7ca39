import pytest
from pyspark.sql import functions as F

import bruteforce
from eventdata import EVENT_ROWS, START_US, frame, random_events
from fluxmill.functions import events as E
from fluxmill.operators import windows as W
from fluxmill.schemas import WINDOW_METRICS

W30, LAG10 = 30, 10


def epoch(df):
    return df.withColumn("start", F.unix_seconds(F.to_timestamp("window_start")))


def assert_windows(report, expected):
    rows = {r["start"]: r for r in epoch(report).collect()}
    assert rows.keys() == expected.keys()
    for start, want in expected.items():
        got = rows[start].asDict()
        for name, value in want.items():
            if name in ("avg_session_time", "click_through_rate", "total_cart_value"):
                assert got[name] == pytest.approx(value, abs=1.01e-4 if name == "click_through_rate" else 1.01e-2 if name == "total_cart_value" else 1.01e-3)
            else:
                assert got[name] == value, (start, name)


@pytest.mark.parametrize("max_lag", [10, 120])
def test_report_equals_brute_force(spark, max_lag):
    rows = random_events(1500, ahead=True)
    report = W.window_metrics(frame(spark, rows), W30, max_lag)
    assert report.columns == WINDOW_METRICS.fieldNames()
    assert_windows(report, bruteforce.windows(rows, W30, max_lag))


def one_event(spark, event_us, receive_us):
    row = dict(event_id=1, user_id=1, event_type="click", event_us=event_us, receive_us=receive_us,
               session_time=1.0, page_views=1, clicks=1, cart_value=0.0)
    return frame(spark, [row])


@pytest.mark.parametrize(
    "lag_us, max_lag, expected",
    [
        (59_999_999, 10, False),  # received in the next window
        (60_000_000, 10, True),  # two windows on
        (60_000_000, 60, False),  # lag equals the allowance
        (60_000_001, 60, True),
        (-5_000_000, 0, False),  # stamped in the future
    ],
)
def test_lateness_at_the_edges(spark, lag_us, max_lag, expected):
    start = START_US - START_US % 30_000_000
    df = one_event(spark, start, start + lag_us)
    assert df.select(E.is_late(W30, max_lag)).first()[0] is expected


def test_windows_before_1970(spark):
    df = spark.createDataFrame([(-1,), (0,), (-30_000_000,), (-30_000_001,)], "t long")
    got = [r[0] for r in df.select(E.window_start_s(F.col("t"), 30)).collect()]
    assert got == [-30, 0, -30, -60]


def test_batch_window_equals_spark_window(spark):
    df = frame(spark, random_events(300)).select("event_us")
    spark_start = F.unix_seconds(F.window(F.timestamp_micros("event_us"), "30 seconds").getField("start"))
    assert df.where(spark_start != E.window_start_s(F.col("event_us"), 30)).count() == 0


def test_window_with_late_events_only(spark):
    start = START_US - START_US % 30_000_000
    row = W.window_metrics(one_event(spark, start, start + 200_000_000), W30, LAG10).first()
    assert (row.message_count, row.late_count, row.unique_users, row.event_counts) == (0, 1, 0, {})
    assert row.latency_p50_ms == 0.0 and row.avg_session_time == 0.0


def test_empty_events(spark):
    assert W.window_metrics(spark.createDataFrame([], EVENT_ROWS), W30, LAG10).collect() == []


def test_single_metric_operators_agree_with_the_report(spark):
    rows = random_events(400, seed=5)
    prepared = W.prepared(frame(spark, rows), W30, LAG10)
    expected = bruteforce.windows(rows, W30, LAG10)
    counts = {r[0]: r[1] for r in W.window_counts(prepared).collect()}
    users = {r[0]: r[1] for r in W.unique_users(prepared).collect()}
    late = {r["window_start_s"]: r["late_count"] for r in W.late_counts(prepared).collect()}
    for start, want in expected.items():
        assert counts.get(start, 0) == want["message_count"]
        assert users.get(start, 0) == want["unique_users"]
        assert late[start] == want["late_count"]


def test_hot_window_is_combined_before_the_shuffle(spark):
    prepared = W.prepared(frame(spark, random_events(50)), W30, LAG10)
    for df in (W.window_counts(prepared), W.window_cart(prepared), W.unique_users(prepared)):
        assert "partial_" in df._jdf.queryExecution().executedPlan().toString()
