"""Paths that lose nothing: dedup with odd event times, mixed JSON types, rereads, runs stopped or failing."""

import json
import threading
import time

import pytest
from fluxmill.operators import dedup
from fluxmill.operators.percentiles import values_at_ranks
from fluxmill.operators.reports import recent_latency, stream_summary
from fluxmill.plans import stream_job
from fluxmill.plans.stream_job import StreamRun, run_available, run_for, run_load_test
from fluxmill.sources import event_files as EF
from pyspark.sql import functions as F

NOW = int(time.time())


def write(folder, name, *events):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in events))


def event(event_id, lead=0, **more):
    stamp = time.strftime("%Y-%m-%dT%H:%M:%S+00:00", time.gmtime(time.time() + lead))
    return {"event_id": event_id, "user_id": 1, "event_type": "click", "timestamp": stamp, **more}


def totals(spark, run):
    row = stream_job.summary(spark, run).first()
    return row["total_processed"] + row["total_errors"], row


def test_dedup_keeps_late_and_early_events(spark, tmp_path):
    source = tmp_path / "queue"
    write(source, "evt_1.json", event("a", 86_400), *[event(f"b{i}") for i in range(3)])
    write(source, "evt_2.json", *[event(f"c{i}", -600) for i in range(4)], event("b0"), event(None), event(None))
    counts = []
    for dedup_sec in (None, 3600):
        run = StreamRun(str(source), str(tmp_path / f"out{dedup_sec}"), files_per_trigger=1, dedup_sec=dedup_sec)
        run_available(spark, run)
        counts.append(totals(spark, run)[0])
    assert counts == [11, 10]


def test_dedup_in_salts(spark, tmp_path):
    rows = [(1 + i % 3, 10**15, i) for i in range(60)]
    spark.createDataFrame(rows, "event_id long, receive_us long, n int").repartition(5).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("event_id long, receive_us long, n int").parquet(f"{tmp_path}/in")
    query = dedup.stream_dedup(stream, 60, salts=4).writeStream.format("parquet").option(
        "checkpointLocation", f"{tmp_path}/c"
    )
    query.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_fields_of_other_types_do_not_lose_the_event(spark, tmp_path):
    write(
        tmp_path,
        "evt_1.json",
        event("a", page_views=3.0, income="x"),
        event("b", user_id="u-77", clicks="4"),
        event(7, cart_value="1.5", user_id=None),
    )
    (tmp_path / "evt_2.json").write_text('{"event_id": \nno event\n')
    rows = EF.read_events(spark, str(tmp_path))
    good = {r.event_id: r for r in EF.parse_events(EF.decoded_only(rows)).collect()}
    assert EF.quarantined(rows).count() == 2 and len(good) == 3
    a, b, c = (good[next(k for k in good if str(k).startswith(x))] for x in "ab7")
    assert (a.page_views, a.income, b.clicks, c.cart_value, c.user_id) == (3, None, 4, 1.5, None)
    assert b.user_id not in (None, 1)


def test_percentiles_of_a_directory(spark, tmp_path):
    for i in range(4):
        write(tmp_path, f"evt_{i}.json", *[event(f"{i}-{k}", -k) for k in range(50)])
    row = stream_summary(EF.parse_events(EF.decoded_only(EF.read_events(spark, str(tmp_path)))), 1).first()
    assert 0 < row["latency_p50_ms"] <= row["latency_p95_ms"] <= row["latency_p99_ms"] <= row["latency_max_ms"]


def test_changing_input_is_an_error(spark):
    rows = spark.range(200).select(F.lit(1).alias("k"), (F.unix_micros(F.current_timestamp()) * 1000).alias("v"))
    with pytest.raises(Exception, match="changed between two reads"):
        values_at_ranks(rows, ["k"], "v", {"p": F.lit(100)}).collect()


def test_recent_latency_is_all_rows_by_default(spark):
    rows = spark.range(10).select(
        F.col("id").alias("event_id"), F.col("id").alias("receive_us"), F.lit(0).cast("bigint").alias("event_us")
    )
    assert recent_latency(rows).count() == 10 and recent_latency(rows, 4).count() == 4


def test_reports_of_a_run_stopped_from_outside(spark, tmp_path):
    write(tmp_path / "queue", "evt_1.json", *[event(f"b{i}") for i in range(5)])
    run = StreamRun(str(tmp_path / "queue"), str(tmp_path / "out"), live_windows=False)

    def stop():
        deadline = time.time() + 60
        while time.time() < deadline:
            for query in spark.streams.active:
                if query.lastProgress and query.lastProgress["batchId"] >= 0:
                    time.sleep(3)
                    query.stop()
                    return
            time.sleep(0.3)

    thread = threading.Thread(target=stop)
    thread.start()
    run_for(spark, run, 0, "1 second")
    thread.join()
    assert totals(spark, run)[0] == 5


def test_reports_of_a_failing_run(spark, tmp_path, monkeypatch):
    write(tmp_path / "queue", "evt_1.json", event("a"))
    run = StreamRun(str(tmp_path / "queue"), str(tmp_path / "out"), live_windows=False)
    monkeypatch.setattr(stream_job.asides, "set_aside", lambda *a: 1 / 0)
    with pytest.raises(Exception, match="division|ZeroDivision"):
        run_for(spark, run, 20, "1 second")
    assert (tmp_path / "out" / "summary").exists()


def test_absent_load_levels_are_passed_over(spark, tmp_path):
    write(tmp_path / "queue" / "load_100", "evt_1.json", event("a"), event("b"))
    report = run_load_test(spark, str(tmp_path / "queue"), str(tmp_path / "out")).collect()
    assert [(r.target_rate, r.processed) for r in report] == [(100, 2)]
