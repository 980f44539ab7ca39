"""One query per operator: name -> (spark, folder of the driver's tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxmill import constants as C
from fluxmill.functions import features as X
from fluxmill.functions.events import latency_us
from fluxmill.functions.numbers import round_to
from fluxmill.operators import backlog, dedup, imputation, ledger, reports
from fluxmill.operators import windows as W
from fluxmill.operators.profiles import fit_profile, profile_stats, region_averages, with_region_averages
from fluxmill.plans.feature_job import run_feature_job
from fluxmill.plans.feature_table import feature_table as all_features
from fluxmill.plans.stream_job import run_load_test
from fluxmill.sources import adapters as A
from fluxmill.sources import event_files as EF
from fluxmill.sources import tables
from fluxmill.streaming import asides, published, recent, rollup, sketches
from fluxmill.streaming import features as stream_features_
from fluxmill.streaming import windows as stream_windows
from fluxmill.streaming.progress import progress_rows
from fluxmill.workspace import new_folder, remove, stored

Query = Callable[[SparkSession, str], DataFrame]

# The event table holds about one event per four minutes at the smallest scales, hence hours.
WINDOW_SEC = 3600
MAX_LAG_SEC = 600
AHEAD_SEC = 0
BUCKET_SEC = 3600
RUN_START_S = 1_704_067_200
RUN_SEC = 30 * 86_400
BASE_RATE = 100
RECENT_ROWS = 500
REPLAY_DELAY_US = 60_000_000
DEDUP_DELAY_SEC = 86_400
MERGED_BATCHES = 8

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison across engines, whose sums differ in the last bits."""
    return df.select(
        *[(round_to(F.col(c), digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _users(spark: SparkSession, folder: str) -> DataFrame:
    return A.users_from_orders(spark, folder)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return A.events_from_log(tables.read_event_log(spark, folder))


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return W.prepared(_events(spark, folder), WINDOW_SEC, MAX_LAG_SEC)


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return A.events_from_log(tables.stream_event_log(spark, folder))


# -- users: scans, projections, statistics --

@query
def scan_users(spark, folder):
    return rounded(_users(spark, folder))


@query
def cast_schema(spark, folder):
    return rounded(imputation.cast_users(A.text_users(_users(spark, folder))))


@query
def feature_stats(spark, folder):
    return rounded(imputation.column_stats(_users(spark, folder)))


@query
def impute_mean(spark, folder):
    return rounded(imputation.impute_mean(_users(spark, folder)).select("user_id", "income", "cart_value"))


@query
def ratio_features(spark, folder):
    return rounded(
        _users(spark, folder).select(
            "user_id",
            X.click_through_rate().alias("click_through_rate"),
            X.cart_per_pageview().alias("cart_per_pageview"),
        )
    )


@query
def log_features(spark, folder):
    return rounded(
        _users(spark, folder).select(
            "user_id", F.log1p("income").alias("log_income"), F.log1p("cart_value").alias("log_cart_value")
        )
    )


@query
def age_bins(spark, folder):
    return _users(spark, folder).select("user_id", "age", X.age_group().alias("age_group"))


@query
def income_bins(spark, folder):
    return _users(spark, folder).select("user_id", X.income_bracket().alias("income_bracket"))


@query
def onehot_device(spark, folder):
    return _users(spark, folder).select("user_id", *X.device_flags())


@query
def onehot_region(spark, folder):
    return _users(spark, folder).select("user_id", *X.region_flags())


@query
def region_profile(spark, folder):
    users = _users(spark, folder)
    joined = with_region_averages(users, fit_profile(users, ["session_time", "clicks"]))
    return rounded(
        joined.select("user_id", "region", "region_avg_session", "region_avg_clicks", "session_vs_region_avg")
    )


@query
def minmax_norm(spark, folder):
    return rounded(imputation.min_max_scale(_users(spark, folder)).select("user_id", "session_time_norm", "page_views_norm"))


@query
def interaction(spark, folder):
    filled = imputation.impute_mean(_users(spark, folder), ["income"])
    return rounded(filled.select("user_id", X.interaction().alias("income_x_pageviews")))


@query
def feature_table(spark, folder):
    return rounded(all_features(_users(spark, folder)))


@query
def feature_partitions(spark, folder):
    """The table dealt out anew for writing."""
    return rounded(all_features(_users(spark, folder), partitions=4))


@query
def incremental_profile(spark, folder):
    """Files come in two rounds and one set goes; each file is read once."""
    path = new_folder(spark, "ledger")
    users = _users(spark, folder)
    ledger.start_ledger(spark, f"{path}/ledger")
    for round_ in ((0, 1), (2, 3)):
        for part in round_:
            users.where(F.col("user_id") % 4 == part).write.parquet(f"{path}/users/part={part}")
        ledger.update_ledger(spark, f"{path}/users", f"{path}/ledger")
    remove(spark, f"{path}/users/part=1")
    profile = ledger.ledger_profile(spark, f"{path}/users", f"{path}/ledger")
    stats = imputation.as_scalar(profile_stats(profile))
    averages = region_averages(profile)
    return rounded(
        averages.select(
            F.col("profile_region").alias("region"),
            "region_avg_session",
            "region_avg_clicks",
            *[stats.getField(f.name).alias(f.name) for f in profile_stats(profile).schema],
        )
    )


@query
def stream_features(spark, folder):
    """Users arrive in parts and are joined with a profile fitted before."""
    path = new_folder(spark, "stream-features")
    users = _users(spark, folder)
    stream_features_.save_profile(fit_profile(imputation.cast_users(users)), f"{path}/profile")
    for part in range(3):
        users.where(F.col("user_id") % 3 == part).write.mode("append").parquet(f"{path}/users")
        arriving = spark.readStream.schema(users.schema).parquet(f"{path}/users")
        stream_windows.run_available(
            stream_features_.features_writer(arriving, f"{path}/profile", f"{path}/features", f"{path}/checkpoint")
        )
    return rounded(stream_features_.read_features(spark, f"{path}/features").drop("profile_version"))


def _feature_run(spark: SparkSession, folder: str) -> tuple[DataFrame, str]:
    output = new_folder(spark, "feature-job")
    return run_feature_job(_users(spark, folder), output), output


@query
def row_counts(spark, folder):
    report, _ = _feature_run(spark, folder)
    return report.select("input_rows", "output_rows")


@query
def feature_files(spark, folder):
    _, output = _feature_run(spark, folder)
    return rounded(spark.read.parquet(f"{output}/features"))


@query
def run_metrics(spark, folder):
    report, _ = _feature_run(spark, folder)
    return report


# -- events: parsing, lateness, latency --

@query
def parse_events(spark, folder):
    raw = A.raw_events_from_log(tables.read_event_log(spark, folder))
    parsed = EF.parse_events(raw)
    return rounded(
        parsed.select(
            "event_id", "user_id", "event_type", "event_us", "receive_us", "stamp_ok",
            "session_time", "page_views", "clicks", "cart_value",
        )
    )


def _decoded(spark: SparkSession, folder: str) -> DataFrame:
    return EF.decode_lines(A.event_lines_from_log(tables.read_event_log(spark, folder)))


@query
def quarantine(spark, folder):
    return EF.quarantined(_decoded(spark, folder)).select("line_id", F.lit(1).alias("corrupt"))


@query
def decoded_events(spark, folder):
    parsed = EF.parse_events(EF.decoded_only(_decoded(spark, folder)))
    return rounded(
        parsed.select("line_id", "event_id", "user_id", "event_type", "event_us", "stamp_ok", "page_views", "cart_value")
    )


@query
def event_latency(spark, folder):
    return _events(spark, folder).select("event_id", (latency_us() / F.lit(1000)).alias("latency_ms"))


@query
def late_flags(spark, folder):
    return _rows(spark, folder).select("event_id", "window_start_s", F.col("late").cast("int").alias("late"))


@query
def late_audit(spark, folder):
    return W.late_counts(_rows(spark, folder))


@query
def traffic_phases(spark, folder):
    return reports.traffic_phases(_events(spark, folder), RUN_START_S, RUN_SEC, BASE_RATE, BUCKET_SEC)


@query
def dedup_events(spark, folder):
    return rounded(dedup.dedup_events(A.with_replays(_events(spark, folder), REPLAY_DELAY_US)))


# -- windows --

@query
def window_counts(spark, folder):
    return W.window_counts(_rows(spark, folder))


@query
def window_unique_users(spark, folder):
    return W.unique_users(_rows(spark, folder))


@query
def window_event_counts(spark, folder):
    return W.event_counts(_rows(spark, folder))


@query
def window_cart(spark, folder):
    return W.window_cart(_rows(spark, folder))


@query
def window_session(spark, folder):
    return W.window_session(_rows(spark, folder))


@query
def window_ctr(spark, folder):
    return W.window_ctr(_rows(spark, folder))


@query
def window_latency_pct(spark, folder):
    return W.window_latency(_rows(spark, folder))


def _flat(report: DataFrame) -> DataFrame:
    """The map as JSON text, so that engines without an equal map type can be compared."""
    return report.withColumn("event_counts", F.to_json("event_counts"))


@query
def window_metrics(spark, folder):
    return _flat(W.window_metrics(_events(spark, folder), WINDOW_SEC, MAX_LAG_SEC))


# -- reports --

@query
def stream_summary(spark, folder):
    raw = A.raw_events_from_log(tables.read_event_log(spark, folder))
    return reports.stream_summary(EF.parse_events(raw), BUCKET_SEC)


@query
def recent_latency(spark, folder):
    return reports.recent_latency(_events(spark, folder), RECENT_ROWS)


@query
def load_levels(spark, folder):
    return reports.load_levels(_events(spark, folder), BUCKET_SEC)


@query
def json_report(spark, folder):
    """The load report, written as JSON and read again."""
    path = new_folder(spark, "report")
    report = reports.load_levels(_events(spark, folder), BUCKET_SEC)
    tables.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query
def load_directories(spark, folder):
    """Messages in a directory for each load level, landed as one stream, consumed, and reported."""
    path = new_folder(spark, "load")
    lines = A.load_lines_from_log(tables.read_event_log(spark, folder))
    for rate in C.LOAD_RATES:
        lines.where(F.col("load_level") == rate).select("value").write.text(f"{path}/queue/load_{rate}")
    report = run_load_test(spark, f"{path}/queue", f"{path}/out", glob="part-*", consume=True)
    # How long the files took to come says nothing about the events; see the tests for latencies.
    left = EF.read_load_lines(spark, f"{path}/queue", "part-*").agg(F.count(F.lit(1)).alias("lines_left"))
    return report.select(
        "target_rate", "sent", "errors", "bytes", "elapsed", "avg_rate", "processed",
        imputation.as_scalar(left).getField("lines_left").alias("lines_left"),
    )


@query
def backlog_depth(spark, folder):
    return backlog.backlog_depth(_events(spark, folder), BUCKET_SEC)


# -- streams, each run to the end of what is there --

STREAM_PARTS = 4


def _receive_part(spark: SparkSession, folder: str, parts: int = STREAM_PARTS) -> Column:
    """The part, 0 to parts - 1, of the log's receive time that a row arrives in; 0 without a receive time."""
    log = tables.read_event_log(spark, folder)
    low, high = log.agg(F.min(A.receive_time_us()), F.max(A.receive_time_us())).first()
    if low is None:
        return F.lit(0)
    cuts = [low + (high - low) * i // parts for i in range(1, parts)]
    return F.coalesce(sum((A.receive_time_us() >= cut).cast("int") for cut in cuts), F.lit(0))


def _as_it_comes(spark: SparkSession, folder: str, path: str, start, parts: int = STREAM_PARTS, until: int = STREAM_PARTS):
    """The event log as a stream: each part of it arrives, then what `start` makes of the source runs to its end.

    Each run goes on from the checkpoint of the one before. `until` parts arrive.
    """
    log = tables.read_event_log(spark, folder)
    part = _receive_part(spark, folder, parts)
    for number in range(until):
        log.where(part == number).write.mode("append").parquet(f"{path}/source")
        stream = spark.readStream.schema(log.schema).parquet(f"{path}/source")
        finished = stream_windows.run_available(start(stream))
    return finished


def _run_windows(spark: SparkSession, folder: str, writer) -> str:
    path = new_folder(spark, "stream-windows")

    def start(stream: DataFrame):
        aggregates = stream_windows.window_aggregates(A.events_from_log(stream), WINDOW_SEC, MAX_LAG_SEC, AHEAD_SEC)
        return writer(aggregates, f"{path}/windows", f"{path}/checkpoint")

    _as_it_comes(spark, folder, path, start)
    return f"{path}/windows"


def _exact_columns(windows: DataFrame) -> DataFrame:
    return windows.drop("unique_users_approx", *[c for c in windows.columns if c.endswith("_approx")])


@query
def stream_window_metrics(spark, folder):
    return _exact_columns(stream_windows.read_windows(spark, _run_windows(spark, folder, stream_windows.updates_writer)))


@query
def stream_closed_windows(spark, folder):
    return _exact_columns(stream_windows.read_windows(spark, _run_windows(spark, folder, stream_windows.closed_writer)))


def _published(spark: SparkSession, folder: str, until: int) -> DataFrame:
    path = new_folder(spark, "stream-published")
    published.start_published(spark, f"{path}/published")

    def publish(rows: DataFrame, batch_id: int) -> None:
        published.publish_batch(rows, f"{path}/tables", f"{path}/published", batch_id, WINDOW_SEC, MAX_LAG_SEC)

    def start(stream: DataFrame):
        return rollup.rollup_writer(
            A.events_from_log(stream), f"{path}/tables", f"{path}/checkpoint", WINDOW_SEC, MAX_LAG_SEC, BUCKET_SEC, publish
        )

    _as_it_comes(spark, folder, path, start, until=until)
    return published.read_published(spark, f"{path}/published")


@query
def stream_published(spark, folder):
    """The stream stops half-way: the windows closed by then are there, and no others."""
    return _published(spark, folder, STREAM_PARTS // 2)


@query
def stream_corrections(spark, folder):
    """At the end, late events have corrected the windows published before they came."""
    return _published(spark, folder, STREAM_PARTS)


@query
def stream_merged_batches(spark, folder):
    """Batches are replayed before and after their folders were merged."""
    path = new_folder(spark, "stream-merged")
    rollup.start_rollup(spark, path)
    rows = rollup.batch_rows(_events(spark, folder), WINDOW_SEC, MAX_LAG_SEC)
    hour = F.coalesce(F.floor(F.col("receive_us") / F.lit(3_600_000_000)), F.lit(0))
    batches = [rows.where(F.pmod(hour, F.lit(MERGED_BATCHES)) == i) for i in range(MERGED_BATCHES)]
    for i, batch in enumerate(batches):
        for replay in (i, i - 1, i - 4):
            if replay >= 0:
                rollup.add_batch(batches[replay], path, replay, BUCKET_SEC)
        rollup.compact(spark, path, i, fanout=3)
    return _flat(rollup.read_windows(spark, path, WINDOW_SEC))


def _run_rollup(spark: SparkSession, events: DataFrame, path: str) -> None:
    writer = rollup.rollup_writer(
        events, f"{path}/tables", f"{path}/checkpoint", WINDOW_SEC, MAX_LAG_SEC, BUCKET_SEC
    )
    stream_windows.run_available(writer)


@query
def stream_window_exact(spark, folder):
    path = new_folder(spark, "stream-rollup")
    _run_rollup(spark, _event_stream(spark, folder), path)
    return _flat(rollup.read_windows(spark, f"{path}/tables", WINDOW_SEC))


@query
def stream_run_summary(spark, folder):
    path = new_folder(spark, "stream-summary")
    raw = A.raw_events_from_log(tables.stream_event_log(spark, folder))
    _run_rollup(spark, EF.parse_events(raw), path)
    return rollup.read_summary(spark, f"{path}/tables", BUCKET_SEC)


def _rank_misses(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """For each window, how far the ranks of its estimated percentiles lie from those asked for, at most (0 to 1)."""
    found = estimates.select("window_start_s", *[F.col(f"latency_p{p}_ms") for p in C.PERCENTS])
    latency_ms = F.col("latency_us") / F.lit(1000)
    misses = []
    for p in C.PERCENTS:
        at = F.col(f"latency_p{p}_ms")
        below, upto = F.avg((latency_ms < at).cast("int")), F.avg((latency_ms <= at).cast("int"))
        misses.append(F.greatest(below - F.lit(p / 100), F.lit(p / 100) - upto, F.lit(0.0)))
    joined = W.accepted(rows).select("window_start_s", "latency_us").join(found, "window_start_s")
    return joined.groupBy("window_start_s").agg(F.greatest(*misses).alias("miss"))


@query
def stream_sketched_windows(spark, folder):
    """Users and percentiles of mergeable sketches over several batches, beside the exact ones: within the bounds or not."""
    path = new_folder(spark, "stream-sketches")
    sketches.start_sketches(spark, f"{path}/tables")

    def start(stream: DataFrame):
        rows = rollup.batch_rows(A.events_from_log(stream), WINDOW_SEC, MAX_LAG_SEC)

        def write(batch: DataFrame, batch_id: int) -> None:
            sketches.add_batch(batch, f"{path}/tables", batch_id, BUCKET_SEC)
            sketches.compact(spark, f"{path}/tables", batch_id, fanout=2)

        return rows.writeStream.option("checkpointLocation", f"{path}/checkpoint").foreachBatch(write)

    _as_it_comes(spark, folder, path, start)
    estimates = stored(sketches.read_windows(spark, f"{path}/tables", WINDOW_SEC, keep_start=True), "sketched")
    rows = _rows(spark, folder)
    exact = W.unique_users(rows).withColumnRenamed("unique_users", "exact_users")
    off = F.abs(F.col("unique_users") - F.col("exact_users"))
    one_rank = F.lit(1.0) / F.col("message_count")  # ranks of few events are coarse
    judged = estimates.join(exact, "window_start_s", "left").join(_rank_misses(rows, estimates), "window_start_s", "left")
    return judged.select(
        "window_start_s",
        "message_count",
        "late_count",
        F.to_json("event_counts").alias("event_counts"),
        "total_cart_value",
        "latency_max_ms",
        F.coalesce(off <= sketches.USER_ERROR * F.col("exact_users"), F.col("unique_users") == 0).alias("users_within"),
        F.coalesce(F.col("miss") <= sketches.RANK_ERROR + one_rank, F.lit(True)).alias("latency_within"),
    )


def _run_recent(spark: SparkSession, folder: str, shape) -> str:
    """Rollup and recent latencies of the log as it comes, over restarts."""
    path = new_folder(spark, "stream-recent")
    recent.start_recent(spark, f"{path}/recent")
    rollup.start_rollup(spark, f"{path}/tables")

    def start(stream: DataFrame):
        def write(batch: DataFrame, batch_id: int) -> None:
            rows = rollup.batch_rows(batch, keep=["event_id"]).persist()  # read seven times, parsed once
            try:
                rollup.add_batch(rows, f"{path}/tables", batch_id, BUCKET_SEC)
                recent.add_batch(rows, f"{path}/recent", batch_id, RECENT_ROWS)
            finally:
                rows.unpersist()
            recent.compact(spark, f"{path}/recent", batch_id, RECENT_ROWS, fanout=2)

        return shape(stream).writeStream.option("checkpointLocation", f"{path}/checkpoint").foreachBatch(write)

    _as_it_comes(spark, folder, path, start)
    return path


@query
def stream_recent_latency(spark, folder):
    return recent.read_recent(spark, f"{_run_recent(spark, folder, A.events_from_log)}/recent", RECENT_ROWS)


@query
def stream_recent_summary(spark, folder):
    """The run summary with the percentiles of the latest latencies."""
    path = _run_recent(spark, folder, lambda log: EF.parse_events(A.raw_events_from_log(log)))
    return recent.read_summary(spark, f"{path}/tables", f"{path}/recent", RECENT_ROWS, BUCKET_SEC)


@query
def stream_late(spark, folder):
    path = new_folder(spark, "stream-late")
    rows = asides.set_aside(_event_stream(spark, folder), WINDOW_SEC, MAX_LAG_SEC, AHEAD_SEC)
    stream_windows.run_available(asides.append_writer(rows, f"{path}/asides", f"{path}/checkpoint"))
    return asides.late_per_window(spark.read.parquet(f"{path}/asides"))


@query
def stream_quarantine(spark, folder):
    path = new_folder(spark, "stream-quarantine")
    lines = A.event_lines_from_log(tables.stream_event_log(spark, folder))
    corrupt = EF.quarantined(EF.decode_lines(lines)).select("line_id", F.col("_corrupt_record").alias("line"))
    stream_windows.run_available(asides.append_writer(corrupt, f"{path}/corrupt", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/corrupt").select("line_id", F.lit(1).alias("corrupt"))


@query
def stream_resume(spark, folder):
    """Two runs over one checkpoint; the second sees files that arrived after the first."""
    path = new_folder(spark, "stream-resume")
    log = tables.read_event_log(spark, folder)
    middle = F.lit(RUN_START_S + RUN_SEC // 2)
    first_half = F.unix_seconds(F.col("ts").cast("timestamp")) < middle
    for arrived in (first_half, ~F.coalesce(first_half, F.lit(False))):
        log.where(arrived).write.mode("append").parquet(f"{path}/source")
        source = spark.readStream.schema(log.schema).parquet(f"{path}/source")
        aggregates = stream_windows.window_aggregates(A.events_from_log(source), WINDOW_SEC, MAX_LAG_SEC, AHEAD_SEC)
        stream_windows.run_available(
            stream_windows.updates_writer(aggregates, f"{path}/windows", f"{path}/checkpoint")
        )
    return _exact_columns(stream_windows.read_windows(spark, f"{path}/windows"))


@query
def stream_dedup_events(spark, folder):
    path = new_folder(spark, "stream-dedup")

    def start(stream: DataFrame):
        replayed = A.with_replays(A.events_from_log(stream), REPLAY_DELAY_US)
        unique = dedup.stream_dedup(replayed, DEDUP_DELAY_SEC).select("event_id", "user_id", "event_type", "event_us")
        return asides.append_writer(unique, f"{path}/unique", f"{path}/checkpoint")

    _as_it_comes(spark, folder, path, start)
    return spark.read.parquet(f"{path}/unique")


@query
def stream_progress(spark, folder):
    path = new_folder(spark, "stream-progress")
    aggregates = stream_windows.window_aggregates(_event_stream(spark, folder), WINDOW_SEC, MAX_LAG_SEC, AHEAD_SEC)
    writer = stream_windows.updates_writer(aggregates, f"{path}/windows", f"{path}/checkpoint")
    return progress_rows(spark, stream_windows.run_available(writer))
