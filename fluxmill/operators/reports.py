"""Stream summary, recent latencies, load levels, traffic phases and run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluxmill import constants as C
from fluxmill.functions import traffic
from fluxmill.functions.events import MICROS, latency_us
from fluxmill.functions.numbers import round_to
from fluxmill.operators.backlog import backlog_depth, depth_summary
from fluxmill.operators.imputation import as_scalar
from fluxmill.operators.percentiles import as_ms, floor_rank_percentiles, values_at_ranks
from fluxmill.schemas import RUN_METRICS

PERCENTILE_COLUMNS = [f"latency_p{p}_ms" for p in C.PERCENTS]
SALTS = 64


def _stamp_ok(events: DataFrame) -> Column:
    return F.col("stamp_ok") if "stamp_ok" in events.columns else F.lit(True)


def _seconds(low: Column, high: Column) -> Column:
    return F.coalesce((high - low) / F.lit(float(MICROS)), F.lit(0.0))


def _per_second(count: Column, seconds: Column) -> Column:
    return round_to(count / F.greatest(seconds, F.lit(0.001)), 1)


def recent_latency(events: DataFrame, rows: int | None = None) -> DataFrame:
    """The latest `rows` events by receive time, then event_id; all events without `rows`.

    A plain top-k would send `rows` rows of every task to one task. The receive time of the last row
    that counts is found first and becomes a filter; rows that share it are ranked in SALTS parts.
    """
    if rows is None:
        return events.select("event_id", "receive_us", latency_us().alias("latency_us"))
    cutoff_rank = {"cutoff": F.greatest(F.lit(1).cast("bigint"), F.col("total") - (rows - 1))}
    cutoff = values_at_ranks(events.withColumn("all", F.lit(1)), ["all"], "receive_us", cutoff_rank)
    latest_first = [F.desc("receive_us"), F.desc("event_id")]
    part = F.pmod(F.xxhash64("event_id"), F.lit(SALTS))
    return (
        events.select("event_id", "receive_us", latency_us().alias("latency_us"))
        .where(F.col("receive_us") >= as_scalar(cutoff.select("cutoff")).getField("cutoff"))
        .withColumn("place", F.row_number().over(Window.partitionBy(part).orderBy(*latest_first)))
        .where(F.col("place") <= rows)
        .drop("place")
        .orderBy(*latest_first)
        .limit(rows)
    )


def _report_percentiles(events: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    found = floor_rank_percentiles(events, keys, "latency_us", C.PERCENTS, weight)
    return found.select(
        *keys, *[round_to(as_ms(F.col(f"p{p}")), 2).alias(f"latency_p{p}_ms") for p in C.PERCENTS]
    )


def arrivals(events: DataFrame) -> DataFrame:
    """What the summary needs of each event; a rollup keeps the same per distinct latency."""
    return events.select(
        _stamp_ok(events).alias("stamp_ok"),
        latency_us().alias("latency_us"),
        F.lit(1).cast("bigint").alias("n"),
        F.col("receive_us").alias("first_receive_us"),
        F.col("receive_us").alias("last_receive_us"),
    )


def summary_of(arrived: DataFrame, depth: DataFrame) -> DataFrame:
    """The one-row stream summary from arrivals and backlog depths.

    Accepted and late events count alike. Rows whose stamp was unusable are errors.
    """
    usable = arrived.where("stamp_ok").withColumn("all", F.lit(1))
    return summary_from(arrived, _report_percentiles(usable, ["all"], "n"), F.col("latency_us"), depth)


def summary_from(
    arrived: DataFrame, percentiles: DataFrame, largest: Column, depth: DataFrame, top: DataFrame | None = None
) -> DataFrame:
    """The summary from counts of arrivals, one row of percentiles, their largest latency, and depths.

    `top` is one row max_us in place of the largest latency of the arrivals.
    """
    good = F.when(F.col("stamp_ok"), F.col("n")).otherwise(0)
    bad = F.when(F.col("stamp_ok"), 0).otherwise(F.col("n"))
    totals = arrived.agg(
        F.coalesce(F.sum(good), F.lit(0)).cast("bigint").alias("total_processed"),
        F.coalesce(F.sum(bad), F.lit(0)).cast("bigint").alias("total_errors"),
        _seconds(F.min("first_receive_us"), F.max("last_receive_us")).alias("seconds"),
        F.max(F.when(F.col("stamp_ok"), largest.cast("bigint"))).alias("max_us"),
    )
    latency = as_scalar(percentiles)
    deepest = as_scalar(depth_summary(depth))
    zero = F.lit(0.0)
    max_us = F.col("max_us") if top is None else as_scalar(top).getField("max_us")
    return totals.select(
        "total_processed",
        "total_errors",
        round_to(F.col("seconds"), 2).alias("elapsed_sec"),
        _per_second(F.col("total_processed"), F.col("seconds")).alias("throughput_per_s"),
        *[F.coalesce(round_to(latency.getField(name), 2), zero).alias(name) for name in PERCENTILE_COLUMNS],
        F.coalesce(round_to(as_ms(max_us), 2), zero).alias("latency_max_ms"),
        F.coalesce(deepest.getField("queue_depth_max"), F.lit(0).cast("bigint")).alias("queue_depth_max"),
        F.coalesce(deepest.getField("queue_depth_avg"), zero).alias("queue_depth_avg"),
    )


def stream_summary(events: DataFrame, bucket_sec: int) -> DataFrame:
    """The summary over a table of events."""
    return summary_of(arrivals(events), backlog_depth(events, bucket_sec))


def _message_size(events: DataFrame) -> Column:
    """Length of the message an event came as: the column `size`, else that of its text `payload`, else 0."""
    if "size" in events.columns:
        return F.col("size")
    return F.length("payload") if "payload" in events.columns else F.lit(0)


def load_levels(events: DataFrame, bucket_sec: int, level: str = "load_level") -> DataFrame:
    """Producer and consumer figures for each target rate, of parsed events.

    Events without a usable stamp, undecodable ones among them, are sent, and errors, but not
    processed. Few keys hold all rows, so every aggregate combines on the map side.
    """
    rows = events.withColumns(
        {
            "target_rate": F.col(level),
            "stamp_ok": _stamp_ok(events),
            "latency_us": latency_us(),
            "size": _message_size(events),
        }
    )
    stamped = F.when(F.col("stamp_ok"), F.col("event_us"))
    keys = ["target_rate"]
    totals = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sent"),
        F.count_if(~F.col("stamp_ok")).alias("errors"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("bytes"),
        _seconds(F.min(stamped), F.max(stamped)).alias("sent_seconds"),
        F.count_if("stamp_ok").alias("processed"),
        _seconds(F.min("receive_us"), F.max("receive_us")).alias("seconds"),
    )
    latency = _report_percentiles(rows.where("stamp_ok"), keys)
    depth = depth_summary(backlog_depth(rows, bucket_sec, keys), keys)
    return (
        totals.join(latency, keys, "left")
        .join(depth, keys, "left")
        .select(
            "target_rate",
            "sent",
            "errors",
            "bytes",
            round_to(F.col("sent_seconds"), 2).alias("elapsed"),
            _per_second(F.col("sent"), F.col("sent_seconds")).alias("avg_rate"),
            "processed",
            _per_second(F.col("processed"), F.col("seconds")).alias("throughput"),
            *[F.coalesce(name, F.lit(0.0)).alias(name) for name in PERCENTILE_COLUMNS],
            "queue_depth_max",
        )
    )


def traffic_phases(
    events: DataFrame, start_s: int, duration_sec: int, base_rate: int, bucket_sec: int
) -> DataFrame:
    """Observed against planned rate for each time bucket of the run."""
    width = F.lit(bucket_sec * MICROS)
    bucket_us = F.col("event_us") - F.pmod(F.col("event_us"), width)
    fraction = (F.col("bucket_start_s") - F.lit(start_s)) / F.lit(float(duration_sec))
    return (
        events.groupBy((bucket_us / F.lit(MICROS)).cast("bigint").alias("bucket_start_s"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(
            "bucket_start_s",
            traffic.phase(fraction).alias("phase"),
            traffic.target_rate(fraction, base_rate).alias("target_rate"),
            "event_count",
            round_to(F.col("event_count") / F.lit(float(bucket_sec)), 6).alias("observed_rate"),
        )
    )


def run_metrics(
    spark: SparkSession,
    mode: str,
    partitions: int,
    input_rows: int,
    output_rows: int,
    seconds: float,
) -> DataFrame:
    """The run report as one row."""
    context = spark.sparkContext
    row = (
        mode,
        partitions,
        input_rows,
        output_rows,
        round(seconds, 3),
        context.master,
        context.applicationId,
        context.defaultParallelism,
    )
    return spark.createDataFrame([row], RUN_METRICS)
