"""Tumbling windows on a stream, with state of fixed size per window.

Counts, sums and maxima are exact. Distinct users and percentiles are sketches here, because their
exact state would grow with a window's events; streaming.rollup gives them exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from fluxmill import constants as C
from fluxmill.functions.events import MICROS
from fluxmill.operators import windows as W
from fluxmill.schemas import struct
from fluxmill.sources import versions as V

SKETCH_ACCURACY = 10_000
USER_SKETCH_ERROR = 0.02
OTHER = "other"

TYPE_COLUMNS = [f"n_{t}" for t in [*C.EVENT_TYPES, C.UNKNOWN_TYPE, OTHER]]

WINDOW_STATE = struct(
    window_start_s="long",
    message_count="long",
    late_count="long",
    cart_sum="double",
    session_sum="double",
    session_n="long",
    views_sum="long",
    clicks_sum="long",
    latency_max_us="long",
    **{name: "long" for name in TYPE_COLUMNS},
    users_approx="long",
    latency_approx=T.ArrayType(T.LongType()),
)


def _type_counts() -> list[Column]:
    known = [*C.EVENT_TYPES, C.UNKNOWN_TYPE]
    counts = [F.count_if(F.col("event_type") == t).alias(f"n_{t}") for t in known]
    return [*counts, F.count_if(~F.col("event_type").isin(known)).alias(f"n_{OTHER}")]


def watermark_delay(window_sec: int, max_lag_sec: int, ahead_sec: int = 0) -> int:
    """Seconds an accepted event can trail the newest one; see is_late.

    An accepted event's window ends after (receive time - max(window, max_lag)). No event in the
    live windows is stamped more than ahead_sec after its receive time, so this delay keeps the
    watermark below that end and Spark drops none of them.
    """
    return max(window_sec, max_lag_sec) + ahead_sec


def is_ahead(ahead_sec: int) -> Column:
    """Stamped further in the future than allowed: such a row would push the watermark past others."""
    return F.col("event_us") > F.col("receive_us") + F.lit(ahead_sec * MICROS)


def window_aggregates(events: DataFrame, window_sec: int, max_lag_sec: int, ahead_sec: int) -> DataFrame:
    """Aggregates per window. Late rows and rows from the future are left to streaming.asides.

    `ahead_sec` has no default: it says how far ahead of its receive time a stamp may be. Rows beyond
    it are taken away here, so a run has to keep them with asides.set_aside and the same setting.
    """
    rows = W.accepted(W.prepared(events, window_sec, max_lag_sec)).drop("window_start_s")
    delay = watermark_delay(window_sec, max_lag_sec, ahead_sec)
    percents = [p / 100 for p in C.PERCENTS]
    return (
        rows.where(~is_ahead(ahead_sec))
        .withColumn("event_ts", F.timestamp_micros("event_us"))
        .withWatermark("event_ts", f"{delay} seconds")
        .groupBy(F.window("event_ts", f"{window_sec} seconds"))
        .agg(
            *W.named(W.additive()),
            *_type_counts(),
            F.approx_count_distinct("user_id", USER_SKETCH_ERROR).alias("users_approx"),
            F.percentile_approx("latency_us", percents, SKETCH_ACCURACY).alias("latency_approx"),
        )
        .select(F.unix_seconds("window.start").alias("window_start_s"), *WINDOW_STATE.fieldNames()[1:])
    )


def _versions_writer(aggregates: DataFrame, mode: str, path: str, checkpoint: str) -> DataStreamWriter:
    V.start_versions(aggregates.sparkSession, WINDOW_STATE, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        V.write_version(batch, path, batch_id)

    return aggregates.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)


def updates_writer(aggregates: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Each batch writes the windows it changed; readers take the latest version of a window."""
    return _versions_writer(aggregates, "update", path, checkpoint)


def closed_writer(aggregates: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Windows once each, when the watermark has passed their end."""
    return _versions_writer(aggregates, "append", path, checkpoint)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there, then stop; open windows have been written by then (update mode)."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """Current row of each window with the report columns."""
    current = V.latest(V.read_versions(spark, WINDOW_STATE, path), ["window_start_s"])
    sketch = [
        (F.col("latency_approx")[i] / F.lit(1000)).alias(f"latency_p{p}_ms_approx") for i, p in enumerate(C.PERCENTS)
    ]
    return current.select(
        "window_start_s",
        "message_count",
        *TYPE_COLUMNS,
        *[column.alias(name) for name, column in W.report_columns().items()],
        F.col("users_approx").alias("unique_users_approx"),
        *sketch,
    )
