"""Rows the live windows do not take: late, from the future, or undecodable. All are kept as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fluxmill.operators import windows as W
from fluxmill.schemas import struct
from fluxmill.streaming.windows import is_ahead

ASIDE_COLUMNS = ["reason", "event_id", "window_start_s", "event_us", "receive_us", "latency_us"]
ASIDES = struct(
    reason="string", event_id="string", window_start_s="long", event_us="long", receive_us="long", latency_us="long"
)


def append_writer(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A stateless branch into parquet; the sink's own log makes a replayed batch harmless."""
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def set_aside(events: DataFrame, window_sec: int, max_lag_sec: int, ahead_sec: int = 0) -> DataFrame:
    """Late rows and rows from the future, with the window they belong to."""
    rows = W.prepared(events, window_sec, max_lag_sec)
    reason = F.when(F.col("late"), "late").when(is_ahead(ahead_sec), "ahead")
    return rows.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(*ASIDE_COLUMNS)


def late_per_window(asides: DataFrame) -> DataFrame:
    late = asides.where(F.col("reason") == "late")
    return late.groupBy("window_start_s").agg(F.count(F.lit(1)).alias("late_count"))
