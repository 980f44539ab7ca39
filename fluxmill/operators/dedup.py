"""Removal of replayed events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_events(events: DataFrame) -> DataFrame:
    """The first received copy of each event_id; events without an id are all kept.

    The smallest row per id, receive time first: copies combine on the map side, and the choice
    does not depend on the order in which partitions arrive.
    """
    rest = [c for c in events.columns if c not in ("event_id", "receive_us")]
    first = F.min(F.struct("receive_us", *rest)).alias("first")
    anonymous = F.when(F.col("event_id").isNull(), F.monotonically_increasing_id()).alias("anonymous")
    return events.groupBy("event_id", anonymous).agg(first).select("event_id", "first.*").select(*events.columns)


def stream_dedup(events: DataFrame, delay_sec: int, salts: int = 1) -> DataFrame:
    """The same on a stream: an id is remembered for `delay_sec` of receive time.

    The watermark follows the receive time, which neither lags nor leads, so late events and
    events with a clock ahead pass and are counted where they belong. With `salts` above 1,
    copies of one id are thinned within as many groups of input partitions first, for streams in
    which one id has a large share of a batch; that costs a second state store.
    """
    seen = events.withColumns(
        {
            "receive_ts": F.timestamp_micros("receive_us"),
            "anonymous": F.when(F.col("event_id").isNull(), F.uuid()),
        }
    ).withWatermark("receive_ts", f"{delay_sec} seconds")
    if salts > 1:
        seen = (
            seen.withColumn("salt", F.spark_partition_id() % salts)
            .dropDuplicatesWithinWatermark(["event_id", "anonymous", "salt"])
            .drop("salt")
        )
    return seen.dropDuplicatesWithinWatermark(["event_id", "anonymous"]).drop("receive_ts", "anonymous")
