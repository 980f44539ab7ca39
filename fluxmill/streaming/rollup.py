"""Exact reports from a stream, as rollup tables that each micro-batch adds to.

A batch contributes partial sums per (window, type), its distinct (window, user) pairs, its latency
counts and its backlog changes. All merge on read, so no state is held and nothing has to be kept
in memory per window; late rows are counted beside the others. Old batches are merged in place
(sources.versions), so the tables follow the distinct keys, not the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fluxmill import constants as C
from fluxmill.operators import windows as W
from fluxmill.operators.backlog import bucket_changes, depth_of
from fluxmill.operators.percentiles import floor_rank_percentiles
from fluxmill.operators.reports import summary_of
from fluxmill.schemas import struct
from fluxmill.sources import versions as V

SUMS = struct(
    window_start_s="long",
    event_type="string",
    message_count="long",
    late_count="long",
    cart_sum="double",
    session_sum="double",
    session_n="long",
    views_sum="long",
    clicks_sum="long",
    latency_max_us="long",
)
USERS = struct(window_start_s="long", user_id="long")
LATENCY = struct(
    window_start_s="long",
    late="boolean",
    stamp_ok="boolean",
    latency_us="long",
    n="long",
    first_receive_us="long",
    last_receive_us="long",
)
CHANGES = struct(bucket="long", change="long")
TABLES = {"sums": SUMS, "users": USERS, "latency": LATENCY, "changes": CHANGES}

EVENT_COLUMNS = [
    "window_start_s", "late", "stamp_ok", "latency_us", "event_us", "receive_us", "user_id",
    "event_type", "session_time", "page_views", "clicks", "cart_value",
]


def sums_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy("window_start_s", "event_type").agg(*W.named(W.additive()))


def _users(rows: DataFrame) -> DataFrame:
    return W.accepted(rows).select("window_start_s", "user_id").distinct()


def _latency(rows: DataFrame) -> DataFrame:
    return rows.groupBy("window_start_s", "late", "stamp_ok", "latency_us").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("receive_us").alias("first_receive_us"),
        F.max("receive_us").alias("last_receive_us"),
    )


def _merged_latency(rows: DataFrame) -> DataFrame:
    return rows.groupBy("window_start_s", "late", "stamp_ok", "latency_us").agg(
        F.sum("n").alias("n"),
        F.min("first_receive_us").alias("first_receive_us"),
        F.max("last_receive_us").alias("last_receive_us"),
    )


# How rows of several batches become fewer, in order of windows, so that readers skip parts by range.
MERGES = {
    "sums": lambda t: t.groupBy("window_start_s", "event_type").agg(*W.named(W.merged())),
    "users": lambda t: t.distinct(),
    "latency": _merged_latency,
    "changes": lambda t: t.groupBy("bucket").agg(F.sum("change").alias("change")),
}


def compact(spark: SparkSession, path: str, before: int, fanout: int = V.FANOUT) -> bool:
    """Merge folders of batches before `before`, see versions.compact; whether one was due."""
    done = False
    for name, schema in TABLES.items():

        def merge(rows: DataFrame, name: str = name, key: str = schema.fieldNames()[0]) -> DataFrame:
            return MERGES[name](rows).sortWithinPartitions(key)

        done |= V.compact(spark, schema, f"{path}/{name}", merge, before, fanout)
    return done


def start_rollup(spark: SparkSession, path: str) -> None:
    for name, schema in TABLES.items():
        V.start_versions(spark, schema, f"{path}/{name}")


def batch_rows(
    events: DataFrame, window_sec: int = C.WINDOW_SEC, max_lag_sec: int = C.MAX_LAG_SEC, keep: Sequence[str] = ()
) -> DataFrame:
    """Events as add_batch takes them, with the columns `keep` beside."""
    if "stamp_ok" not in events.columns:
        events = events.withColumn("stamp_ok", F.lit(True))
    return W.prepared(events, window_sec, max_lag_sec).select(*keep, *EVENT_COLUMNS)


def add_batch(rows: DataFrame, path: str, batch_id: int, bucket_sec: int) -> None:
    """Add the prepared rows of one micro-batch; doing so again replaces what it added.

    They are read once for each table, so persist them when they are costly to make (parsed text).
    """
    V.write_version(sums_of(rows), f"{path}/sums", batch_id)
    V.write_version(_users(rows), f"{path}/users", batch_id)
    V.write_version(_latency(rows), f"{path}/latency", batch_id)
    V.write_version(bucket_changes(rows, bucket_sec), f"{path}/changes", batch_id)


def rollup_writer(
    events: DataFrame,
    path: str,
    checkpoint: str,
    window_sec: int = C.WINDOW_SEC,
    max_lag_sec: int = C.MAX_LAG_SEC,
    bucket_sec: int = 1,
    after: Callable[[DataFrame, int], None] | None = None,
) -> DataStreamWriter:
    """`bucket_sec` is the grain of the backlog report. `after` gets the rows and number of each batch once added."""
    spark = events.sparkSession
    start_rollup(spark, path)
    rows = batch_rows(events, window_sec, max_lag_sec)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            add_batch(batch, path, batch_id, bucket_sec)
            if after:
                after(batch, batch_id)
        finally:
            batch.unpersist()
        compact(spark, path, batch_id)

    return rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return V.read_versions(spark, TABLES[name], f"{path}/{name}")


def read_windows(
    spark: SparkSession,
    path: str,
    window_sec: int = C.WINDOW_SEC,
    only: Callable[[DataFrame], DataFrame] | None = None,
    keep_start: bool = False,
) -> DataFrame:
    """The same 13 columns as the batch window report. `only` restricts each table to the windows wanted."""
    sums, users, latency = (
        only(t) if only else t for t in (read_table(spark, path, name) for name in ("sums", "users", "latency"))
    )
    per_type = sums.groupBy("window_start_s", "event_type").agg(*W.named(W.merged()))
    distinct = W.unique_users(users.withColumn("late", F.lit(False)))
    ranked = floor_rank_percentiles(W.accepted(latency), ["window_start_s"], "latency_us", C.PERCENTS, weight="n")
    return W.assembled(W.per_window(per_type), distinct, ranked, window_sec=window_sec, keep_start=keep_start)


def read_summary(spark: SparkSession, path: str, bucket_sec: int = 1) -> DataFrame:
    """The same row as the batch stream summary."""
    changes = read_table(spark, path, "changes").groupBy("bucket").agg(F.sum("change").alias("change"))
    return summary_of(read_table(spark, path, "latency"), depth_of(changes, bucket_sec))
