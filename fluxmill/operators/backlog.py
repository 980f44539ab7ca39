"""Backlog depth over time: events enqueued and not yet dequeued."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fluxmill.functions.events import MICROS
from fluxmill.functions.numbers import round_to

# Buckets per block. Running sums order the buckets of one block, then the blocks.
BLOCK = 1024


def bucket_changes(events: DataFrame, bucket_sec: int, keys: list[str] | None = None) -> DataFrame:
    """Net change per bucket from one scan: +1 when an event is stamped, -1 when it is received."""
    keys = keys or []
    width = F.lit(bucket_sec * MICROS)

    def bucket(column: str):
        return ((F.col(column) - F.pmod(F.col(column), width)) / width).cast("bigint")

    steps = F.array(
        F.struct(bucket("event_us").alias("bucket"), F.lit(1).cast("bigint").alias("step")),
        F.struct(bucket("receive_us").alias("bucket"), F.lit(-1).cast("bigint").alias("step")),
    )
    return (
        events.select(*keys, F.inline(steps))
        .groupBy(*keys, "bucket")
        .agg(F.sum("step").alias("change"))
    )


def depth_of(changes: DataFrame, bucket_sec: int, keys: list[str] | None = None) -> DataFrame:
    """Depth at the end of each bucket in which it was touched, and for how many buckets it held.

    Columns (keys, bucket_start_s, depth, held_buckets). Quiet buckets are counted, not made, so a
    single stray stamp years away costs nothing.
    """
    keys = keys or []
    changes = changes.withColumn("block", F.floor(F.col("bucket") / BLOCK))
    key_columns = [F.col(k) for k in keys]
    in_block = Window.partitionBy(*key_columns, "block").orderBy("bucket")
    across = Window.partitionBy(*key_columns, F.lit(0)).orderBy("block")
    blocks = (
        changes.groupBy(*keys, "block")
        .agg(F.sum("change").alias("block_change"), F.min("bucket").alias("first_bucket"))
        .select(
            *[F.col(k).alias(f"block_{k}") for k in keys],
            F.col("block").alias("block_id"),
            (F.sum("block_change").over(across) - F.col("block_change")).alias("carried"),
            F.lead("first_bucket").over(across).alias("next_block_bucket"),
        )
    )
    # Null-safe, so that no null filter is pushed into one side and both sides share one exchange.
    same_block = F.col("block").eqNullSafe(F.col("block_id"))
    for key in keys:
        same_block = same_block & F.col(key).eqNullSafe(F.col(f"block_{key}"))
    following = F.coalesce("next_bucket", "next_block_bucket", F.col("bucket") + 1)
    return (
        changes.withColumns(
            {
                "within": F.sum("change").over(in_block),
                "next_bucket": F.lead("bucket").over(in_block),
            }
        )
        .join(blocks, same_block)
        .select(
            *keys,
            (F.col("bucket") * bucket_sec).alias("bucket_start_s"),
            (F.col("within") + F.col("carried")).alias("depth"),
            (following - F.col("bucket")).alias("held_buckets"),
        )
    )


def backlog_depth(events: DataFrame, bucket_sec: int, keys: list[str] | None = None) -> DataFrame:
    return depth_of(bucket_changes(events, bucket_sec, keys), bucket_sec, keys)


def depth_summary(depth: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Largest depth, and the mean over all buckets from the first to the last."""
    held = F.sum(F.col("depth") * F.col("held_buckets"))
    return depth.groupBy(*(keys or [])).agg(
        F.max("depth").alias("queue_depth_max"),
        round_to(F.try_divide(held, F.sum("held_buckets")), 2).alias("queue_depth_avg"),
    )
