"""The most recent latencies kept along the stream: a bounded table that each micro-batch adds its own latest rows to.

A batch adds its `rows` latest events by (receive time, event id). The latest of all are among
those, so the table is folded to `rows` rows on read, and when old folders are merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxmill import constants as C
from fluxmill.operators import reports
from fluxmill.operators.backlog import depth_of
from fluxmill.operators.percentiles import as_ms, floor_rank_percentiles
from fluxmill.schemas import struct
from fluxmill.sources import versions as V
from fluxmill.streaming import rollup, sketches
from fluxmill.workspace import scratch

RECENT = struct(event_id="string", receive_us="long", latency_us="long")


def start_recent(spark: SparkSession, path: str) -> None:
    V.start_versions(spark, RECENT, path)


def add_batch(events: DataFrame, path: str, batch_id: int, rows: int) -> None:
    """Add the latest rows of a micro-batch; those without a usable stamp have no latency and are left out."""
    good = events.where("stamp_ok") if "stamp_ok" in events.columns else events
    with scratch(events.sparkSession, "recent"):
        latest = reports.recent_latency(good.withColumn("event_id", F.col("event_id").cast("string")), rows)
        V.write_version(latest, path, batch_id)


def _latest(table: DataFrame, rows: int) -> DataFrame:
    """A table of few rows per batch is folded; reports.recent_latency does the same for whole event tables."""
    return table.select(*RECENT.fieldNames()).orderBy(F.desc("receive_us"), F.desc("event_id")).limit(rows)


def compact(spark: SparkSession, path: str, before: int, rows: int, fanout: int = V.FANOUT) -> bool:
    return V.compact(spark, RECENT, path, lambda table: _latest(table, rows), before, fanout)


def read_recent(spark: SparkSession, path: str, rows: int) -> DataFrame:
    """The latest `rows` events, newest first; ids are text, and ties go by them."""
    return _latest(V.read_versions(spark, RECENT, path), rows)


def read_summary(
    spark: SparkSession, rollup_path: str, path: str, rows: int, bucket_sec: int = 1, exact: bool = True
) -> DataFrame:
    """The stream summary with percentiles and maximum over the latest `rows` latencies; counts are over all.

    `exact` false: rollup_path holds the tables of streaming.sketches.
    """
    latest = read_recent(spark, path, rows).withColumn("all", F.lit(1))
    found = floor_rank_percentiles(latest, ["all"], "latency_us", C.PERCENTS)
    percentiles = found.select(*[as_ms(F.col(f"p{p}")).alias(f"latency_p{p}_ms") for p in C.PERCENTS])
    changes = rollup.MERGES["changes"](rollup.read_table(spark, rollup_path, "changes"))
    arrived = (
        rollup.read_table(spark, rollup_path, "latency") if exact else sketches.read_table(spark, rollup_path, "sketches")
    )
    return reports.summary_from(
        arrived,
        percentiles,
        F.lit(None),
        depth_of(changes, bucket_sec),
        top=latest.agg(F.max("latency_us").alias("max_us")),
    )
