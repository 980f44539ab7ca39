"""Window rows published while the stream runs, as a log of changes.

A window is final once the receive clock is past its end by max(window, allowed lag): every event that
comes later is late for it. Each micro-batch publishes the windows that became final with it, once.
What a later event changes in a published window (its late count, or a window of late events alone) is
published as the old row taken back and the new one added.

The rows come from the rollup tables. Log and marks are version tables: a batch that is replayed writes
the same rows again in place of its own, and a batch counts only once its mark is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxmill import constants as C
from fluxmill.functions.events import MICROS
from fluxmill.schemas import WINDOW_METRICS, struct
from fluxmill.sources import versions as V
from fluxmill.streaming import rollup, sketches
from fluxmill.workspace import scratch, stored

LOG = struct(
    window_start_s="long",
    **{f.name: "string" if f.name == "event_counts" else f.dataType for f in WINDOW_METRICS.fields},
    change="integer",
)
MARKS = struct(clock_us="long", final_s="long")


def start_published(spark: SparkSession, path: str) -> None:
    V.start_versions(spark, LOG, f"{path}/log")
    V.start_versions(spark, MARKS, f"{path}/marks")


def _marks(spark: SparkSession, path: str) -> DataFrame:
    return V.read_versions(spark, MARKS, f"{path}/marks")


def changes(spark: SparkSession, path: str) -> DataFrame:
    """The log: rows added (change 1) and taken back (-1), with the batch that did so."""
    last = _marks(spark, path).agg(F.coalesce(F.max(V.BATCH), F.lit(V.START_BATCH))).first()[0]
    return V.read_versions(spark, LOG, f"{path}/log").where(F.col(V.BATCH) <= last)


def folded(log: DataFrame) -> DataFrame:
    """The rows that stand: what was added and not taken back."""
    columns = [name for name in LOG.fieldNames() if name != "change"]
    return log.groupBy(*columns).agg(F.sum("change").cast("int").alias("change")).where("change <> 0")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The published windows as they stand now; event_counts is JSON text."""
    return folded(changes(spark, path)).drop("window_start_s", "change")


def publish_batch(
    rows: DataFrame,
    rollup_path: str,
    path: str,
    batch_id: int,
    window_sec: int = C.WINDOW_SEC,
    max_lag_sec: int = C.MAX_LAG_SEC,
    exact: bool = True,
) -> None:
    """Publish what the prepared rows of a micro-batch make final or change; they are in the rollup already.

    `exact` false: rollup_path holds the tables of streaming.sketches.
    Receive times may go back from batch to batch: an event accepted for a published window replaces
    its row as well. Work per batch follows the windows touched, not those published before. Its
    scratch tables go at its end.
    """
    with scratch(rows.sparkSession, "publish"):
        _publish(rows, rollup_path, path, batch_id, window_sec, max_lag_sec, rollup if exact else sketches)


def _publish(
    rows: DataFrame, rollup_path: str, path: str, batch_id: int, window_sec: int, max_lag_sec: int, tables
) -> None:
    spark = rows.sparkSession
    earlier = _marks(spark, path).where(F.col(V.BATCH) < batch_id)
    before = earlier.agg(F.max("clock_us").alias("clock_us"), F.max("final_s").alias("final_s")).first()
    newest = rows.agg(F.max("receive_us")).first()[0]
    known = [t for t in (before.clock_us, newest) if t is not None]
    clock = max(known) if known else None
    wait = window_sec + max(window_sec, max_lag_sec)
    final = None if clock is None else clock // MICROS - wait
    start = F.col("window_start_s")
    touched = rows.select("window_start_s").where(start <= F.lit(before.final_s)).distinct()
    closing = rollup.read_table(spark, rollup_path, "sums").select("window_start_s").where(start <= F.lit(final))
    if before.final_s is not None:
        closing = closing.where(start > before.final_s)
    wanted = stored(touched.unionAll(closing).distinct(), "windows")
    low = wanted.agg(F.min("window_start_s")).first()[0]
    if low is None:
        added = spark.createDataFrame([], LOG)
        taken = added
    else:

        def only(table: DataFrame) -> DataFrame:
            return table.where(start >= low).join(wanted, "window_start_s", "left_semi")

        report = tables.read_windows(spark, rollup_path, window_sec, only, keep_start=True)
        added = report.withColumns({"event_counts": F.to_json("event_counts"), "change": F.lit(1)})
        log = V.read_versions(spark, LOG, f"{path}/log").where(F.col(V.BATCH) < batch_id)
        taken = folded(only(log)).withColumn("change", -F.col("change"))
    names = LOG.fieldNames()
    V.write_version(added.select(*names).unionAll(taken.select(*names)), f"{path}/log", batch_id)
    mark = [F.lit(value).cast("bigint").alias(name) for name, value in (("clock_us", clock), ("final_s", final))]
    V.write_version(spark.range(1, numPartitions=1).select(*mark), f"{path}/marks", batch_id)


def compact(spark: SparkSession, path: str, before: int, fanout: int = V.FANOUT) -> bool:
    """Merge folders of batches before `before`: a log folder keeps what stands at its end."""

    def newest(marks: DataFrame) -> DataFrame:
        return marks.agg(F.max("clock_us").alias("clock_us"), F.max("final_s").alias("final_s"))

    done = V.compact(spark, LOG, f"{path}/log", lambda rows: folded(rows).sortWithinPartitions("window_start_s"), before, fanout)
    return V.compact(spark, MARKS, f"{path}/marks", newest, before, fanout) or done
