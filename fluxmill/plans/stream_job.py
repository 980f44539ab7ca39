"""The stream run: event files in, live windows, exact reports and set-aside rows out."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from fluxmill import constants as C
from fluxmill.functions.numbers import round_to
from fluxmill.operators import reports
from fluxmill.operators.dedup import stream_dedup
from fluxmill.operators.imputation import as_scalar
from fluxmill.schemas import CORRUPT_COLUMN, LOAD_LEVELS, struct
from fluxmill.sources import event_files as EF
from fluxmill.sources import versions as V
from fluxmill.sources.tables import write_report
from fluxmill.streaming import asides, published, recent, rollup, sketches
from fluxmill.streaming import windows as live
from fluxmill.streaming.progress import progress_rows
from fluxmill.workspace import remove, scratch

BACKLOG_BUCKET_SEC = 1
CONSUMED_FILES = 10_000
QUARANTINE = struct(**{"receive_us": "long", CORRUPT_COLUMN: "string"})


@dataclass
class StreamRun:
    """Settings of a run. Each query of it keeps its own checkpoint under `output`.

    `publish` writes each window as soon as it is final, with corrections by late events, while the
    job runs. `exact` false keeps sketches of users and latencies instead of all of them. `recent_rows`
    limits the latencies of the summary to the latest so many. `consume` deletes event files once they
    are processed. `live_windows` adds a second query with Spark's own window state, which also shows
    open windows; not with `consume` or `dedup_sec`.
    """

    source: str
    output: str
    window_sec: int = C.WINDOW_SEC
    max_lag_sec: int = C.MAX_LAG_SEC
    glob: str = EF.EVENT_GLOB
    files_per_trigger: int | None = None
    dedup_sec: int | None = None
    live_windows: bool = False
    consume: bool = False
    publish: bool = True
    exact: bool = True
    recent_rows: int | None = None

    def path(self, name: str) -> str:
        return f"{self.output}/{name}"


def _tables(run: StreamRun):
    return rollup if run.exact else sketches


def _exact_writer(events: DataFrame, run: StreamRun) -> DataStreamWriter:
    """Everything without state in one query, so that each file is read and decoded once for it."""
    spark = events.sparkSession
    tables = _tables(run)
    (rollup.start_rollup if run.exact else sketches.start_sketches)(spark, run.path("rollup"))
    V.start_versions(spark, asides.ASIDES, run.path("asides"))
    V.start_versions(spark, QUARANTINE, run.path("quarantine"))
    if run.publish:
        published.start_published(spark, run.path("published"))
    if run.recent_rows:
        recent.start_recent(spark, run.path("recent"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            keep(batch, batch_id)
        finally:
            batch.unpersist()
        merge(batch_id)

    def keep(batch: DataFrame, batch_id: int) -> None:
        good = EF.decoded_only(batch)
        rows = rollup.batch_rows(good, run.window_sec, run.max_lag_sec)
        tables.add_batch(rows, run.path("rollup"), batch_id, BACKLOG_BUCKET_SEC)
        if run.recent_rows:
            recent.add_batch(good, run.path("recent"), batch_id, run.recent_rows)
        kept = asides.set_aside(good, run.window_sec, run.max_lag_sec, run.max_lag_sec)
        V.write_version(kept, run.path("asides"), batch_id)
        corrupt = EF.quarantined(batch).select(*QUARANTINE.fieldNames())
        V.write_version(corrupt, run.path("quarantine"), batch_id)
        if run.publish:
            published.publish_batch(
                rows, run.path("rollup"), run.path("published"), batch_id, run.window_sec, run.max_lag_sec, run.exact
            )

    def merge(before: int) -> None:
        tables.compact(spark, run.path("rollup"), before)
        V.compact(spark, asides.ASIDES, run.path("asides"), lambda rows: rows, before)
        V.compact(spark, QUARANTINE, run.path("quarantine"), lambda rows: rows, before)
        if run.publish:
            published.compact(spark, run.path("published"), before)
        if run.recent_rows:
            recent.compact(spark, run.path("recent"), before, run.recent_rows)

    checkpoint = run.path("checkpoints/exact")
    return events.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)


def _writers(spark: SparkSession, run: StreamRun) -> dict[str, DataStreamWriter]:
    clean = "delete" if run.consume else "off"
    lines = EF.stream_events(spark, run.source, run.glob, run.files_per_trigger, clean)
    events = EF.parse_events(EF.received_now(lines))
    exact = stream_dedup(events, run.dedup_sec) if run.dedup_sec else events
    writers = {"exact": _exact_writer(exact, run)}
    # A second stateful step after dedup is not allowed in update mode, so live windows need raw input.
    if run.live_windows and not run.dedup_sec and not run.consume:
        aggregates = live.window_aggregates(
            EF.decoded_only(events), run.window_sec, run.max_lag_sec, ahead_sec=run.max_lag_sec
        )
        writers["live"] = live.updates_writer(aggregates, run.path("live"), run.path("checkpoints/live"))
    return writers


def _finished(spark: SparkSession, run: StreamRun, queries: dict[str, StreamingQuery], started: float) -> None:
    seconds = spark.createDataFrame([(time.time() - started,)], "seconds double")
    seconds.write.mode("append").parquet(run.path("runs"))
    progress = [
        progress_rows(spark, query).withColumn("query", F.lit(name)) for name, query in queries.items()
    ]
    write_report(reduce(DataFrame.unionByName, progress), run.path("progress"))
    with scratch(spark, "reports"):
        windows = _tables(run).read_windows(spark, run.path("rollup"), run.window_sec)
        windows.write.mode("overwrite").json(run.path("window_metrics"))
        write_report(summary(spark, run), run.path("summary"))


def summary(spark: SparkSession, run: StreamRun) -> DataFrame:
    """The summary of a finished run and of those it went on from.

    Elapsed time is the time they took, as receive times are those of whole micro-batches.
    Undecodable lines count as errors too.
    """
    corrupt = V.read_versions(spark, QUARANTINE, run.path("quarantine")).count()
    if run.recent_rows:
        paths = run.path("rollup"), run.path("recent")
        row = recent.read_summary(spark, *paths, run.recent_rows, BACKLOG_BUCKET_SEC, run.exact)
    else:
        row = _tables(run).read_summary(spark, run.path("rollup"), BACKLOG_BUCKET_SEC)
    runs = spark.read.schema("seconds double").parquet(run.path("runs"))
    seconds = as_scalar(runs.agg(F.sum("seconds").alias("seconds"))).getField("seconds")
    return row.withColumns(
        {
            "total_errors": F.col("total_errors") + F.lit(corrupt),
            "elapsed_sec": round_to(seconds, 2),
            "throughput_per_s": round_to(F.col("total_processed") / F.greatest(seconds, F.lit(0.001)), 1),
        }
    )


def run_for(spark: SparkSession, run: StreamRun, seconds: int, interval: str = "10 seconds") -> None:
    """Run on a processing-time trigger for `seconds` (0: until stopped), then write the reports.

    The reports are written however the run ends: by time, by stop() of a query from outside, by an
    interrupt or by a failure, which is raised afterwards.
    """
    started = time.time()
    queries = {
        name: writer.trigger(processingTime=interval).start() for name, writer in _writers(spark, run).items()
    }
    deadline = started + seconds if seconds else None
    try:
        while all(query.isActive for query in queries.values()):
            if deadline and time.time() >= deadline:
                break
            time.sleep(0.2)
        failed = [query.exception() for query in queries.values() if query.exception()]
        if failed:
            raise failed[0]
    finally:
        for query in queries.values():
            query.stop()
        _finished(spark, run, queries, started)


def run_available(spark: SparkSession, run: StreamRun) -> None:
    """Process what is there and write the reports. A later call goes on from the checkpoints."""
    started = time.time()
    queries = {
        name: writer.trigger(availableNow=True).start() for name, writer in _writers(spark, run).items()
    }
    for query in queries.values():
        query.awaitTermination()
    _finished(spark, run, queries, started)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, in whatever store the path names."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def land_load_lines(
    spark: SparkSession,
    source: str,
    output: str,
    glob: str = EF.EVENT_GLOB,
    files_per_trigger: int | None = None,
    consume: bool = False,
) -> DataFrame:
    """The lines of all load directories that have not been read before, added to a table; the whole table.

    One stream reads all directories, so small files of any number become few large ones, once each.
    `consume` deletes files once they are in the table. Spark deletes those of a batch when the next
    one begins; what the last batch has read, CONSUMED_FILES at most by default, is deleted here.
    """
    files_per_trigger = files_per_trigger or (CONSUMED_FILES if consume else None)
    path = f"{output}/lines"
    V.start_versions(spark, EF.LOAD_LINES, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        V.write_version(batch, path, batch_id)
        V.compact(spark, EF.LOAD_LINES, path, lambda lines: lines, batch_id)

    lines = EF.stream_load_lines(spark, source, glob, files_per_trigger, consume)
    writer = lines.writeStream.option("checkpointLocation", f"{output}/checkpoints/lines").foreachBatch(write)
    live.run_available(writer)
    landed = V.read_versions(spark, EF.LOAD_LINES, path)
    if consume:
        last = landed.agg(F.max(V.BATCH)).first()[0]
        for row in landed.where(F.col(V.BATCH) == last).select("file").distinct().toLocalIterator():
            remove(spark, row.file)
    return landed.drop(V.BATCH)


def run_load_test(
    spark: SparkSession, source: str, output: str, rates: list[int] | None = None, **settings
) -> DataFrame:
    """One report row per load_<rate> directory, read as one source; of `rates` only if given.

    A file's time is the time its events were received. `settings` are those of land_load_lines.
    """
    if not _exists(spark, f"{source}/{EF.LOAD_DIRECTORIES}"):
        raise ValueError(f"no load_<rate> directory in {source}")
    lines = land_load_lines(spark, source, output, **settings)
    if rates:
        lines = lines.where(F.col("target_rate").isin(rates))
    with scratch(spark, "load-levels"):
        report = reports.load_levels(EF.load_events(lines), BACKLOG_BUCKET_SEC)
        write_report(report, f"{output}/load_levels")
    return spark.read.schema(LOAD_LEVELS).json(f"{output}/load_levels")
