"""Progress of a running query as rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS = (
    "batch_id bigint, num_input_rows bigint, processed_rows_per_second double,"
    " trigger_ms bigint, state_rows bigint, watermark string"
)


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent trigger (Spark keeps a fixed number of them)."""
    rows = []
    for entry in query.recentProgress:
        report = entry if isinstance(entry, dict) else json.loads(entry.json)
        states = report.get("stateOperators") or []
        rows.append(
            (
                int(report["batchId"]),
                int(report.get("numInputRows") or 0),
                float(report.get("processedRowsPerSecond") or 0.0),
                int((report.get("durationMs") or {}).get("triggerExecution", 0)),
                sum(int(s.get("numRowsTotal", 0)) for s in states),
                (report.get("eventTime") or {}).get("watermark"),
            )
        )
    return spark.createDataFrame(rows, PROGRESS)
