"""Window reports from mergeable sketches: fixed size per window, whatever the number of events and users.

The exact rollup keeps a row per latency and per (window, user), a second copy of the stream in the
worst case. Here a batch adds one row per (window, late or not, stamp usable or not): a KLL sketch of
its latencies and a theta sketch of its users. Both merge over batches, windows and runs, on read and
when old folders are merged. Counts, sums and maxima stay exact, in the table of the rollup.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxmill import constants as C
from fluxmill.operators import windows as W
from fluxmill.operators.backlog import bucket_changes, depth_of
from fluxmill.operators.percentiles import as_ms
from fluxmill.operators.reports import summary_from
from fluxmill.schemas import struct
from fluxmill.sources import versions as V
from fluxmill.streaming import rollup

# Rank error of a latency percentile: below RANK_ERROR with 99 % confidence for this k.
LATENCY_K = 1600
RANK_ERROR = 0.003
# Relative error of distinct users: three standard errors of 2^USER_LOG entries. Fewer users are exact.
USER_LOG = 14
USER_ERROR = 3 / 2 ** (USER_LOG / 2)

SKETCHES = struct(
    window_start_s="long",
    late="boolean",
    stamp_ok="boolean",
    n="long",
    first_receive_us="long",
    last_receive_us="long",
    latency_max_us="long",
    without_user="integer",
    latency="binary",
    users="binary",
)
TABLES = {"sums": rollup.SUMS, "sketches": SKETCHES, "changes": rollup.CHANGES}
KEYS = ["window_start_s", "late", "stamp_ok"]


def _sketched(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("receive_us").alias("first_receive_us"),
        F.max("receive_us").alias("last_receive_us"),
        F.max("latency_us").alias("latency_max_us"),
        F.max(F.col("user_id").isNull().cast("int")).alias("without_user"),
        F.kll_sketch_agg_bigint("latency_us", LATENCY_K).alias("latency"),
        F.theta_sketch_agg("user_id", USER_LOG).alias("users"),
    )


def _merges() -> dict[str, Column]:
    return {
        "n": F.sum("n"),
        "first_receive_us": F.min("first_receive_us"),
        "last_receive_us": F.max("last_receive_us"),
        "latency_max_us": F.max("latency_max_us"),
        "without_user": F.max("without_user"),
        "latency": F.kll_merge_agg_bigint("latency", LATENCY_K),
        "users": F.theta_union_agg("users", USER_LOG),
    }


def merged(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sketch rows to one per key."""
    return rows.groupBy(*(KEYS if keys is None else keys)).agg(*W.named(_merges()))


def start_sketches(spark: SparkSession, path: str) -> None:
    for name, schema in TABLES.items():
        V.start_versions(spark, schema, f"{path}/{name}")


def add_batch(rows: DataFrame, path: str, batch_id: int, bucket_sec: int = 1) -> None:
    """Add the rows of a micro-batch (rollup.batch_rows); doing so again replaces what it added."""
    V.write_version(rollup.sums_of(rows), f"{path}/sums", batch_id)
    V.write_version(_sketched(rows), f"{path}/sketches", batch_id)
    V.write_version(bucket_changes(rows, bucket_sec), f"{path}/changes", batch_id)


def compact(spark: SparkSession, path: str, before: int, fanout: int = V.FANOUT) -> bool:
    """Merge folders of batches before `before`: at most four sketch rows a window are left of them."""
    done = False
    for name, schema in TABLES.items():
        merge = merged if name == "sketches" else rollup.MERGES[name]
        done |= V.compact(spark, schema, f"{path}/{name}", merge, before, fanout)
    return done


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return V.read_versions(spark, TABLES[name], f"{path}/{name}")


def latency_at(percent: int, sketch: Column) -> Column:
    """The latency at a percentile in microseconds; null of a null or empty sketch."""
    return F.when(F.kll_sketch_get_n_bigint(sketch) > 0, F.kll_sketch_get_quantile_bigint(sketch, F.lit(percent / 100)))


def read_windows(
    spark: SparkSession,
    path: str,
    window_sec: int = C.WINDOW_SEC,
    only: Callable[[DataFrame], DataFrame] | None = None,
    keep_start: bool = False,
) -> DataFrame:
    """The 13 columns of the window report, all windows or `only` some.

    Users and the three percentiles are estimates, see RANK_ERROR and USER_ERROR.
    """
    sums, parts = (only(t) if only else t for t in (read_table(spark, path, name) for name in ("sums", "sketches")))
    per_type = sums.groupBy("window_start_s", "event_type").agg(*W.named(W.merged()))
    estimates = merged(W.accepted(parts), ["window_start_s"]).select(
        "window_start_s",
        (F.theta_sketch_estimate("users") + F.col("without_user")).cast("bigint").alias("unique_users"),
        *[latency_at(p, F.col("latency")).alias(f"p{p}") for p in C.PERCENTS],
    )
    return W.assembled(W.per_window(per_type), estimates, window_sec=window_sec, keep_start=keep_start)


def read_summary(spark: SparkSession, path: str, bucket_sec: int = 1) -> DataFrame:
    """The row of the stream summary; the three percentiles are estimates."""
    parts = read_table(spark, path, "sketches")
    depth = depth_of(rollup.MERGES["changes"](read_table(spark, path, "changes")), bucket_sec)
    found = merged(parts.where("stamp_ok"), []).select(
        *[as_ms(latency_at(p, F.col("latency"))).alias(f"latency_p{p}_ms") for p in C.PERCENTS]
    )
    return summary_from(parts, found, F.col("latency_max_us"), depth)


def distinct_users(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Distinct users of accepted events over all windows of one or several runs: one row, unique_users."""
    parts = [W.accepted(read_table(spark, path, "sketches")).select("users", "without_user") for path in paths]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionAll(part)
    estimate = F.theta_sketch_estimate(F.theta_union_agg("users", USER_LOG))
    everyone = F.coalesce(estimate, F.lit(0)) + F.coalesce(F.max("without_user"), F.lit(0))
    return union.agg(everyone.cast("bigint").alias("unique_users"))
