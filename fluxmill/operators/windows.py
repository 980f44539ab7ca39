"""Tumbling-window metrics over parsed events.

Input rows carry window_start_s, late, latency_us and the event fields (see prepared()). Counts and
sums are aggregated per (window, event type) first and then per window, both with map-side combine,
so a window with a third of all rows costs no more than any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxmill import constants as C
from fluxmill.functions import events as E
from fluxmill.functions.numbers import round_to, steady
from fluxmill.operators.percentiles import as_ms, floor_rank_percentiles


def with_type(events: DataFrame) -> DataFrame:
    return events.withColumn("event_type", F.coalesce(F.col("event_type"), F.lit(C.UNKNOWN_TYPE)))


def prepared(events: DataFrame, window_sec: int, max_lag_sec: int) -> DataFrame:
    """Window, lateness and latency of each event."""
    return with_type(events).withColumns(
        {
            "window_start_s": E.window_start_s(F.col("event_us"), window_sec),
            "late": E.is_late(window_sec, max_lag_sec),
            "latency_us": E.latency_us(),
        }
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("late"))


# -- column expressions shared by batch windows, stream windows and the rollup --

def cart_sum() -> Column:
    return F.sum(F.when(F.col("cart_value") > 0, F.col("cart_value")))


def session_sum() -> Column:
    return F.sum(F.nullif(F.col("session_time"), F.lit(0.0)))


def session_count() -> Column:
    return F.count(F.nullif(F.col("session_time"), F.lit(0.0)))


def additive() -> dict[str, Column]:
    """Aggregates that can be summed (or maximised) again at a coarser grain.

    Late rows count in late_count only, so one pass serves both.
    """
    on_time = ~F.col("late")

    def of(column: str) -> Column:
        return F.when(on_time, F.col(column))

    return {
        "message_count": F.count_if(on_time),
        "late_count": F.count_if("late"),
        "cart_sum": F.sum(F.when(on_time & (F.col("cart_value") > 0), F.col("cart_value"))),
        "session_sum": F.sum(F.nullif(of("session_time"), F.lit(0.0))),
        "session_n": F.count(F.nullif(of("session_time"), F.lit(0.0))),
        "views_sum": F.sum(of("page_views")).cast("bigint"),
        "clicks_sum": F.sum(of("clicks")).cast("bigint"),
        "latency_max_us": F.max(of("latency_us")),
    }


def merged() -> dict[str, Column]:
    """The same aggregates over partial rows."""
    return {
        name: (F.max(name) if name == "latency_max_us" else F.sum(name)) for name in additive()
    }


def named(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def total_cart_value(total: Column) -> Column:
    return round_to(F.coalesce(total, F.lit(0.0)), 2)


def avg_session_time(total: Column, count: Column) -> Column:
    return round_to(F.coalesce(F.try_divide(steady(total), count), F.lit(0.0)), 3)


def click_through_rate(clicks: Column, views: Column) -> Column:
    return round_to(F.when(views > 0, clicks / views).otherwise(F.lit(0.0)), 4)


def report_columns() -> dict[str, Column]:
    """Rounded report values from the additive columns."""
    return {
        "total_cart_value": total_cart_value(F.col("cart_sum")),
        "avg_session_time": avg_session_time(F.col("session_sum"), F.col("session_n")),
        "click_through_rate": click_through_rate(F.col("clicks_sum"), F.col("views_sum")),
        "latency_max_ms": F.coalesce(as_ms(F.col("latency_max_us")), F.lit(0.0)),
    }


def type_map() -> Column:
    """Counts by type as one map, ordered by type; types with late events only are left out."""
    entries = F.collect_list(F.when(F.col("message_count") > 0, F.struct("event_type", "message_count")))
    return F.map_from_entries(F.array_sort(entries))


# -- one operator per metric --

def window_counts(rows: DataFrame) -> DataFrame:
    return accepted(rows).groupBy("window_start_s").agg(F.count(F.lit(1)).alias("message_count"))


def late_counts(rows: DataFrame) -> DataFrame:
    """Accepted and late events of each event-time window, including windows with late ones only."""
    return rows.groupBy("window_start_s").agg(
        F.count_if(~F.col("late")).alias("message_count"),
        F.count_if(F.col("late")).alias("late_count"),
    )


def unique_users(rows: DataFrame) -> DataFrame:
    """Distinct users; all events without a user count as one more.

    Spark groups by (window, user) before it counts, so no task holds a window's users.
    """
    return accepted(rows).groupBy("window_start_s").agg(
        (F.count_distinct("user_id") + F.max(F.col("user_id").isNull().cast("int"))).alias("unique_users")
    )


def event_counts(rows: DataFrame) -> DataFrame:
    """Long form: one row per window and type."""
    return accepted(rows).groupBy("window_start_s", "event_type").agg(F.count(F.lit(1)).alias("event_count"))


def window_cart(rows: DataFrame) -> DataFrame:
    return accepted(rows).groupBy("window_start_s").agg(total_cart_value(cart_sum()).alias("total_cart_value"))


def window_session(rows: DataFrame) -> DataFrame:
    return accepted(rows).groupBy("window_start_s").agg(
        avg_session_time(session_sum(), session_count()).alias("avg_session_time")
    )


def window_ctr(rows: DataFrame) -> DataFrame:
    return accepted(rows).groupBy("window_start_s").agg(
        click_through_rate(F.sum("clicks"), F.sum("page_views")).alias("click_through_rate")
    )


def percentile_ms(found: DataFrame) -> list[Column]:
    return [as_ms(found[f"p{p}"]).alias(f"latency_p{p}_ms") for p in C.PERCENTS]


def window_latency(rows: DataFrame) -> DataFrame:
    keys = ["window_start_s"]
    good = accepted(rows)
    found = floor_rank_percentiles(good, keys, "latency_us", C.PERCENTS)
    top = good.groupBy(*keys).agg(as_ms(F.max("latency_us")).alias("latency_max_ms"))
    return found.select(*keys, *percentile_ms(found)).join(top, keys)


# -- the whole window row --

def assembled(parts: DataFrame, *others: DataFrame, window_sec: int, keep_start: bool = False) -> DataFrame:
    """The 13 report columns from per-window parts; windows with late events only show zeros.

    `keep_start` adds window_start_s, the key of the parts.
    """
    joined = reduce(lambda left, right: left.join(right, "window_start_s", "left"), others, parts)
    start = F.col("window_start_s")
    rounded = report_columns()
    return joined.select(
        *(["window_start_s"] if keep_start else []),
        E.iso_utc(start).alias("window_start"),
        E.iso_utc(start + window_sec).alias("window_end"),
        "message_count",
        "late_count",
        F.coalesce("unique_users", F.lit(0).cast("bigint")).alias("unique_users"),
        "event_counts",
        *[rounded[name].alias(name) for name in ("total_cart_value", "avg_session_time", "click_through_rate")],
        *[F.coalesce(as_ms(F.col(f"p{p}")), F.lit(0.0)).alias(f"latency_p{p}_ms") for p in C.PERCENTS],
        rounded["latency_max_ms"].alias("latency_max_ms"),
    )


def per_window(per_type: DataFrame) -> DataFrame:
    """Per-(window, type) partials to one row per window with the type map."""
    return per_type.groupBy("window_start_s").agg(*named(merged()), type_map().alias("event_counts"))


def window_metrics(events: DataFrame, window_sec: int = C.WINDOW_SEC, max_lag_sec: int = C.MAX_LAG_SEC) -> DataFrame:
    """The full window report, in four passes over the columns each needs.

    Persist `events` first when reading it is costly (JSON).
    """
    rows = prepared(events, window_sec, max_lag_sec)
    per_type = rows.groupBy("window_start_s", "event_type").agg(*named(additive()))
    latency = floor_rank_percentiles(accepted(rows), ["window_start_s"], "latency_us", C.PERCENTS)
    return assembled(per_window(per_type), unique_users(rows), latency, window_sec=window_sec)
