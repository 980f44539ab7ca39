"""Region profile: per-region partial aggregates that also carry the global statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxmill.functions.numbers import not_nan
from fluxmill.workspace import stored

PROFILED = ("session_time", "clicks", "income", "cart_value", "page_views")


def fit_profile(users: DataFrame, columns: Sequence[str] = PROFILED) -> DataFrame:
    """One row per region with sums, counts and extremes of the columns, written to the shared folder.

    A single pass with map-side combine: the shuffle carries one row per region and task however
    large or skewed a region is. Region averages need session_time and clicks; the global
    statistics need all columns.
    """
    return stored(users.groupBy("region").agg(*partials(columns)), "region-profile")


def partials(columns: Sequence[str] = PROFILED) -> list[Column]:
    """The aggregates a profile holds: row count, sums, counts and extremes of the columns."""
    income, cart = not_nan(F.col("income")), not_nan(F.col("cart_value"))
    known = {
        "session_time": [
            F.sum("session_time").alias("session_sum"),
            F.count("session_time").alias("session_n"),
            F.min("session_time").alias("session_min"),
            F.max("session_time").alias("session_max"),
        ],
        "clicks": [F.sum("clicks").alias("clicks_sum"), F.count("clicks").alias("clicks_n")],
        "income": [F.sum(income).alias("income_sum"), F.count(income).alias("income_n")],
        "cart_value": [F.sum(cart).alias("cart_sum"), F.count(cart).alias("cart_n")],
        "page_views": [F.min("page_views").alias("views_min"), F.max("page_views").alias("views_max")],
    }
    return [F.count(F.lit(1)).alias("rows"), *[partial for column in columns for partial in known[column]]]


def merged_profile(parts: DataFrame) -> DataFrame:
    """Profiles of parts of a table, as rows, to the profile of all of them."""
    by_suffix = {"min": F.min, "max": F.max}
    names = [c for c in parts.columns if c != "region"]
    return parts.groupBy("region").agg(*[by_suffix.get(c.rsplit("_")[-1], F.sum)(c).alias(c) for c in names])


def profile_rows(profile: DataFrame) -> int:
    """How many rows a profile was fitted on."""
    return profile.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def profile_stats(profile: DataFrame) -> DataFrame:
    """The global statistics row, from the partials."""
    return profile.agg(
        F.try_divide(F.sum("income_sum"), F.sum("income_n")).alias("income_mean"),
        F.try_divide(F.sum("cart_sum"), F.sum("cart_n")).alias("cart_mean"),
        F.min("session_min").alias("session_min"),
        F.max("session_max").alias("session_max"),
        F.min("views_min").alias("views_min"),
        F.max("views_max").alias("views_max"),
    )


def region_averages(profile: DataFrame) -> DataFrame:
    return profile.select(
        F.col("region").alias("profile_region"),
        F.try_divide("session_sum", "session_n").alias("region_avg_session"),
        F.try_divide("clicks_sum", "clicks_n").alias("region_avg_clicks"),
    )


def with_region_averages(users: DataFrame, profile: DataFrame) -> DataFrame:
    """Region averages beside each row; the null region is a group of its own.

    No hint: the stored profile has a known size, so Spark broadcasts a small one and lets AQE
    split hot regions of the shuffle join otherwise.
    """
    averages = region_averages(profile)
    joined = users.join(
        averages, users["region"].eqNullSafe(averages["profile_region"]), "left"
    ).drop("profile_region")
    return joined.withColumn(
        "session_vs_region_avg", F.col("session_time") - F.col("region_avg_session")
    )
