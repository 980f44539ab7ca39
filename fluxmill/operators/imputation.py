"""Casts, global statistics and mean filling of the user table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxmill import constants as C
from fluxmill.functions import features as X
from fluxmill.functions.numbers import not_nan


def cast_users(users: DataFrame) -> DataFrame:
    """Numeric columns in their feature types, in one projection."""
    types = {field.name: field.dataType for field in users.schema.fields}
    return users.select(
        *[X.typed(c, types[c]).alias(c) if c in X.TYPED else F.col(c) for c in users.columns]
    )


def column_stats(users: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Means, minima and maxima the features need: one row from one pass.

    `names` picks some of them. What is not asked for is not computed, so its column is not read:
    a scalar subquery is not pruned from outside.
    """
    stats = {
        "income_mean": F.avg(not_nan(F.col("income"))),
        "cart_mean": F.avg(not_nan(F.col("cart_value"))),
        "session_min": F.min("session_time"),
        "session_max": F.max("session_time"),
        "views_min": F.min("page_views"),
        "views_max": F.max("page_views"),
    }
    return users.agg(*[stats[name].alias(name) for name in names or stats])


def as_scalar(one_row: DataFrame) -> Column:
    """A one-row DataFrame as a struct column.

    Spark runs it once as a scalar subquery and puts the value into the consuming stage as a
    literal: no join, no collect in this program.
    """
    return one_row.select(F.struct("*").alias("row")).scalar()


def fill_columns(stats: Column) -> dict[str, Column]:
    return {
        "income": X.filled(F.col("income"), stats.getField("income_mean"), C.DEFAULT_INCOME),
        "cart_value": X.filled(F.col("cart_value"), stats.getField("cart_mean"), C.DEFAULT_CART_VALUE),
    }


FILLED = {"income": "income_mean", "cart_value": "cart_mean"}


def impute_mean(users: DataFrame, columns: Sequence[str] = ("income", "cart_value")) -> DataFrame:
    """Null and NaN values of the columns, of income and cart_value, replaced by the column mean."""
    fills = fill_columns(as_scalar(column_stats(users, [FILLED[c] for c in columns])))
    return users.withColumns({c: fills[c] for c in columns})


def scale_columns(stats: Column) -> dict[str, Column]:
    return {
        "session_time_norm": X.min_max(
            F.col("session_time"), stats.getField("session_min"), stats.getField("session_max")
        ),
        "page_views_norm": X.min_max(
            F.col("page_views"), stats.getField("views_min"), stats.getField("views_max")
        ),
    }


def min_max_scale(users: DataFrame) -> DataFrame:
    needed = column_stats(users, ["session_min", "session_max", "views_min", "views_max"])
    return users.withColumns(scale_columns(as_scalar(needed)))
