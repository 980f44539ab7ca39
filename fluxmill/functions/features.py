"""Row-local feature columns of the user table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxmill import constants as C
from fluxmill.functions.numbers import not_nan, ratio_or_zero

TYPED = {
    "age": "int",
    "income": "double",
    "session_time": "double",
    "page_views": "int",
    "clicks": "int",
    "cart_value": "double",
}


def typed(name: str, source: T.DataType) -> Column:
    """Column `name` in its feature type; text that is no number becomes null.

    Text goes to int by way of double, so "12.7" is 12.
    """
    column = F.col(name)
    if TYPED[name] == "int" and isinstance(source, T.StringType):
        column = column.try_cast("double")
    return column.try_cast(TYPED[name])


def filled(value: Column, mean: Column, default: float) -> Column:
    """Null and NaN replaced by the mean, or by the default when the mean is null or zero."""
    return F.coalesce(not_nan(value), F.nullif(mean, F.lit(0.0)), F.lit(default))


def click_through_rate() -> Column:
    return ratio_or_zero(F.col("clicks"), F.col("page_views"))


def cart_per_pageview() -> Column:
    return ratio_or_zero(F.col("cart_value"), F.col("page_views"))


def binned(value: Column, edges: list[tuple[float, str]], last: str) -> Column:
    """Label of the first edge the value lies below; null and everything else get `last`."""
    first_edge, first_label = edges[0]
    chain = reduce(
        lambda acc, edge: acc.when(value < edge[0], edge[1]),
        edges[1:],
        F.when(value < first_edge, first_label),
    )
    return chain.otherwise(last)


def age_group() -> Column:
    return binned(F.col("age"), C.AGE_EDGES, C.AGE_LAST)


def income_bracket() -> Column:
    return binned(F.col("income"), C.INCOME_EDGES, C.INCOME_LAST)


def one_hot(column: str, prefix: str, values: list[str]) -> list[Column]:
    """One 0/1 column per value; null input gives null in each."""
    return [(F.col(column) == v).cast("int").alias(f"{prefix}_{v}") for v in values]


def device_flags() -> list[Column]:
    return one_hot("device_type", "device", C.DEVICES)


def region_flags() -> list[Column]:
    return one_hot("region", "region", C.REGIONS)


def min_max(value: Column, low: Column, high: Column) -> Column:
    """(value - low) / (high - low); a constant column scales to 0.0."""
    span = (high - low).cast("double")
    return (value - low) / F.coalesce(F.nullif(span, F.lit(0.0)), F.lit(1.0))


def row_local() -> list[Column]:
    """Features that need nothing but their own row, after casts and filling."""
    return [
        click_through_rate().alias("click_through_rate"),
        cart_per_pageview().alias("cart_per_pageview"),
        F.log1p("income").alias("log_income"),
        F.log1p("cart_value").alias("log_cart_value"),
        age_group().alias("age_group"),
        income_bracket().alias("income_bracket"),
        *device_flags(),
        *region_flags(),
    ]


def interaction() -> Column:
    return F.col("income") * F.col("page_views")
