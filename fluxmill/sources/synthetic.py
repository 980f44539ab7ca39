"""Seeded user and event tables, one row per key.

Keys come from any table (or spark.range), so the output is partitioned as its input and grows
with it. Equal seed and key give an equal row in any layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxmill import constants as C
from fluxmill.functions import draws as D
from fluxmill.functions.events import MICROS, iso_utc_micros
from fluxmill.functions.numbers import round_to
from fluxmill.schemas import EVENTS, USERS

USER_POOL = 100_000


def _draw_columns(keys: DataFrame, key: str, seed: int, names: list[str]) -> DataFrame:
    """Key plus one uniform draw per name."""
    number = F.col(key).cast("bigint")
    return keys.select(
        number.alias("key"),
        *[D.uniform(number, seed, i).alias(f"u_{name}") for i, name in enumerate(names)],
    )


# The generated method must stay under the 8000 bytes up to which the JVM compiles it; two draws
# give both normal values for that reason.
USER_DRAWS = [
    "age", "normal_a", "normal_b", "session", "views", "clicks",
    "device", "region", "income_gap", "cart_gap", "label",
]


def synth_users(keys: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """User rows with the documented distributions; about 5 % of income and cart_value are null."""
    u = {name: F.col(f"u_{name}") for name in USER_DRAWS}
    for_income, for_cart = D.normal_pair(u["normal_a"], u["normal_b"])
    income = D.clipped(F.lit(55000.0) + F.lit(20000.0) * for_income, 10000.0, 300000.0)
    cart = D.clipped(F.exp(F.lit(3.5) + F.lit(1.2) * for_cart), 0.0, 5000.0)
    counts = _draw_columns(keys, key, seed, USER_DRAWS).withColumns(
        {
            "page_views": D.poisson(u["views"], 8.0),
            "clicks": D.poisson(u["clicks"], 3.0),
            "full_income": income,
        }
    )
    buys = (
        F.lit(0.05)
        + F.lit(0.0000003) * F.col("full_income")
        + F.lit(0.002) * F.col("page_views")
        + F.lit(0.003) * F.col("clicks")
    )
    return counts.select(
        F.col("key").alias("user_id"),
        D.uniform_int(u["age"], 18, 89).alias("age"),
        F.when(u["income_gap"] >= 0.05, F.col("full_income")).alias("income"),
        round_to(D.clipped(D.exponential(u["session"], 15.0), 0.0, 300.0), 2).alias("session_time"),
        "page_views",
        "clicks",
        F.when(u["cart_gap"] >= 0.05, cart).alias("cart_value"),
        D.weighted_choice(u["device"], C.DEVICES, C.DEVICE_WEIGHTS).alias("device_type"),
        D.weighted_choice(u["region"], C.REGIONS, C.REGION_WEIGHTS).alias("region"),
        (u["label"] < D.clipped(buys, 0.0, 1.0)).cast("tinyint").alias("label"),
    ).select(*USERS.fieldNames())


EVENT_DRAWS = ["user", "type", "session", "views", "clicks", "device", "region", "normal_a", "normal_b"]


def synth_events(keys: DataFrame, key: str, start_us: int, rate: int, seed: int = 42) -> DataFrame:
    """Event rows; event time is start + key / rate. cart_value is set for cart events only."""
    u = {name: F.col(f"u_{name}") for name in EVENT_DRAWS}
    event_us = F.lit(start_us) + F.floor(F.col("key") * F.lit(MICROS) / F.lit(rate))
    drawn = _draw_columns(keys, key, seed, EVENT_DRAWS).withColumns(
        {
            "user_id": D.uniform_int(u["user"], 1, USER_POOL).cast("bigint"),
            "event_type": D.weighted_choice(u["type"], C.EVENT_TYPES, C.EVENT_WEIGHTS),
            "event_us": event_us,
        }
    )
    for_income, for_cart = D.normal_pair(u["normal_a"], u["normal_b"])
    cart = round_to(F.exp(F.lit(3.5) + F.lit(1.2) * for_cart), 2)
    return drawn.select(
        F.concat_ws("-", "user_id", F.col("event_us") * 1000 + F.col("key") % 1000).alias("event_id"),
        "user_id",
        "event_type",
        iso_utc_micros(F.col("event_us")).alias("timestamp"),
        round_to(D.exponential(u["session"], 15.0), 2).alias("session_time"),
        D.uniform_int(u["views"], 1, 20).alias("page_views"),
        D.uniform_int(u["clicks"], 0, 10).alias("clicks"),
        F.when(F.col("event_type").isin(C.CART_TYPES), cart).otherwise(F.lit(0.0)).alias("cart_value"),
        F.element_at(F.array(*map(F.lit, C.DEVICES)), D.uniform_int(u["device"], 1, len(C.DEVICES))).alias("device_type"),
        F.element_at(F.array(*map(F.lit, C.REGIONS)), D.uniform_int(u["region"], 1, len(C.REGIONS))).alias("region"),
        round_to(F.lit(55000.0) + F.lit(20000.0) * for_income, 2).alias("income"),
    ).select(*EVENTS.fieldNames())
