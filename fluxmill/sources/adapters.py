"""The driver's tables in the shapes this library works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxmill.functions.events import iso_utc_micros
from fluxmill.sources.tables import read_table


def users_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One user row per order. Spark picks the join strategy from the table sizes."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, folder, "region")
    joined = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    twentieth = F.col("o_orderkey") % 20
    return joined.select(
        F.col("o_orderkey").alias("user_id"),
        (F.lit(18) + (F.col("o_custkey") * 31) % 72).cast("int").alias("age"),
        F.when(twentieth != 3, F.lit(10000) + (F.col("c_acctbal") + 1000) * 20).alias("income"),
        (F.col("o_totalprice") / 2000).alias("session_time"),
        (F.col("o_orderkey") % 17).cast("int").alias("page_views"),
        (F.col("o_custkey") % 11).cast("int").alias("clicks"),
        F.when(twentieth != 7, F.col("o_totalprice") / 100).alias("cart_value"),
        F.when(twentieth < 11, "mobile").when(twentieth < 18, "desktop").otherwise("tablet").alias("device_type"),
        F.when(F.col("r_name") == "AFRICA", "north")
        .when(F.col("r_name") == "AMERICA", "south")
        .when(F.col("r_name") == "ASIA", "east")
        .when(F.col("r_name") == "EUROPE", "west")
        .otherwise("central")
        .alias("region"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
    )


def text_users(users: DataFrame) -> DataFrame:
    """The user table as untyped text, as a CSV landing would hold it, with some junk numbers."""
    bad = F.col("user_id") % 23 == 5
    return users.select(
        "user_id",
        F.when(bad, "n/a").otherwise(F.col("age").cast("string")).alias("age"),
        F.when(bad, "unknown").otherwise(F.col("income").cast("string")).alias("income"),
        F.col("session_time").cast("string").alias("session_time"),
        F.concat(F.col("page_views").cast("string"), F.lit(".7")).alias("page_views"),
        F.col("clicks").cast("string").alias("clicks"),
        F.when(bad, "").otherwise(F.col("cart_value").cast("string")).alias("cart_value"),
        "device_type",
        "region",
        "label",
    )


def _renamed_type() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "view", "page_view")
        .when(kind == "click", "click")
        .when(kind == "signup", "add_to_cart")
        .when(kind == "purchase", "purchase")
    )


def event_time_us() -> Column:
    """Event time of a row of the event log."""
    return F.unix_micros(F.col("ts").cast("timestamp"))


def receive_time_us() -> Column:
    """Receive time of a row of the event log: some rows arrive one or three hours behind. Null without id or time."""
    key = F.col("event_id")
    delay = (
        F.lit(5000).cast("bigint")
        + (key % 50) * 1000
        + F.when(key % 97 == 5, F.lit(10_800_000_000)).when(key % 31 == 4, F.lit(4_500_000_000)).otherwise(F.lit(0))
    )
    return event_time_us() + delay


def events_from_log(log: DataFrame) -> DataFrame:
    """The event log (batch or stream) with event and receive times and the reference fields.

    The type is null for errors, some rows arrive one or three hours behind, and a tenth carry
    a zero session time.
    """
    key = F.col("event_id")
    return log.select(
        key.alias("event_id"),
        "user_id",
        _renamed_type().alias("event_type"),
        event_time_us().alias("event_us"),
        receive_time_us().alias("receive_us"),
        F.when(key % 10 == 0, F.lit(0.0)).otherwise(F.col("value")).alias("session_time"),
        (F.lit(1) + key % 20).cast("int").alias("page_views"),
        (key % 11).cast("int").alias("clicks"),
        F.when(F.col("event_type").isin("signup", "purchase"), F.col("value")).otherwise(F.lit(0.0)).alias("cart_value"),
        F.when(key % 3 == 0, 100).when(key % 3 == 1, 1000).otherwise(5000).alias("load_level"),
        F.col("props").alias("payload"),
    )


def raw_events_from_log(log: DataFrame) -> DataFrame:
    """Events as a producer spells them: text stamps in two offset spellings, some bad or missing
    stamps, and missing fields. `receive_us` is when they arrived."""
    mapped = events_from_log(log)
    key = F.col("event_id")
    stamp = iso_utc_micros(F.col("event_us"))
    return mapped.select(
        key.cast("string").alias("event_id"),
        F.when(key % 41 != 7, F.col("user_id")).alias("user_id"),
        "event_type",
        F.when(key % 89 == 7, F.lit("not a time"))
        .when(key % 83 == 5, F.lit(None).cast("string"))
        .when(key % 2 == 0, F.replace(stamp, F.lit("+00:00"), F.lit("Z")))
        .otherwise(stamp)
        .alias("timestamp"),
        "session_time",
        F.when(key % 43 != 8, F.col("page_views")).alias("page_views"),
        F.when(key % 47 != 9, F.col("clicks")).alias("clicks"),
        F.when(key % 53 != 6, F.col("cart_value")).alias("cart_value"),
        F.lit(None).cast("string").alias("device_type"),
        F.lit(None).cast("string").alias("region"),
        F.lit(None).cast("double").alias("income"),
        "receive_us",
    )


def event_lines_from_log(log: DataFrame) -> DataFrame:
    """One JSON text per event, a few torn as by a producer that died while writing."""
    raw = raw_events_from_log(log)
    body = F.to_json(F.struct(*[c for c in raw.columns if c != "receive_us"]))
    number = F.col("event_id").cast("bigint")
    torn = F.substring(body, 1, 20)
    return raw.select(
        number.alias("line_id"),
        F.when(number % 101 == 13, torn).otherwise(body).alias("value"),
        "receive_us",
    )


def load_lines_from_log(log: DataFrame) -> DataFrame:
    """The message text of each event at its load level, some with a bad or missing stamp, a few torn."""
    raw = raw_events_from_log(log).withColumn("number", F.col("event_id").cast("bigint"))
    fields = [
        F.concat(F.lit('"event_id": "'), F.col("event_id"), F.lit('"')),
        F.concat(F.lit('"user_id": '), F.coalesce(F.col("user_id").cast("string"), F.lit("null"))),
        F.concat(F.lit('"timestamp": '), F.coalesce(F.concat(F.lit('"'), F.col("timestamp"), F.lit('"')), F.lit("null"))),
        F.concat(F.lit('"clicks": '), F.coalesce(F.col("clicks").cast("string"), F.lit("null"))),
    ]
    body = F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
    number = F.col("number")
    level = F.when(number % 3 == 0, 100).when(number % 3 == 1, 1000).otherwise(5000)
    return raw.select(
        level.alias("load_level"), F.when(number % 101 == 13, F.substring(body, 1, 20)).otherwise(body).alias("value")
    )


def with_replays(events: DataFrame, delay_us: int) -> DataFrame:
    """Every seventh event twice, the second copy received later, as after a consumer restart."""
    copies = F.when(F.col("event_id") % 7 == 3, F.array(F.lit(0), F.lit(delay_us))).otherwise(F.array(F.lit(0)))
    doubled = events.withColumn("replay_us", F.explode(copies))
    return doubled.withColumn("receive_us", F.col("receive_us") + F.col("replay_us")).drop("replay_us")
