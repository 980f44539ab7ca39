"""Exact values at given ranks per key without sorting a key's rows in one place.

The p-th percentile of n values is the one at 1-based rank max(1, floor(n * p / 100)). Ranks are
found top-down over value ranges, as when refining a histogram:

1. count values per (key, range); a range is 1/128 of its magnitude wide, at most 2^20, so a key has
   some hundred of them whether its values spread over milliseconds or minutes, and the shuffle
   carries ranges instead of rows;
2. sums per 2^40 tell which of those holds each rank, then which range;
3. only rows inside the chosen ranges are counted value by value.

A running sum therefore orders about 2^20 ranges or values of one key at most, however many rows the
key has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxmill.workspace import stored

PRECISION_BITS = 7
WIDEST_BITS = 20
TOP_BITS = 40


def range_start(value: Column) -> Column:
    """Lower end of the range a value lies in; never decreases with the value.

    Widths are powers of two and stop growing at 2^WIDEST_BITS, where the logarithm is still exact.
    """
    magnitude = F.floor(F.log2(F.greatest(F.abs(value), F.lit(1))))
    bits = F.greatest(F.lit(0), F.least(F.lit(WIDEST_BITS), magnitude - PRECISION_BITS)).cast("int")
    return value - F.pmod(value, F.call_function("shiftleft", F.lit(1).cast("bigint"), bits))


def _counted(df: DataFrame, keys: list[str], by: Column, name: str, count: str) -> DataFrame:
    return df.groupBy(*keys, by.alias(name)).agg(F.sum(count).alias("n"))


def _before(keys: list[str], order: str) -> Column:
    """Number of values in earlier ranges of the same key."""
    window = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(order)
    return F.sum("n").over(window) - F.col("n")


def _holding(counts: DataFrame) -> DataFrame:
    """Keep the ranges in which a rank falls, and make the rank relative to the range."""
    inside = (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n"))
    return counts.where(inside).withColumn("rank", F.col("rank") - F.col("before"))


def _join(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Null-safe inner join that keeps the left copy of the key columns."""
    right = right.withColumnsRenamed({name: f"right_{name}" for name in names})
    condition = reduce(
        lambda acc, name: acc & F.col(name).eqNullSafe(F.col(f"right_{name}")), names, F.lit(True)
    )
    return left.join(right, condition, "inner").drop(*[f"right_{name}" for name in names])


def values_at_ranks(
    df: DataFrame,
    keys: list[str],
    value: str,
    ranks: dict[str, Column],
    weight: str | None = None,
) -> DataFrame:
    """One row per key, with a bigint column per entry of `ranks`.

    A rank is an expression over `total`, the key's number of values; 1 is the smallest. `value` is
    bigint. `weight` names a row count for tables that are counted already.
    """
    counts = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    rows = df.select(*keys, F.col(value).cast("bigint").alias("v"), counts.alias("w"))
    rows = rows.where(F.col("v").isNotNull()).withColumn("mid", range_start(F.col("v")))

    mid = _counted(rows, keys, F.col("mid"), "mid", "w").withColumn("top", F.shiftright("mid", TOP_BITS))
    top = mid.groupBy(*keys, "top").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*[F.col(k) for k in keys], F.lit(0)))
    wanted = F.array(
        *[F.struct(F.lit(name).alias("pick"), rank.cast("bigint").alias("rank")) for name, rank in ranks.items()]
    )
    in_top = (
        top.withColumns({"before": _before(keys, "top"), "total": total})
        .select(*keys, "top", "n", "before", F.inline(wanted))
        .transform(_holding)
        .select(*keys, "top", "pick", "rank")
    )
    mid = mid.withColumn("before", _before([*keys, "top"], "mid"))
    in_mid = _join(mid, in_top, [*keys, "top"]).transform(_holding).select(*keys, "mid", "pick", "rank")
    picked = in_mid.groupBy(*keys, "mid").agg(F.collect_list(F.struct("pick", "rank")).alias("picks"))
    # Stored with one row per range: Spark knows its size, so it is broadcast only when small; else
    # the join with the rows is one of plain tables, whose hot ranges AQE splits.
    chosen = stored(picked, "value-ranges")

    values = _counted(_join(rows, chosen.select(*keys, "mid"), [*keys, "mid"]), [*keys, "mid"], F.col("v"), "v", "w")
    values = values.withColumn("before", _before([*keys, "mid"], "v"))
    picked = _join(values, chosen, [*keys, "mid"]).select("*", F.inline("picks"))
    found = picked.transform(_holding).select(*keys, "pick", "v")
    # Every key comes out, with every rank or an error: the input was read twice and has to be the same each time.
    asked = chosen.select(*keys, F.lit(None).cast("string").alias("pick"), F.lit(None).cast("bigint").alias("v"))
    lost = F.raise_error(F.lit("a rank was not found: the input changed between two reads")).cast("bigint")
    picks = [F.coalesce(F.max(F.when(F.col("pick") == name, F.col("v"))), lost).alias(name) for name in ranks]
    return found.unionAll(asked).groupBy(*keys).agg(*picks)


def floor_rank_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    percents: list[int],
    weight: str | None = None,
) -> DataFrame:
    """One row per key with bigint columns p<percent>."""
    one = F.lit(1).cast("bigint")
    ranks = {f"p{p}": F.greatest(one, F.floor(F.col("total") * p / 100)) for p in percents}
    return values_at_ranks(df, keys, value, ranks, weight)


def as_ms(micros: Column) -> Column:
    """Microseconds to milliseconds; three decimals, so nothing is lost."""
    return micros / F.lit(1000)
