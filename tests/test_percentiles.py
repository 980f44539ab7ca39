import random

import pytest

from bruteforce import floor_rank
from fluxmill.operators.percentiles import floor_rank_percentiles, range_start, values_at_ranks
from pyspark.sql import functions as F

SIZES = [1, 2, 19, 20, 100, 101, 250]


def groups(seed=3):
    rng = random.Random(seed)
    made = {size: [rng.choice([rng.randrange(-5000, 5000), rng.randrange(10**11), 7]) for _ in range(size)] for size in SIZES}
    made[None] = [rng.randrange(-(10**10), 10**10) for _ in range(60)]
    return made


@pytest.fixture(params=["10MB", "-1"])
def broadcast_limit(spark, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ranks_equal_brute_force(spark, broadcast_limit):
    data = groups()
    df = spark.createDataFrame([(k, v) for k, values in data.items() for v in values], "k int, v long")
    got = floor_rank_percentiles(df, ["k"], "v", [0, 50, 95, 99, 100]).collect()
    assert len(got) == len(data)
    for row in got:
        assert [row[f"p{p}"] for p in (0, 50, 95, 99, 100)] == [floor_rank(data[row["k"]], p) for p in (0, 50, 95, 99, 100)]


def test_weights_stand_for_repeated_rows(spark):
    df = spark.createDataFrame([("a", 5, 3), ("a", 9, 1), ("a", 1, 96), ("a", None, 50)], "k string, v long, n int")
    row = floor_rank_percentiles(df, ["k"], "v", [50, 96, 97, 100], weight="n").first()
    assert (row.p50, row.p96, row.p97, row.p100) == (1, 1, 5, 9)


def test_one_key_with_many_distinct_values(spark):
    df = spark.range(200_000).select(F.lit(1).alias("k"), (F.col("id") * 7919 % 200_003).alias("v"))
    values = sorted(i * 7919 % 200_003 for i in range(200_000))
    row = floor_rank_percentiles(df, ["k"], "v", [50, 95, 99]).first()
    assert (row.p50, row.p95, row.p99) == (values[99_999], values[189_999], values[197_999])


def test_rank_from_the_top(spark):
    df = spark.createDataFrame([(1, v) for v in (10, 30, 20)], "k int, v long")
    found = values_at_ranks(df, ["k"], "v", {"second": F.col("total") - 1})
    assert found.first().second == 20


def test_empty_input(spark):
    df = spark.createDataFrame([], "k int, v long")
    assert floor_rank_percentiles(df, ["k"], "v", [50]).collect() == []


def test_ranges_follow_the_order_of_values(spark):
    edges = {s * (2**k + d) for k in range(61) for d in (-2, -1, 0, 1, 2, 3) for s in (1, -1)}
    rng = random.Random(1)
    values = sorted(edges | {rng.randrange(-(2**k), 2**k) for k in range(1, 61) for _ in range(40)})
    df = spark.createDataFrame([(v,) for v in values], "v long")
    starts = [r.s for r in df.select("v", range_start(F.col("v")).alias("s")).orderBy("v").collect()]
    assert starts == sorted(starts)
    assert all(0 <= v - s < 2**20 for v, s in zip(values, starts))
    assert all(v - s <= max(1, abs(v)) / 64 for v, s in zip(values, starts))
