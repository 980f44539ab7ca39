import math
import re

import pytest
from pyspark.sql import functions as F

from fluxmill.functions import features as X
from fluxmill.operators import imputation
from fluxmill.operators.profiles import fit_profile, with_region_averages
from fluxmill.plans.feature_job import run_feature_job
from fluxmill.plans.feature_table import feature_table, transform
from fluxmill.schemas import FEATURE_COLUMNS, USERS
from fluxmill.workspace import new_folder

BASE = dict(
    user_id=1, age=30, income=50000.0, session_time=10.0, page_views=4, clicks=2, cart_value=20.0,
    device_type="mobile", region="north", label=0,
)


def users(spark, *changes):
    rows = [{**BASE, "user_id": i, **change} for i, change in enumerate(changes)]
    return spark.createDataFrame([tuple(r[c] for c in USERS.fieldNames()) for r in rows], USERS)


def by_id(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("user_id").collect()]


def test_mean_fill_for_null_and_nan(spark):
    df = users(spark, {"income": 10.0}, {"income": 30.0}, {"income": None}, {"income": float("nan")})
    assert by_id(imputation.impute_mean(df), "income") == [(10.0,), (30.0,), (20.0,), (20.0,)]


def test_fill_falls_back_when_the_mean_is_zero_or_missing(spark):
    zero = users(spark, {"cart_value": 0.0}, {"cart_value": None})
    assert by_id(imputation.impute_mean(zero), "cart_value") == [(0.0,), (50.0,)]
    missing = users(spark, {"income": None}, {"income": None})
    assert by_id(imputation.impute_mean(missing), "income") == [(55000.0,), (55000.0,)]
    assert by_id(feature_table(missing), "income") == [(55000.0,), (55000.0,)]


def test_ratios_are_zero_without_views_and_null_without_clicks(spark):
    df = users(spark, {}, {"page_views": 0}, {"page_views": -1}, {"page_views": None}, {"clicks": None})
    got = by_id(df.select("user_id", X.click_through_rate().alias("a"), X.cart_per_pageview().alias("b")), "a", "b")
    assert got == [(0.5, 5.0), (0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (None, 5.0)]


def test_log_of_one_plus_x_is_null_from_minus_one_down(spark):
    got = by_id(feature_table(users(spark, {"income": -1.0}, {"income": -5.0}, {"income": 0.0})), "log_income")
    assert got == [(None,), (None,), (0.0,)]


def test_bins_at_their_edges(spark):
    ages = users(spark, *[{"age": a} for a in (24, 25, 39, 40, 59, 60, None)])
    assert [g for (g,) in by_id(ages.select("user_id", X.age_group().alias("g")), "g")] == [
        "youth", "young_adult", "young_adult", "middle_aged", "middle_aged", "senior", "senior",
    ]
    incomes = users(spark, *[{"income": v} for v in (29999.9, 30000.0, 70000.0, 149999.0, 150000.0, float("nan"))])
    assert [g for (g,) in by_id(incomes.select("user_id", X.income_bracket().alias("g")), "g")] == [
        "low", "medium", "high", "high", "very_high", "very_high",
    ]


def test_flags_for_unknown_and_null(spark):
    df = users(spark, {"device_type": "tablet", "region": "west"}, {"device_type": "tv", "region": "moon"},
               {"device_type": None, "region": None})
    got = by_id(df.select("user_id", *X.device_flags(), *X.region_flags()),
                "device_mobile", "device_tablet", "region_west", "region_central")
    assert got == [(0, 1, 1, 0), (0, 0, 0, 0), (None, None, None, None)]


def test_region_averages_with_a_null_region(spark):
    df = users(
        spark,
        {"region": "north", "session_time": 1.0, "clicks": 1}, {"region": "north", "session_time": 3.0, "clicks": None},
        {"region": None, "session_time": 10.0}, {"region": None, "session_time": 20.0},
        {"region": "east", "session_time": None, "clicks": None},
    )
    got = by_id(with_region_averages(df, fit_profile(df)), "region_avg_session", "region_avg_clicks", "session_vs_region_avg")
    assert got == [(2.0, 1.0, -1.0), (2.0, 1.0, 1.0), (15.0, 2.0, -5.0), (15.0, 2.0, 5.0), (None, None, None)]


def test_min_max_and_constant_column(spark):
    df = users(spark, {"page_views": 2}, {"page_views": 4}, {"page_views": 6})
    got = by_id(imputation.min_max_scale(df), "session_time_norm", "page_views_norm")
    assert got == [(0.0, 0.0), (0.0, 0.5), (0.0, 1.0)]
    assert by_id(feature_table(df), "session_time_norm", "page_views_norm") == got


def test_casts_of_text(spark):
    df = spark.createDataFrame(
        [(1, "12.7", "x", "1.5", "3", "", "7", "mobile", "north", 0)],
        "user_id long, age string, income string, session_time string, page_views string, clicks string,"
        " cart_value string, device_type string, region string, label int",
    )
    row = imputation.cast_users(df).first()
    assert (row.age, row.income, row.session_time, row.page_views, row.clicks, row.cart_value) == (12, None, 1.5, 3, None, 7.0)


def test_casts_of_wide_numbers(spark):
    df = users(spark, {}).withColumn("age", F.lit(2**40)).withColumn("income", F.lit(7))
    row = imputation.cast_users(df).first()
    assert row.age is None and row.income == 7.0


def test_feature_table_shape_and_values(spark):
    table = feature_table(users(spark, {"income": None}, {"income": 40000.0, "page_views": 8}))
    assert table.columns == FEATURE_COLUMNS and len(table.columns) == 30
    row = table.orderBy("user_id").first()
    assert row.income == 40000.0 and row.income_x_pageviews == 160000.0
    assert row.log_income == pytest.approx(math.log(40001))


def test_empty_table(spark):
    empty = users(spark, {}).where("false")
    assert feature_table(empty).collect() == []


def test_plan_has_no_shuffle_of_the_rows(spark):
    df = users(spark, {}, {"region": "west"})
    path = new_folder(spark, "test-users")
    df.write.parquet(path)
    stored_users = spark.read.parquet(path)
    plan = transform(stored_users, fit_profile(stored_users))._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning" not in main and "Python" not in plan


def test_statistics_read_only_what_is_asked(spark):
    path = new_folder(spark, "test-users")
    users(spark, {}, {"region": "west"}).write.parquet(path)
    stored_users = spark.read.parquet(path)

    def scans(df):
        return re.findall(r"ReadSchema: struct<(.*?)>", df._jdf.queryExecution().executedPlan().toString())

    for schema in scans(imputation.impute_mean(stored_users, ["income"]).select("user_id", "income")):
        assert "session_time" not in schema and "cart_value" not in schema
    for schema in scans(imputation.min_max_scale(stored_users).select("session_time_norm", "page_views_norm")):
        assert "income" not in schema and "cart_value" not in schema
    assert set(fit_profile(stored_users, ["clicks"]).columns) == {"region", "rows", "clicks_sum", "clicks_n"}


def test_region_lookup_by_shuffle_gives_the_same(spark):
    df = users(spark, *[{"region": r, "session_time": float(i)} for i, r in enumerate(["north", None, "west", "north"])])
    expected = feature_table(df).orderBy("user_id").collect()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        table = feature_table(df)
        assert "SortMergeJoin" in table._jdf.queryExecution().executedPlan().toString()
        assert table.orderBy("user_id").collect() == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_repartition_only_on_request(spark):
    df = users(spark, {}, {"region": "west"})
    profile = fit_profile(df)
    assert transform(df, profile, 3).rdd.getNumPartitions() == 3


def test_feature_job_writes_and_counts(spark):
    df = users(spark, {}, {"region": "west"}, {"region": None})
    output = new_folder(spark, "test-job")
    report = run_feature_job(df, output, mode="test").first()
    assert (report.mode, report.input_rows, report.output_rows) == ("test", 3, 3)
    assert spark.read.parquet(f"{output}/features").count() == 3
    assert spark.read.json(f"{output}/metrics").first().input_rows == 3
    run_feature_job(df.limit(1), output)
    assert spark.read.parquet(f"{output}/features").count() == 1


def test_partitions_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr("fluxmill.plans.feature_table.ROWS_PER_PARTITION", 10, raising=False)
    df = users(spark, *[{"region": "west" if i % 3 else None, "income": float(i)} for i in range(95)])
    profile_of_one = fit_profile(df.limit(1))
    for dealt in (feature_table(df, 4), transform(df, profile_of_one, 4)):
        sizes = dealt.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()
        assert len(sizes) == 10 and sum(r.n for r in sizes) == 95
        assert max(r.n for r in sizes) <= 10 + df.rdd.getNumPartitions()
    assert feature_table(df, 12).rdd.getNumPartitions() == 12
    assert by_id(feature_table(df, 4), *FEATURE_COLUMNS) == by_id(feature_table(df), *FEATURE_COLUMNS)
    output = new_folder(spark, "test-dealt")
    assert run_feature_job(df, output, partitions=4).first().partitions == 10
    assert len(spark.read.parquet(f"{output}/features").inputFiles()) == 10
