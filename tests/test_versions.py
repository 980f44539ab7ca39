"""Version tables: replays, merges and the number of folders."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from fluxmill.schemas import struct
from fluxmill.sources import versions as V
from fluxmill.workspace import new_folder

ROWS = struct(k="long", n="long")


def summed(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def batch(spark, *rows):
    values = ", ".join(f"({k}L, {n}L)" for k, n in rows)
    return spark.sql(f"select * from values {values} as t(k, n)").coalesce(1)


def totals(spark, path):
    return dict(map(tuple, summed(V.read_versions(spark, ROWS, path)).collect()))


def folders(path):
    return sum(len(os.listdir(p)) for p in (path, f"{path}-merged", f"{path}-manifest") if os.path.isdir(p))


def test_folders_stay_bounded_over_200_batches(spark):
    spark = spark.newSession()
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    path = new_folder(spark, "test-merges")
    V.start_versions(spark, ROWS, path)
    most = 0
    for number in range(200):
        os.makedirs(f"{path}/{V.BATCH}={number}")  # as write_version does it, without a job
        rows = pa.table({"k": [number % 3, 7], "n": [1, number]})
        pq.write_table(rows, f"{path}/{V.BATCH}={number}/part-0.parquet")
        V.compact(spark, ROWS, path, summed, number, fanout=8)
        most = max(most, folders(path))
    assert totals(spark, path) == {0: 67, 1: 67, 2: 66, 7: sum(range(200))}
    # Under two rounds of batches, two sizes of merged folders with what waits for deletion, two manifests.
    assert most <= 2 * 8 + 3 * 8 + 3
    assert V.read_versions(spark, ROWS, path).count() < 4 * 3 * 8


def test_replays_before_and_after_a_merge(spark):
    path = new_folder(spark, "test-replays")
    V.start_versions(spark, ROWS, path)
    for number in range(3):
        V.write_version(batch(spark, (1, 10**number)), path, number)
    V.write_version(batch(spark, (1, 5)), path, 1)  # replaces what the batch wrote before
    assert totals(spark, path) == {1: 106}
    assert not V.compact(spark, ROWS, path, summed, 1, fanout=2)
    assert V.compact(spark, ROWS, path, summed, 2, fanout=2)
    V.write_version(batch(spark, (1, 5), (2, 9)), path, 1)  # merged already: counts no more
    assert totals(spark, path) == {1: 106}
    V.write_version(batch(spark, (1, 200)), path, 2)  # not merged: counts
    assert totals(spark, path) == {1: 206}


def test_a_merge_that_broke_off_is_done_again(spark):
    path = new_folder(spark, "test-broken")
    V.start_versions(spark, ROWS, path)
    for number in range(4):
        V.write_version(batch(spark, (number, 1)), path, number)
    batch(spark, (9, 9)).withColumn(V.BATCH, F.lit(0).cast("bigint")).write.parquet(f"{path}-merged/0-1")  # no manifest names it
    assert totals(spark, path) == {0: 1, 1: 1, 2: 1, 3: 1}
    V.compact(spark, ROWS, path, summed, 2, fanout=2)
    assert totals(spark, path) == {0: 1, 1: 1, 2: 1, 3: 1}


def test_a_reader_keeps_what_it_began_with(spark):
    path = new_folder(spark, "test-reader")
    V.start_versions(spark, ROWS, path)
    for number in range(4):
        V.write_version(batch(spark, (1, 1)), path, number)
    reader = V.read_versions(spark, ROWS, path)
    V.compact(spark, ROWS, path, summed, 4, fanout=2)
    assert reader.count() == 4 and totals(spark, path) == {1: 4}


def test_newest_version_outlives_merges(spark):
    path = new_folder(spark, "test-newest")
    V.start_versions(spark, ROWS, path)
    for number in range(5):
        V.write_version(batch(spark, (1, number), (10 + number, 1)), path, number)
        V.compact(spark, ROWS, path, lambda rows: rows.groupBy("k").agg(F.max("n").alias("n")), number, fanout=2)
    got = dict(map(tuple, V.latest(V.read_versions(spark, ROWS, path), ["k"]).collect()))
    assert got == {1: 4, 10: 1, 11: 1, 12: 1, 13: 1, 14: 1}
