"""A table that micro-batches add to, one folder each; old folders are merged while the stream goes on.

    path/batch_id=N             rows of micro-batch N; a replay of the batch replaces them
    path-merged/LOW-HIGH        rows of the batches LOW to HIGH, merged
    path-manifest/generation=G  one row: batches up to `upto` are to be read from `segments`

Numbers only grow: the table belongs to one stream and its checkpoint, and a stream that begins anew
needs a new table. A reader takes the newest manifest, the merged folders it names and the batches after `upto`. A
manifest is one file, which appears as a whole, so readers see a merge completely or not at all. Once
merged, a batch folder counts no more, whatever a replay writes into it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxmill.schemas import struct
from fluxmill.workspace import remove

BATCH = "batch_id"
START_BATCH = -1
FANOUT = 16
SEGMENT = struct(low="long", high="long", level="integer")
MANIFEST = struct(upto="long", segments=T.ArrayType(SEGMENT), generation="long")


@dataclass(frozen=True)
class Live:
    """What a manifest names."""

    upto: int
    segments: tuple[tuple[int, int, int], ...]  # (low, high, level)
    generation: int

    def folders(self, path: str) -> list[str]:
        return [f"{path}-merged/{low}-{high}" for low, high, _ in self.segments]


def write_version(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def start_versions(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """An empty first version, so that readers find a table before the first batch."""
    write_version(spark.createDataFrame([], schema), path, START_BATCH)


def _manifests(spark: SparkSession, path: str) -> list[Live]:
    """The last manifests, newest first; at least the one of a table that was never merged."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}-manifest").collect()  # three rows at most, see compact
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    found = [Live(r.upto, tuple((s.low, s.high, s.level) for s in r.segments), r.generation) for r in rows]
    return sorted([*found, Live(START_BATCH, (), 0)], key=lambda live: -live.generation)


def read_versions(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """All rows with their batch_id; those of merged batches carry the last batch of their folder."""
    return _read(spark, schema, path, _manifests(spark, path)[0])


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(BATCH, T.LongType())])


def _read(spark: SparkSession, schema: T.StructType, path: str, live: Live) -> DataFrame:
    recent = spark.read.schema(_with_batch(schema)).parquet(path)
    if not live.segments:
        return recent
    merged = spark.read.schema(_with_batch(schema)).parquet(*live.folders(path))
    return recent.where(F.col(BATCH) > live.upto).unionByName(merged)


def compact(
    spark: SparkSession,
    schema: T.StructType,
    path: str,
    merge: Callable[[DataFrame], DataFrame],
    before: int,
    fanout: int = FANOUT,
) -> bool:
    """Merge the batches before `before`, whenever that is a multiple of `fanout` (2 or more); whether it did.

    `merge` turns rows of the schema into fewer rows that mean the same. As many merged folders of
    one size are merged again, so a row is rewritten with the logarithm of the batches and about
    fanout folders of each size are live. Only one caller at a time: the stream's own batches.

    What a merge leaves behind is deleted by the one after the next, so a reader has the time of one
    merge to the next to finish.
    """
    if before <= 0 or before % fanout:
        return False
    manifests = _manifests(spark, path)
    live = manifests[0]
    if live.upto >= before - 1:  # the batch is replayed
        return False
    every = _with_batch(schema)
    rows = spark.read.schema(every).parquet(path).where(F.col(BATCH).between(live.upto + 1, before - 1))
    segments, first, level = [*live.segments], live.upto + 1, 1
    # A folder that would be the fanout-th of its size becomes one with those before it.
    while [s[2] for s in segments[1 - fanout :]] == [level] * (fanout - 1):
        together = Live(0, tuple(segments[1 - fanout :]), 0)
        rows = rows.unionByName(spark.read.schema(every).parquet(*together.folders(path)))
        del segments[1 - fanout :]
        first, level = together.segments[0][0], level + 1
    merged = merge(rows.drop(BATCH)).select(*schema.fieldNames(), F.lit(before - 1).cast("bigint").alias(BATCH))
    merged.write.mode("overwrite").parquet(f"{path}-merged/{first}-{before - 1}")
    segments.append((first, before - 1, level))

    now = Live(before - 1, tuple(segments), live.generation + 1)
    listed = F.array(*[F.struct(*map(F.lit, segment)) for segment in now.segments])
    row = spark.range(1, numPartitions=1).select(
        F.lit(now.upto).cast("bigint").alias("upto"), listed.cast(MANIFEST["segments"].dataType).alias("segments")
    )
    row.write.mode("overwrite").parquet(f"{path}-manifest/generation={now.generation}")
    _clear(spark, path, now, manifests)
    return True


def _clear(spark: SparkSession, path: str, now: Live, earlier: list[Live]) -> None:
    """Delete what the last manifest but one had dropped already."""
    kept, old = earlier[0], earlier[1] if len(earlier) > 1 else None
    if old is None:
        return
    for batch_id in range(old.upto + 1, kept.upto + 1):
        remove(spark, f"{path}/{BATCH}={batch_id}")
    for folder in set(old.folders(path)) - set(kept.folders(path)) - set(now.folders(path)):
        remove(spark, folder)
    if old.generation:
        remove(spark, f"{path}-manifest/generation={old.generation}")


def latest(versions: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the newest batch for each key."""
    rest = [c for c in versions.columns if c not in (*keys, BATCH)]
    newest = F.max_by(F.struct(*rest), F.col(BATCH)).alias("newest")
    return versions.groupBy(*keys).agg(newest).select(*keys, "newest.*")
