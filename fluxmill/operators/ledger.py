"""Statistics of a growing directory of user files, fitted file by file.

The ledger holds the partial aggregates of each file: one row per file and region. A new or rewritten file
is read once; a file that is gone takes its rows out of the sum. Extremes are kept per file too, so
nothing has to be read again when the file that held one goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxmill.operators.imputation import cast_users
from fluxmill.operators.profiles import merged_profile, partials
from fluxmill.schemas import struct
from fluxmill.sources import versions as V
from fluxmill.workspace import scratch, stored

FILE = ["file", "modified_us", "size"]
LEDGER = struct(
    file="string",
    modified_us="long",
    size="long",
    region="string",
    rows="long",
    session_sum="double",
    session_n="long",
    session_min="double",
    session_max="double",
    clicks_sum="long",
    clicks_n="long",
    income_sum="double",
    income_n="long",
    cart_sum="double",
    cart_n="long",
    views_min="integer",
    views_max="integer",
)


def _plain(path: Column) -> Column:
    """A path without escapes and repeated slashes after the scheme, however it is spelled."""
    readable = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(readable, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def _files(spark: SparkSession, source: str) -> DataFrame:
    """The user files there are now, from their listing alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    percent = F.replace("path", F.lit("%"), F.lit("%25"))  # this path is not escaped
    return listed.load(source).select(
        _plain(percent).alias("file"),
        F.unix_micros("modificationTime").alias("modified_us"),
        F.col("length").alias("size"),
        "path",
    )


def start_ledger(spark: SparkSession, path: str) -> None:
    V.start_versions(spark, LEDGER, path)


def update_ledger(spark: SparkSession, source: str, path: str) -> int:
    """Read the files under source that the ledger does not hold as they are; how many these were.

    One writer at a time. The names of new files pass through the driver, as those of any read do.
    """
    with scratch(spark, "ledger"):
        return _update(spark, source, path)


def _update(spark: SparkSession, source: str, path: str) -> int:
    held = V.read_versions(spark, LEDGER, path)
    files = stored(_files(spark, source), "files")
    new = [row.path for row in files.join(held, FILE, "left_anti").select("path").collect()]
    number = held.agg(F.coalesce(F.max(V.BATCH), F.lit(V.START_BATCH)) + 1).first()[0]
    if new:
        users = spark.read.parquet(*new)
        seen = users.select(
            _plain(F.col("_metadata.file_path")).alias("file"),
            F.unix_micros("_metadata.file_modification_time").alias("modified_us"),
            F.col("_metadata.file_size").alias("size"),
            *users.columns,
        )
        rows = cast_users(seen).groupBy(*FILE, "region").agg(*partials())
        V.write_version(rows.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER.fields]), path, number)

    def still_there(rows: DataFrame) -> DataFrame:
        return rows.join(files, FILE, "left_semi")

    V.compact(spark, LEDGER, path, still_there, number)
    return len(new)


def ledger_profile(spark: SparkSession, source: str, path: str) -> DataFrame:
    """The profile of the files under source, as profiles.fit_profile has it, without reading them.

    Files that came or changed since the last update are not in it.
    """
    held = V.read_versions(spark, LEDGER, path).drop(V.BATCH)
    parts = held.join(_files(spark, source), FILE, "left_semi").drop(*FILE)
    return stored(merged_profile(parts), "region-profile")
