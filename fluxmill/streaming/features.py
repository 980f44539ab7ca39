"""The feature table on a stream of users, with a stored profile.

Features need statistics of the whole table. They come from a profile that was fitted before and is kept in
versions; each micro-batch is joined with the newest one and says which that was. New profiles
take effect with the next batch, without a restart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from fluxmill.operators.ledger import FILE, LEDGER
from fluxmill.plans.feature_table import transform
from fluxmill.sources import versions as V

PROFILE = T.StructType([f for f in LEDGER.fields if f.name not in FILE])


def save_profile(profile: DataFrame, path: str) -> int:
    """Keep a fitted profile as the next version; its number."""
    spark = profile.sparkSession
    V.start_versions(spark, PROFILE, path)
    number = _newest(spark, path) + 1
    V.write_version(profile.select(*[F.col(f.name).cast(f.dataType) for f in PROFILE.fields]), path, number)
    return number


def _versions(spark: SparkSession, path: str) -> DataFrame:
    return V.read_versions(spark, PROFILE, path)


def _newest(spark: SparkSession, path: str) -> int:
    return _versions(spark, path).agg(F.coalesce(F.max(V.BATCH), F.lit(V.START_BATCH))).first()[0]


def load_profile(spark: SparkSession, path: str, version: int | None = None) -> tuple[DataFrame, int]:
    """A version of the profile, the newest without a number, and that number."""
    number = _newest(spark, path) if version is None else version
    return _versions(spark, path).where(F.col(V.BATCH) == number).drop(V.BATCH), number


def features_writer(users: DataFrame, profile_path: str, path: str, checkpoint: str) -> DataStreamWriter:
    """Features of a stream of user rows, one folder per batch; a replayed batch replaces its own."""
    spark = users.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        profile, number = load_profile(spark, profile_path)
        if number == V.START_BATCH:
            raise ValueError(f"no profile in {profile_path}")
        V.write_version(transform(batch, profile).withColumn("profile_version", F.lit(number)), path, batch_id)

    return users.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(V.BATCH)
