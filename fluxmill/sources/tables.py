"""Parquet and JSON tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fluxmill import schemas


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """A user directory. The file's own types are kept; cast_users sets them afterwards."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_event_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.EVENT_LOG).parquet(f"{folder}/events.parquet")


def stream_event_log(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same table as a stream; the glob keeps its neighbours in the folder out."""
    reader = spark.readStream.schema(schemas.EVENT_LOG).option("pathGlobFilter", "events.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def write_features(features: DataFrame, path: str) -> None:
    features.write.mode("overwrite").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report of a few rows as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)
