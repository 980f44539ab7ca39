"""JSON event directories, batch and stream, and the good / corrupt split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxmill.functions.events import parsed_stamp_us
from fluxmill.constants import UNKNOWN_TYPE
from fluxmill.schemas import CORRUPT_COLUMN, EVENTS, EVENTS_WITH_CORRUPT, struct

EVENT_GLOB = "evt_*.json"
TEXT_EVENTS = struct(**{name: "string" for name in EVENTS_WITH_CORRUPT.fieldNames()})


def decode_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """JSON text in a column (files, a log topic, a landing table) to event columns.

    Text that is no JSON object stays in _corrupt_record. A field of another type is converted, or
    null where it cannot be; the rest of the event counts. User ids that are no numbers become
    numbers by a hash, so that distinct users stay distinct.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    decoded = lines.withColumn("event", F.from_json(value, TEXT_EVENTS, options))
    unread = F.when(F.col("event").isNull(), F.coalesce(F.col(value), F.lit("")))
    rest = [c for c in lines.columns if c != value]
    return decoded.select(
        *rest,
        *[_field(f.name, f.dataType.simpleString()).alias(f.name) for f in EVENTS.fields],
        F.coalesce(F.col("event").getField(CORRUPT_COLUMN), unread).alias(CORRUPT_COLUMN),
    )


def _field(name: str, kind: str) -> Column:
    text = F.col("event").getField(name)
    if kind == "string":
        return text
    number = text.try_cast("double")
    if kind == "double":
        return number
    whole = F.coalesce(text.try_cast("bigint"), number.try_cast("bigint"))
    if name == "user_id":
        whole = F.coalesce(whole, F.when(text.isNotNull(), F.xxhash64(text)))
    return whole.try_cast(kind)


def read_events(spark: SparkSession, path: str, glob: str = EVENT_GLOB) -> DataFrame:
    """Events of a directory, one JSON object per line, received when their file was written.

    The receive time is the file's, so every read of the directory gives the same rows.
    """
    lines = spark.read.option("pathGlobFilter", glob).text(path)
    return decode_lines(lines.select("value", F.unix_micros("_metadata.file_modification_time").alias("receive_us")))


def stream_events(
    spark: SparkSession,
    path: str,
    glob: str = EVENT_GLOB,
    files_per_trigger: int | None = None,
    clean_source: str = "off",
    archive_dir: str | None = None,
) -> DataFrame:
    """The directory as a stream. clean_source "delete" or "archive" consumes finished files."""
    reader = spark.readStream.option("pathGlobFilter", glob).option("cleanSource", clean_source)
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return decode_lines(reader.text(path))


# One directory for each rate a load test was run at, and the rate in its name.
LOAD_DIRECTORIES = "load_*"
LOAD_RATE = r"/load_(\d+)/[^/]*$"
LOAD_LINES = struct(target_rate="integer", value="string", receive_us="long", file="string")


def load_lines(lines: DataFrame) -> DataFrame:
    """Lines read from load directories with the rate and time of their file; directories of other names are left out."""
    path = F.col("_metadata.file_path")
    return lines.select(
        F.regexp_extract(path, LOAD_RATE, 1).try_cast("int").alias("target_rate"),
        "value",
        F.unix_micros("_metadata.file_modification_time").alias("receive_us"),
        path.alias("file"),
    ).where("target_rate is not null")


def read_load_lines(spark: SparkSession, path: str, glob: str = EVENT_GLOB) -> DataFrame:
    """All load directories under path as one table."""
    return load_lines(spark.read.option("pathGlobFilter", glob).text(f"{path}/{LOAD_DIRECTORIES}"))


def stream_load_lines(
    spark: SparkSession, path: str, glob: str = EVENT_GLOB, files_per_trigger: int | None = None, consume: bool = False
) -> DataFrame:
    """The same as one stream, directories that appear later included."""
    reader = spark.readStream.option("pathGlobFilter", glob).option("cleanSource", "delete" if consume else "off")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return load_lines(reader.text(f"{path}/{LOAD_DIRECTORIES}"))


def load_events(lines: DataFrame) -> DataFrame:
    """Lines of load directories as parsed events with the size of each message; undecodable lines have no usable stamp."""
    sized = lines.withColumn("size", F.length("value"))
    return parse_events(decode_lines(sized)).withColumnRenamed("target_rate", "load_level").drop(CORRUPT_COLUMN)


def is_corrupt() -> Column:
    return F.col(CORRUPT_COLUMN).isNotNull()


def quarantined(events: DataFrame) -> DataFrame:
    """Lines that could not be decoded, with their text."""
    return events.where(is_corrupt())


def decoded_only(events: DataFrame) -> DataFrame:
    return events.where(~is_corrupt()).drop(CORRUPT_COLUMN)


def received_now(events: DataFrame) -> DataFrame:
    """Stamp the receive time. In a stream this is the micro-batch time, which the offset log
    keeps, so a replayed batch gets the same value."""
    return events.withColumn("receive_us", F.unix_micros(F.current_timestamp()))


def parse_events(events: DataFrame) -> DataFrame:
    """Event time in microseconds with the receive time as fallback, and defaults for what is missing.

    `stamp_ok` is false where the fallback was used; reports count those rows as errors.
    """
    stamp_us = parsed_stamp_us(F.col("timestamp"))
    return events.withColumns(
        {
            "stamp_ok": stamp_us.isNotNull(),
            "event_us": F.coalesce(stamp_us, F.col("receive_us")),
            "event_type": F.coalesce(F.col("event_type"), F.lit(UNKNOWN_TYPE)),
            "cart_value": F.coalesce(F.col("cart_value"), F.lit(0.0)),
            "page_views": F.coalesce(F.col("page_views"), F.lit(0)),
            "clicks": F.coalesce(F.col("clicks"), F.lit(0)),
        }
    ).drop("timestamp")


def write_event_files(events: DataFrame, path: str) -> None:
    """Events as JSON lines, one file per task."""
    events.select(*EVENTS.fieldNames()).write.mode("append").json(path)
