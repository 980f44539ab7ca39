"""Explicit schemas for the tables this library reads and writes."""

from pyspark.sql import types as T


def struct(**columns: str | T.DataType) -> T.StructType:
    """A schema from column names and types, all nullable."""
    schema = T.StructType()
    for name, data_type in columns.items():
        schema = schema.add(name, data_type)
    return schema


USERS = struct(
    user_id="long",
    age="integer",
    income="double",
    session_time="double",
    page_views="integer",
    clicks="integer",
    cart_value="double",
    device_type="string",
    region="string",
    label="byte",
)

FEATURE_COLUMNS = USERS.fieldNames() + [
    "click_through_rate", "cart_per_pageview", "log_income", "log_cart_value",
    "age_group", "income_bracket",
    "device_mobile", "device_desktop", "device_tablet",
    "region_north", "region_south", "region_east", "region_west", "region_central",
    "region_avg_session", "region_avg_clicks", "session_vs_region_avg",
    "session_time_norm", "page_views_norm", "income_x_pageviews",
]

# What a producer writes: one JSON object per event.
EVENTS = struct(
    event_id="string",
    user_id="long",
    event_type="string",
    timestamp="string",
    session_time="double",
    page_views="integer",
    clicks="integer",
    cart_value="double",
    device_type="string",
    region="string",
    income="double",
)

CORRUPT_COLUMN = "_corrupt_record"
EVENTS_WITH_CORRUPT = T.StructType(EVENTS.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])

WINDOW_METRICS = struct(
    window_start="string",
    window_end="string",
    message_count="long",
    late_count="long",
    unique_users="long",
    event_counts=T.MapType(T.StringType(), T.LongType()),
    total_cart_value="double",
    avg_session_time="double",
    click_through_rate="double",
    latency_p50_ms="double",
    latency_p95_ms="double",
    latency_p99_ms="double",
    latency_max_ms="double",
)

STREAM_SUMMARY = struct(
    total_processed="long",
    total_errors="long",
    elapsed_sec="double",
    throughput_per_s="double",
    latency_p50_ms="double",
    latency_p95_ms="double",
    latency_p99_ms="double",
    latency_max_ms="double",
    queue_depth_max="long",
    queue_depth_avg="double",
)

LOAD_LEVELS = struct(
    target_rate="integer",
    sent="long",
    errors="long",
    bytes="long",
    elapsed="double",
    avg_rate="double",
    processed="long",
    throughput="double",
    latency_p50_ms="double",
    latency_p95_ms="double",
    latency_p99_ms="double",
    queue_depth_max="long",
)

RUN_METRICS = struct(
    mode="string",
    partitions="integer",
    input_rows="long",
    output_rows="long",
    total_runtime_sec="double",
    spark_master="string",
    spark_app_id="string",
    default_parallelism="integer",
)

# The driver's stream table as it lies on disk (mapped to EVENTS shape in sources.adapters).
EVENT_LOG = struct(
    event_id="long",
    ts="timestamp_ntz",
    user_id="long",
    event_type="string",
    value="double",
    props="string",
)
