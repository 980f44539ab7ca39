"""Equivalent SQL for the queries, written for DuckDB over the driver's tables."""

from __future__ import annotations

from fluxmill import constants as C
from fluxmill.plans.queries import (
    BASE_RATE,
    BUCKET_SEC,
    MAX_LAG_SEC,
    REPLAY_DELAY_US,
    RUN_SEC,
    RUN_START_S,
    WINDOW_SEC,
)


def rounded(expression: str, digits: int = 6) -> str:
    scale = f"1e{digits}"
    return f"(round_even(({expression}) * {scale}, 0) / {scale} + 0.0)"


# -- users --

USERS = """
users as (
  select o_orderkey as user_id,
         cast(18 + (o_custkey * 31) % 72 as integer) as age,
         case when o_orderkey % 20 = 3 then null else 10000 + (c_acctbal + 1000) * 20 end as income,
         o_totalprice / 2000 as session_time,
         cast(o_orderkey % 17 as integer) as page_views,
         cast(o_custkey % 11 as integer) as clicks,
         case when o_orderkey % 20 = 7 then null else o_totalprice / 100 end as cart_value,
         case when o_orderkey % 20 < 11 then 'mobile' when o_orderkey % 20 < 18 then 'desktop' else 'tablet' end as device_type,
         case r_name when 'AFRICA' then 'north' when 'AMERICA' then 'south' when 'ASIA' then 'east'
                     when 'EUROPE' then 'west' else 'central' end as region,
         case when o_orderstatus = 'F' then 1 else 0 end as label
  from orders
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
)"""

STATS = """
stats as (
  select avg(income) as income_mean, avg(cart_value) as cart_mean,
         min(session_time) as session_min, max(session_time) as session_max,
         min(page_views) as views_min, max(page_views) as views_max
  from users
)"""

FILLED = f"""
filled as (
  select users.* replace (
    coalesce(income, nullif(income_mean, 0), {C.DEFAULT_INCOME}) as income,
    coalesce(cart_value, nullif(cart_mean, 0), {C.DEFAULT_CART_VALUE}) as cart_value)
  from users, stats
)"""

RATIO_CLICKS = "case when page_views > 0 then cast(clicks as double) / page_views else 0.0 end"
RATIO_CART = "case when page_views > 0 then cart_value / page_views else 0.0 end"


def log1p(column: str) -> str:
    return f"case when {column} > -1 then ln(1 + {column}) end"


def bins(column: str, edges: list[tuple[float, str]], last: str) -> str:
    arms = " ".join(f"when {column} < {edge} then '{label}'" for edge, label in edges)
    return f"case {arms} else '{last}' end"


def flags(column: str, prefix: str, values: list[str]) -> str:
    return ", ".join(f"cast({column} = '{v}' as integer) as {prefix}_{v}" for v in values)


AGE_GROUP = bins("age", C.AGE_EDGES, C.AGE_LAST)
INCOME_BRACKET = bins("income", C.INCOME_EDGES, C.INCOME_LAST)
DEVICE_FLAGS = flags("device_type", "device", C.DEVICES)
REGION_FLAGS = flags("region", "region", C.REGIONS)
REGION_SESSION = "avg(session_time) over (partition by region)"
REGION_CLICKS = "avg(clicks) over (partition by region)"
SESSION_NORM = "(session_time - session_min) / coalesce(nullif(session_max - session_min, 0), 1.0)"
VIEWS_NORM = "cast(page_views - views_min as double) / coalesce(nullif(views_max - views_min, 0), 1)"

RAW_ROUNDED = f"""user_id, age, {rounded('income')} as income, {rounded('session_time')} as session_time,
  page_views, clicks, {rounded('cart_value')} as cart_value, device_type, region, label"""

FEATURES = f"""
with {USERS}, {STATS}, {FILLED}
select {RAW_ROUNDED},
  {rounded(RATIO_CLICKS)} as click_through_rate,
  {rounded(RATIO_CART)} as cart_per_pageview,
  {rounded(log1p('income'))} as log_income,
  {rounded(log1p('cart_value'))} as log_cart_value,
  {AGE_GROUP} as age_group,
  {INCOME_BRACKET} as income_bracket,
  {DEVICE_FLAGS}, {REGION_FLAGS},
  {rounded(REGION_SESSION)} as region_avg_session,
  {rounded(REGION_CLICKS)} as region_avg_clicks,
  {rounded(f'session_time - {REGION_SESSION}')} as session_vs_region_avg,
  {rounded(SESSION_NORM)} as session_time_norm,
  {rounded(VIEWS_NORM)} as page_views_norm,
  {rounded('income * page_views')} as income_x_pageviews
from filled, stats"""

LEFT_USERS = USERS.replace("users as (", "all_users as (") + """, users as (select * from all_users where user_id % 4 <> 1)"""

USER_ORACLES = {
    "scan_users": f"with {USERS} select {RAW_ROUNDED} from users",
    "cast_schema": f"""
with {USERS}, marked as (select *, user_id % 23 = 5 as bad from users)
select user_id,
  case when not bad then age end as age,
  case when not bad then {rounded('income')} end as income,
  {rounded('session_time')} as session_time,
  cast(trunc(page_views + 0.7) as integer) as page_views,
  clicks,
  case when not bad then {rounded('cart_value')} end as cart_value,
  device_type, region, label
from marked""",
    "feature_stats": f"""
with {USERS}, {STATS}
select {rounded('income_mean')} as income_mean, {rounded('cart_mean')} as cart_mean,
  {rounded('session_min')} as session_min, {rounded('session_max')} as session_max, views_min, views_max
from stats""",
    "impute_mean": f"""
with {USERS}, {STATS}, {FILLED}
select user_id, {rounded('income')} as income, {rounded('cart_value')} as cart_value from filled""",
    "ratio_features": f"""
with {USERS}
select user_id, {rounded(RATIO_CLICKS)} as click_through_rate, {rounded(RATIO_CART)} as cart_per_pageview from users""",
    "log_features": f"""
with {USERS}
select user_id, {rounded(log1p('income'))} as log_income, {rounded(log1p('cart_value'))} as log_cart_value from users""",
    "age_bins": f"with {USERS} select user_id, age, {AGE_GROUP} as age_group from users",
    "income_bins": f"with {USERS} select user_id, {INCOME_BRACKET} as income_bracket from users",
    "onehot_device": f"with {USERS} select user_id, {DEVICE_FLAGS} from users",
    "onehot_region": f"with {USERS} select user_id, {REGION_FLAGS} from users",
    "region_profile": f"""
with {USERS}
select user_id, region, {rounded(REGION_SESSION)} as region_avg_session,
  {rounded(REGION_CLICKS)} as region_avg_clicks,
  {rounded(f'session_time - {REGION_SESSION}')} as session_vs_region_avg
from users""",
    "minmax_norm": f"""
with {USERS}, {STATS}
select user_id, {rounded(SESSION_NORM)} as session_time_norm, {rounded(VIEWS_NORM)} as page_views_norm
from users, stats""",
    "interaction": f"""
with {USERS}, {STATS}, {FILLED}
select user_id, {rounded('income * page_views')} as income_x_pageviews from filled""",
    "feature_table": FEATURES,
    "feature_files": FEATURES,
    "stream_features": FEATURES,
    "incremental_profile": f"""
with {LEFT_USERS}, {STATS}
select region, {rounded('avg(session_time)')} as region_avg_session, {rounded('avg(clicks)')} as region_avg_clicks,
  {rounded('any_value(income_mean)')} as income_mean, {rounded('any_value(cart_mean)')} as cart_mean,
  {rounded('any_value(session_min)')} as session_min, {rounded('any_value(session_max)')} as session_max,
  any_value(views_min) as views_min, any_value(views_max) as views_max
from users, stats group by region""",
    "row_counts": f"with {USERS} select count(*) as input_rows, count(*) as output_rows from users",
}


# -- events --

EVENTS = """
mapped as (
  select event_id, user_id,
    case event_type when 'view' then 'page_view' when 'click' then 'click' when 'signup' then 'add_to_cart'
                    when 'purchase' then 'purchase' end as event_type,
    epoch_us(ts) as event_us,
    epoch_us(ts) + 5000 + (event_id % 50) * 1000
      + case when event_id % 97 = 5 then 10800000000 when event_id % 31 = 4 then 4500000000 else 0 end as receive_us,
    case when event_id % 10 = 0 then 0.0 else value end as session_time,
    cast(1 + event_id % 20 as integer) as page_views,
    cast(event_id % 11 as integer) as clicks,
    case when event_type in ('signup', 'purchase') then value else 0.0 end as cart_value,
    case event_id % 3 when 0 then 100 when 1 then 1000 else 5000 end as load_level,
    props as payload
  from events
)"""

WIDTH = WINDOW_SEC * 1_000_000
ROWS = f"""
rows as (
  select *,
    coalesce(event_type, 'unknown') as kind,
    cast(floor(event_us / {WIDTH}) as bigint) * {WINDOW_SEC} as window_start_s,
    receive_us - event_us as latency_us,
    floor(event_us / {WIDTH}) < floor(receive_us / {WIDTH}) - 1
      and receive_us - event_us > {MAX_LAG_SEC * 1_000_000} as late
  from mapped
), good as (select * from rows where not late)"""

RAW_EVENTS = """
raw as (
  select event_id,
    case when event_id % 41 <> 7 then user_id end as user_id,
    coalesce(event_type, 'unknown') as event_type,
    case when event_id % 89 = 7 or event_id % 83 = 5 then receive_us else event_us end as event_us,
    receive_us,
    not (event_id % 89 = 7 or event_id % 83 = 5) as stamp_ok,
    session_time,
    case when event_id % 43 <> 8 then page_views else 0 end as page_views,
    case when event_id % 47 <> 9 then clicks else 0 end as clicks,
    case when event_id % 53 <> 6 then cart_value else 0.0 end as cart_value
  from mapped
)"""


def ranks(source: str, key: str) -> str:
    picks = ", ".join(
        f"max(case when place = greatest(1, (total * {p}) // 100) then latency_us end) as p{p}" for p in C.PERCENTS
    )
    return f"""
ordered as (
  select {key}, latency_us, row_number() over (partition by {key} order by latency_us) as place,
    count(*) over (partition by {key}) as total
  from {source}
), ranked as (select {key}, {picks}, max(latency_us) as top from ordered group by {key})"""


CART = rounded("coalesce(sum(case when cart_value > 0 then cart_value end), 0.0)", 2)
SESSION = rounded(
    f"coalesce({rounded('sum(nullif(session_time, 0))')} / nullif(count(nullif(session_time, 0)), 0), 0.0)", 3
)
CTR = rounded("case when sum(page_views) > 0 then cast(sum(clicks) as double) / sum(page_views) else 0.0 end", 4)
USERS_PER_WINDOW = "cast(count(distinct user_id) + max(cast(user_id is null as integer)) as bigint)"


def iso(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds}) * 1000000::bigint), '%Y-%m-%dT%H:%M:%S+00:00')"


def window_report(events: str = EVENTS) -> str:
    return f"""
with {events}, {ROWS}, {ranks('good', 'window_start_s')},
types as (
  select window_start_s, '{{' || string_agg('"' || kind || '":' || n, ',' order by kind) || '}}' as event_counts
  from (select window_start_s, kind, count(*) as n from good group by all) group by 1),
sums as (
  select window_start_s, count(*) as message_count, {USERS_PER_WINDOW} as unique_users,
    {CART} as total_cart_value, {SESSION} as avg_session_time, {CTR} as click_through_rate
  from good group by 1),
late as (select window_start_s, cast(count_if(late) as bigint) as late_count from rows group by 1)
select {iso('window_start_s')} as window_start, {iso(f'window_start_s + {WINDOW_SEC}')} as window_end,
  coalesce(message_count, 0) as message_count, late_count, coalesce(unique_users, 0) as unique_users,
  coalesce(event_counts, '{{}}') as event_counts,
  coalesce(total_cart_value, 0.0) as total_cart_value, coalesce(avg_session_time, 0.0) as avg_session_time,
  coalesce(click_through_rate, 0.0) as click_through_rate,
  coalesce(p50 / 1000, 0.0) as latency_p50_ms, coalesce(p95 / 1000, 0.0) as latency_p95_ms,
  coalesce(p99 / 1000, 0.0) as latency_p99_ms, coalesce(top / 1000, 0.0) as latency_max_ms
from late left join sums using (window_start_s) left join types using (window_start_s)
left join ranked using (window_start_s)"""


WINDOW_REPORT = window_report()


def arrived(parts: int, of: int) -> str:
    """The events of the first parts of the log by receive time."""
    return EVENTS.replace("mapped as (", "logged as (") + f""", mapped as (
  select * from logged where receive_us < (
    select case when {parts} = {of} then max(receive_us) + 1
           else min(receive_us) + (max(receive_us) - min(receive_us)) * {parts} // {of} end from logged)
)"""


def final_windows(events: str) -> str:
    """Windows past their end by max(window, allowed lag) at the last receive time."""
    wait = WINDOW_SEC + max(WINDOW_SEC, MAX_LAG_SEC)
    return f"""
select * from ({window_report(events)})
where epoch_us(cast(window_start as timestamptz)) + {wait * 1_000_000} <= (
  with {events} select max(receive_us) from mapped)"""


STREAM_TYPES = ", ".join(
    f"cast(count_if(kind = '{t}') as bigint) as n_{t}" for t in [*C.EVENT_TYPES, C.UNKNOWN_TYPE]
)
STREAM_WINDOWS = f"""
with {EVENTS}, {ROWS}
select window_start_s, count(*) as message_count, {STREAM_TYPES}, cast(0 as bigint) as n_other,
  {CART} as total_cart_value, {SESSION} as avg_session_time, {CTR} as click_through_rate,
  max(latency_us) / 1000 as latency_max_ms
from good group by 1"""

QUARANTINE = "select event_id as line_id, 1 as corrupt from events where event_id % 101 = 13"

BUCKET = BUCKET_SEC * 1_000_000


def depths(source: str, key: str = "") -> str:
    by = f"{key}, " if key else ""
    part = f"partition by {key} " if key else ""
    return f"""
steps as (
  select {by}cast(floor(event_us / {BUCKET}) as bigint) as bucket, 1 as step from {source}
  union all
  select {by}cast(floor(receive_us / {BUCKET}) as bigint), -1 from {source}),
changes as (select {by}bucket, sum(step) as change from steps group by {by}bucket),
depth as (
  select {by}bucket * {BUCKET_SEC} as bucket_start_s,
    cast(sum(change) over ({part}order by bucket) as bigint) as depth,
    cast(coalesce(lead(bucket) over ({part}order by bucket), bucket + 1) - bucket as bigint) as held_buckets
  from changes)"""


def ms(column: str) -> str:
    return rounded(f"{column} / 1000", 2)


def rate(count: str, low: str, high: str) -> str:
    return rounded(f"{count} / greatest(({high} - {low}) / 1e6, 0.001e0)", 1)


FRACTION = f"((bucket_start_s - {RUN_START_S}) / {RUN_SEC}e0)"

def summary(latest: str = "") -> str:
    """`latest` orders and limits the events whose latencies count."""
    return f"""
with {EVENTS}, {RAW_EVENTS},
usable as (select 1 as one, receive_us - event_us as latency_us from raw where stamp_ok {latest}),
{ranks('usable', 'one')}, {depths('raw')}
select (select count(*) from raw where stamp_ok) as total_processed,
  (select count(*) from raw where not stamp_ok) as total_errors,
  (select {rounded('(max(receive_us) - min(receive_us)) / 1e6', 2)} from raw) as elapsed_sec,
  (select {rate('count_if(stamp_ok)', 'min(receive_us)', 'max(receive_us)')} from raw) as throughput_per_s,
  {ms('p50')} as latency_p50_ms, {ms('p95')} as latency_p95_ms, {ms('p99')} as latency_p99_ms, {ms('top')} as latency_max_ms,
  (select max(depth) from depth) as queue_depth_max,
  (select {rounded('cast(sum(depth * held_buckets) as double) / sum(held_buckets)', 2)} from depth) as queue_depth_avg
from ranked"""


SUMMARY = summary()
LATEST = "order by receive_us desc, cast(event_id as varchar) desc limit 500"


EVENT_ORACLES = {
    "parse_events": f"""
with {EVENTS}, {RAW_EVENTS}
select cast(event_id as varchar) as event_id, user_id, event_type, event_us, receive_us, stamp_ok,
  {rounded('session_time')} as session_time, page_views, clicks, {rounded('cart_value')} as cart_value
from raw""",
    "quarantine": QUARANTINE,
    "stream_quarantine": QUARANTINE,
    "decoded_events": f"""
with {EVENTS}, {RAW_EVENTS}
select event_id as line_id, cast(event_id as varchar) as event_id, user_id, event_type, event_us, stamp_ok,
  page_views, {rounded('cart_value')} as cart_value
from raw where event_id % 101 <> 13""",
    "event_latency": f"with {EVENTS} select event_id, (receive_us - event_us) / 1000 as latency_ms from mapped",
    "late_flags": f"with {EVENTS}, {ROWS} select event_id, window_start_s, cast(late as integer) as late from rows",
    "late_audit": f"""
with {EVENTS}, {ROWS}
select window_start_s, cast(count_if(not late) as bigint) as message_count, cast(count_if(late) as bigint) as late_count
from rows group by 1""",
    "stream_late": f"""
with {EVENTS}, {ROWS} select window_start_s, count(*) as late_count from rows where late group by 1""",
    "traffic_phases": f"""
with {EVENTS}, buckets as (
  select cast(floor(event_us / {BUCKET}) as bigint) * {BUCKET_SEC} as bucket_start_s, count(*) as event_count
  from mapped group by 1)
select bucket_start_s,
  case when {FRACTION} < 0.2e0 then 'ramp_up' when {FRACTION} < 0.6e0 then 'steady' when {FRACTION} < 0.75e0 then 'burst'
       when {FRACTION} < 0.9e0 then 'steady' else 'cool_down' end as phase,
  cast(case when {FRACTION} < 0.2e0 then greatest(1, trunc({BASE_RATE}e0 * ({FRACTION} / 0.2e0)))
       when {FRACTION} < 0.6e0 then {BASE_RATE} when {FRACTION} < 0.75e0 then 3 * {BASE_RATE}
       when {FRACTION} < 0.9e0 then {BASE_RATE}
       else greatest(1, trunc({BASE_RATE}e0 * ((1e0 - {FRACTION}) / 0.1e0))) end as bigint) as target_rate,
  event_count, {rounded(f'event_count / {BUCKET_SEC}e0')} as observed_rate
from buckets""",
    "dedup_events": f"""
with {EVENTS}, copies as (
  select * from mapped union all
  select * replace (receive_us + {REPLAY_DELAY_US} as receive_us) from mapped where event_id % 7 = 3),
firsts as (select *, row_number() over (partition by event_id order by receive_us) as place from copies)
select event_id, user_id, event_type, event_us, receive_us, {rounded('session_time')} as session_time,
  page_views, clicks, {rounded('cart_value')} as cart_value, load_level, payload
from firsts where place = 1""",
    "stream_dedup_events": f"with {EVENTS} select event_id, user_id, event_type, event_us from mapped",
    "window_counts": f"""
with {EVENTS}, {ROWS} select window_start_s, count(*) as message_count from good group by 1""",
    "window_unique_users": f"""
with {EVENTS}, {ROWS} select window_start_s, {USERS_PER_WINDOW} as unique_users from good group by 1""",
    "window_event_counts": f"""
with {EVENTS}, {ROWS} select window_start_s, kind as event_type, count(*) as event_count from good group by 1, 2""",
    "window_cart": f"with {EVENTS}, {ROWS} select window_start_s, {CART} as total_cart_value from good group by 1",
    "window_session": f"with {EVENTS}, {ROWS} select window_start_s, {SESSION} as avg_session_time from good group by 1",
    "window_ctr": f"with {EVENTS}, {ROWS} select window_start_s, {CTR} as click_through_rate from good group by 1",
    "window_latency_pct": f"""
with {EVENTS}, {ROWS}, {ranks('good', 'window_start_s')}
select window_start_s, p50 / 1000 as latency_p50_ms, p95 / 1000 as latency_p95_ms, p99 / 1000 as latency_p99_ms,
  top / 1000 as latency_max_ms
from ranked""",
    "window_metrics": WINDOW_REPORT,
    "stream_window_exact": WINDOW_REPORT,
    "stream_published": final_windows(arrived(2, 4)),
    "stream_corrections": final_windows(EVENTS),
    "stream_merged_batches": WINDOW_REPORT,
    "stream_window_metrics": STREAM_WINDOWS,
    "stream_resume": STREAM_WINDOWS,
    "stream_closed_windows": f"""
select * from ({STREAM_WINDOWS})
where (window_start_s + {WINDOW_SEC}) * 1000 <= (
  with {EVENTS}, {ROWS} select max(event_us) // 1000 - {max(WINDOW_SEC, MAX_LAG_SEC) * 1000} from good)""",
    "stream_summary": SUMMARY,
    "stream_run_summary": SUMMARY,
    "stream_recent_summary": summary(LATEST),
    "stream_recent_latency": f"""
with {EVENTS}
select cast(event_id as varchar) as event_id, receive_us, receive_us - event_us as latency_us from mapped {LATEST}""",
    "stream_sketched_windows": f"""
select cast(epoch_us(cast(window_start as timestamptz)) // 1000000 as bigint) as window_start_s,
  message_count, late_count, event_counts, total_cart_value, latency_max_ms,
  true as users_within, true as latency_within
from ({WINDOW_REPORT})""",
    "recent_latency": f"""
with {EVENTS}
select event_id, receive_us, receive_us - event_us as latency_us from mapped
order by receive_us desc, event_id desc limit 500""",
    "load_levels": f"""
with {EVENTS}, levels as (select *, load_level as target_rate, receive_us - event_us as latency_us from mapped),
{ranks('levels', 'target_rate')}, {depths('levels', 'target_rate')},
sums as (
  select target_rate, count(*) as sent, cast(0 as bigint) as errors, cast(sum(length(payload)) as bigint) as bytes,
    {rounded('(max(event_us) - min(event_us)) / 1e6', 2)} as elapsed,
    {rate('count(*)', 'min(event_us)', 'max(event_us)')} as avg_rate,
    count(*) as processed, {rate('count(*)', 'min(receive_us)', 'max(receive_us)')} as throughput
  from levels group by 1),
deepest as (select target_rate, max(depth) as queue_depth_max from depth group by 1)
select target_rate, sent, errors, bytes, elapsed, avg_rate, processed, throughput,
  {ms('p50')} as latency_p50_ms, {ms('p95')} as latency_p95_ms, {ms('p99')} as latency_p99_ms, queue_depth_max
from sums join ranked using (target_rate) join deepest using (target_rate)""",
    "load_directories": f"""
with {EVENTS}, {RAW_EVENTS}, messages as (
  select event_id % 3 as level, event_us, event_id % 101 = 13 as torn, stamp_ok and event_id % 101 <> 13 as good,
    '{{"event_id": "' || event_id || '", "user_id": ' || coalesce(cast(user_id as varchar), 'null') || ', "timestamp": '
      || case when event_id % 89 = 7 then '"not a time"' when event_id % 83 = 5 then 'null'
         else '"' || strftime(make_timestamp(event_us), '%Y-%m-%dT%H:%M:%S.%f')
              || case when event_id % 2 = 0 then 'Z' else '+00:00' end || '"' end
      || ', "clicks": ' || case when event_id % 47 <> 9 then cast(clicks as varchar) else 'null' end || '}}' as body
  from raw)
select case level when 0 then 100 when 1 then 1000 else 5000 end as target_rate, count(*) as sent,
  cast(count_if(not good) as bigint) as errors,
  cast(sum(length(message)) as bigint) as bytes,
  {rounded('(max(event_us) filter (good) - min(event_us) filter (good)) / 1e6', 2)} as elapsed,
  {rate('count(*)', 'min(event_us) filter (good)', 'max(event_us) filter (good)')} as avg_rate,
  cast(count_if(good) as bigint) as processed, cast(0 as bigint) as lines_left
from (select *, case when torn then body[1:20] else body end as message from messages)
group by level""",
    "backlog_depth": f"""
with {EVENTS}, {depths('mapped')} select bucket_start_s, depth, held_buckets from depth""",
}


ORACLES: dict[str, str] = {**USER_ORACLES, **EVENT_ORACLES}
ORACLES["feature_partitions"] = ORACLES["feature_table"]
ORACLES["json_report"] = ORACLES["load_levels"]
