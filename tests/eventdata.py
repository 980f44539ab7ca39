"""Random event rows with the awkward cases mixed in."""

import random

from fluxmill.schemas import struct

EVENT_ROWS = struct(
    event_id="long",
    user_id="long",
    event_type="string",
    event_us="long",
    receive_us="long",
    session_time="double",
    page_views="integer",
    clicks="integer",
    cart_value="double",
)
START_US = 1_700_000_000_000_000


def random_events(count, seed=1, span_sec=600, max_lag_sec=200, ahead=False):
    rng = random.Random(seed)
    rows = []
    for event_id in range(count):
        event_us = START_US + rng.randrange(span_sec * 1_000_000)
        lag = rng.choice([rng.randrange(60_000), rng.randrange(5_000_000), rng.randrange(max_lag_sec * 1_000_000)])
        if ahead and event_id % 37 == 0:
            lag = -rng.randrange(3_000_000)
        rows.append(
            {
                "event_id": event_id,
                "user_id": None if event_id % 23 == 0 else rng.randrange(20),
                "event_type": None if event_id % 19 == 0 else rng.choice(["page_view", "click", "purchase", "refund"]),
                "event_us": event_us,
                "receive_us": event_us + lag,
                "session_time": None if event_id % 29 == 0 else rng.choice([0.0, round(rng.expovariate(1 / 15), 2)]),
                "page_views": rng.randrange(0, 4),
                "clicks": rng.randrange(0, 5),
                "cart_value": rng.choice([0.0, -1.0, round(rng.lognormvariate(3.5, 1.2), 2)]),
            }
        )
    return rows


def frame(spark, rows):
    fields = EVENT_ROWS.fieldNames()
    return spark.createDataFrame([tuple(r[f] for f in fields) for r in rows], EVENT_ROWS)
