"""Plain Python versions of the window report and the summary, for small inputs."""

from collections import Counter, defaultdict
from fractions import Fraction

SECOND = 1_000_000


def floor_rank(values, percent):
    ordered = sorted(values)
    return ordered[max(1, len(ordered) * percent // 100) - 1]


def late(event, window_sec, max_lag_sec):
    bucket = event["event_us"] // (window_sec * SECOND)
    now_bucket = event["receive_us"] // (window_sec * SECOND)
    return bucket < now_bucket - 1 and event["receive_us"] - event["event_us"] > max_lag_sec * SECOND


def windows(events, window_sec, max_lag_sec):
    groups = defaultdict(lambda: {"good": [], "late": 0})
    for event in events:
        start = event["event_us"] // (window_sec * SECOND) * window_sec
        if late(event, window_sec, max_lag_sec):
            groups[start]["late"] += 1
        else:
            groups[start]["good"].append(event)
    report = {}
    for start, group in groups.items():
        good = group["good"]
        lags = [e["receive_us"] - e["event_us"] for e in good]
        sessions = [Fraction(str(e["session_time"])) for e in good if e["session_time"]]
        views = sum(e["page_views"] for e in good)
        clicks = sum(e["clicks"] for e in good)
        report[start] = {
            "message_count": len(good),
            "late_count": group["late"],
            "unique_users": len({e["user_id"] for e in good}),
            "event_counts": dict(Counter(e["event_type"] or "unknown" for e in good)),
            "total_cart_value": round(float(sum(Fraction(str(e["cart_value"])) for e in good if e["cart_value"] > 0)), 2),
            "avg_session_time": round(float(sum(sessions) / len(sessions)), 3) if sessions else 0.0,
            "click_through_rate": round(clicks / views, 4) if views > 0 else 0.0,
            "latency_p50_ms": floor_rank(lags, 50) / 1000 if lags else 0.0,
            "latency_p95_ms": floor_rank(lags, 95) / 1000 if lags else 0.0,
            "latency_p99_ms": floor_rank(lags, 99) / 1000 if lags else 0.0,
            "latency_max_ms": max(lags) / 1000 if lags else 0.0,
        }
    return report
