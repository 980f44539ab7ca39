"""Canonical URLs keep the query: pages addressed by parameters do not resolve to each other."""

import random

from fluxmill.llm import revisits
from pyspark.sql import functions as F


def test_canonical_url(spark):
    pairs = [
        ("http://www.Example.org:80/item/?id=1#f", "example.org/item?id=1"),
        ("https://example.org/item?id=2", "example.org/item?id=2"),
        ("example.org/list?ref=x&page=2&UTM_source=a", "example.org/list?page=2&ref=x"),
        ("example.org/list?utm_source=a&ref=x", "example.org/list?ref=x"),
        ("example.org/list?&", "example.org/list"),
        ("example.org/s?b=2&a=9&b=1", "example.org/s?a=9&b=2&b=1"),
        ("example.org/thread?12345", "example.org/thread?12345"),
        ("example.org/go?u=http://x.org/?a=1", "example.org/go?u=http://x.org/?a=1"),
        ("m.example.org?id=1", "m.example.org?id=1"),
        ("example.org/a#f?id=1", "example.org/a"),
        (None, None),
    ]
    got = spark.createDataFrame(pairs, "url string, want string").select(revisits.canonical_url(F.col("url")), "want")
    for key, want in got.collect():
        assert key == want


def test_loose_url(spark):
    pairs = [
        ("http://www.m.Example.org/tree/?ref=main&page=2", "example.org/tree?page=2"),
        ("m.example.org/a?ref=x", "example.org/a"),
        ("mm.example.org?reference=1", "mm.example.org?reference=1"),
    ]
    got = spark.createDataFrame(pairs, "url string, want string").select(revisits.canonical_url(F.col("url"), True), "want")
    for key, want in got.collect():
        assert key == want


FIELDS = (
    "record_id long, url string, captured long, kind string, etag string, last_modified string, digest string, "
    "headers map<string,string>"
)


def test_a_doubtful_parameter_needs_a_validator(spark):
    rows = [
        (1, "example.org/tree?ref=main", 10, "response", '"1"', None, "d1", None),
        (2, "example.org/tree?ref=dev", 20, "response", '"2"', None, "d2", None),
        (3, "example.org/tree?ref=main", 30, "revisit", None, None, None, None),
        (4, "example.org/tree?ref=other", 30, "revisit", None, None, None, None),
        (5, "m.example.org/tree?ref=other", 30, "revisit", 'W/"2"', None, None, None),
        (6, "example.org/tree", 30, "revisit", '"1"', None, None, None),
        (7, "example.org/tree?ref=main", 31, "revisit", '"2"', None, None, None),
    ]
    for bucket in (100_000, 1):
        got = revisits.resolve_revisits(spark.createDataFrame(rows, FIELDS), bucket).collect()
        assert {r.record_id: (r.status, r.full_id) for r in got} == {
            3: ("unverified", 1),
            4: ("orphan", None),
            5: ("resolved", 2),
            6: ("orphan", None),  # the latest of the loose URL has another tag
            7: ("resolved", 2),
        }


def plain(rows):
    def latest(row, loose):
        def key(url):
            head, _, query = url.partition("?")
            parts = [p for p in query.split("&") if p and not (loose and p.startswith("ref="))]
            return (head.removeprefix("m.") if loose else head), tuple(sorted(parts))

        before = [r for r in rows if r[3] == "response" and key(r[1]) == key(row[1]) and r[2] < row[2]]
        return max(before, key=lambda r: (r[2], r[0]), default=None)

    def judge(row, full):
        if full is None:
            return "orphan"
        for i in (4, 5):
            if row[i] is not None and full[i] is not None:
                return "resolved" if row[i].removeprefix("W/") == full[i].removeprefix("W/") else "changed"
        return "unverified"

    out = []
    for row in rows:
        if row[3] != "revisit":
            continue
        full = latest(row, False)
        status = judge(row, full)
        if status in ("orphan", "changed"):
            other = latest(row, True)
            if judge(row, other) == "resolved":
                full, status = other, "resolved"
        usable = status in ("resolved", "unverified")
        if not usable:
            out.append((row[0], status, None, None, None))
            continue
        headers = {**(full[7] or {}), **{k: v for k, v in (row[7] or {}).items() if k in revisits.PERMITTED and v}}
        out.append((row[0], status, full[0], full[6], headers))
    return sorted(out, key=repr)


def test_random_records(spark):
    draw = random.Random(11)
    urls = ["a.org/x", "m.a.org/x", "a.org/x?ref=1", "a.org/x?ref=2&p=1", "a.org/x?p=1", "b.org", "b.org/?ref=z" + "z" * 5000]
    rows = []
    for i in range(900):
        kind = draw.choice(["response", "revisit"])
        headers = draw.choice([None, {"date": f"t{i}", "server": "s", "etag": draw.choice(["e", None])}, {"vary": "v"}])
        tag = draw.choice([None, '"1"', '"2"', 'W/"1"'])
        rows.append((i % 700, draw.choice(urls), draw.randrange(60), kind, tag, draw.choice([None, "m", "n"]), f"d{i}", headers))
    rows = list({(r[0], r[2]): r for r in rows}.values())  # a record is captured once
    clash = {"own": F.lit(1), "within": F.lit(2), "latest": F.lit("x"), "carried": F.lit(0), "bucket": F.lit(9), "full": F.lit(3)}
    table = spark.createDataFrame(rows, FIELDS).withColumns({**clash, "status": F.lit("?"), "loose_key": F.lit("!")})
    want = plain([(*r[:1], r[1].replace("org/?", "org?"), *r[2:]) for r in rows])
    for bucket in (100_000, 7, 1):
        got = revisits.resolve_revisits(table, bucket).collect()
        assert sorted(((r.record_id, r.status, r.full_id, r.digest, r.headers) for r in got), key=repr) == want


def test_other_query_is_another_resource(spark):
    fields = "record_id long, url string, captured long, kind string, etag string, last_modified string, digest string, headers map<string,string>"
    rows = [
        (1, "example.org/item?id=1", 10, "response", '"1"', None, "d1", None),
        (2, "example.org/item?id=2", 20, "response", '"2"', None, "d2", None),
        (3, "example.org/item?id=1&utm_source=a", 30, "revisit", '"1"', None, None, None),
        (4, "example.org/item?id=2#f", 31, "revisit", None, None, None, None),
        (5, "example.org/item?id=3", 32, "revisit", None, None, None, None),
        (6, "example.org/item", 33, "revisit", '"2"', None, None, None),
    ]
    table = spark.createDataFrame(rows, fields)
    for bucket in (100_000, 1):
        got = {r.record_id: (r.status, r.full_id, r.digest) for r in revisits.resolve_revisits(table, bucket).collect()}
        assert got == {
            3: ("resolved", 1, "d1"),
            4: ("unverified", 2, "d2"),
            5: ("orphan", None, None),
            6: ("orphan", None, None),
        }
