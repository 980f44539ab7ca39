"""Not-modified revisits of a web archive, resolved to the latest earlier full response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fluxmill.workspace import stored

# Headers that a not-modified answer may bring up to date; all others stay the full response's.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
# Query parameters that say where a visitor came from and never which resource is meant.
TRACKING = r"^(utm_.*|gclid|dclid|fbclid|msclkid|yclid|mc_cid|mc_eid)$"
# Those that mean a resource on some sites: only a validator tells.
DOUBTFUL = r"^(utm_.*|ref|gclid|dclid|fbclid|msclkid|yclid|mc_cid|mc_eid)$"
BUCKET = 100_000


def _without(query: Column, names: str) -> Column:
    """Parameters by name, those of one name in their own order; those of the given names and empty ones go."""
    name = lambda part: F.regexp_extract(part, r"(?s)^([^=]*)", 1)
    parts = F.filter(F.split(query, "&"), lambda part: (part != "") & ~F.lower(name(part)).rlike(names))
    placed = F.transform(parts, lambda part, i: F.struct(name(part).alias("name"), i.alias("i"), part.alias("part")))
    return F.array_join(F.transform(F.array_sort(placed), lambda p: p["part"]), "&")


def canonical_url(url: Column, loose: bool = False) -> Column:
    """Host in lower case without scheme, www and standard port; path without last slash; query; no fragment.

    The query tells resources apart and stays, its parameters by name; only those of TRACKING go.
    Parameters without a value stay too. Names and values are compared as written, without decoding.
    `loose` also takes away what may mean another resource: the host's m. and the parameters of DOUBTFUL.
    """
    bare = F.regexp_replace(F.trim(url), r"(?i)^[a-z][a-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, r"(?s)#.*$", "")
    query = _without(F.regexp_extract(bare, r"(?s)^[^?]*\?(.*)$", 1), DOUBTFUL if loose else TRACKING)
    bare = F.regexp_replace(bare, r"(?s)\?.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^(www\.)?(m\.)?" if loose else r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"(?s)^[^/]*(.*)$", 1), r"/+$", "")
    return F.concat(host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _opaque(etag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(etag), r"^[Ww]/", "")


def _latest_before(rows: DataFrame, key: str, bucket: int) -> DataFrame:
    """The revisits among rows, with `full`: the latest response of the same key before each, null without any.

    Of several at one instant the one with the greatest record_id. The time line of a key is cut in
    buckets, so that a key with a large share of all records is no single task: within a bucket by a
    window, across buckets by a window over one row each.
    """
    rows = rows.withColumn("bucket", F.floor(F.col("captured") / bucket))
    by_bucket = rows.where("kind = 'response'").groupBy(key, "bucket").agg(F.max("own").alias("latest"))
    places = rows.select(key, "bucket").distinct().join(by_bucket, [key, "bucket"], "left")
    earlier = Window.partitionBy(key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = places.select(key, "bucket", F.last("latest", ignorenulls=True).over(earlier).alias("carried"))
    # Only strictly earlier captures count: the range ends one tick before the revisit.
    within = Window.partitionBy(key, "bucket").orderBy("captured").rangeBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("within", F.max("own").over(within))
        .where("kind = 'revisit'")
        .join(carried, [key, "bucket"])
        .withColumn("full", F.coalesce("within", "carried"))
        .drop("within", "carried", "bucket")
    )


def _status() -> Column:
    """What the validators of a revisit and of `full` say."""
    tags = F.col("etag").isNotNull() & F.col("full.etag").isNotNull()
    dates = F.col("last_modified").isNotNull() & F.col("full.last_modified").isNotNull()
    return (
        F.when(F.col("full").isNull(), "orphan")
        .when(tags, F.when(_opaque(F.col("etag")) == _opaque(F.col("full.etag")), "resolved").otherwise("changed"))
        .when(dates, F.when(F.col("last_modified") == F.col("full.last_modified"), "resolved").otherwise("changed"))
        .otherwise("unverified")
    )


def resolve_revisits(records: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row per not-modified record: record_id, url_key, status, full_id, digest, headers.

    records: record_id long, url string, captured long (any clock), kind 'response' or 'revisit',
    etag, last_modified, digest strings, headers map of strings with lower-case names.

    The latest response of the same canonical URL (query included) captured before the revisit is taken (of several
    at one instant the one with the greatest record_id). status says
      resolved    the entity tags agree (weak comparison), or, where one is missing, the dates do
      unverified  neither side has a validator in common
      changed     the validators differ
      orphan      there is no earlier response
    Where that gives changed or orphan, the latest earlier response of the loose URL (see canonical_url)
    is taken instead if its validators agree: then the revisit is resolved.
    A resolved or unverified revisit has the response's id, digest and headers, the permitted ones
    brought up to date from the revisit; else the three are null, so that no wrong payload is used.
    Rows with a null url, time or kind, and kinds of another name, are left out. Repeated revisits
    each keep their row; other columns are not looked at. Records of one URL and one bucket of time
    are sorted in one task; `bucket` is chosen so that these are few.
    """
    rows = records.select(
        F.col("record_id").cast("long").alias("record_id"),
        canonical_url(F.col("url")).alias("url_key"),
        canonical_url(F.col("url"), loose=True).alias("loose_key"),
        F.col("captured").cast("long").alias("captured"),
        "kind",
        "etag",
        "last_modified",
        "digest",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
    ).where("url_key is not null and captured is not null and kind in ('response', 'revisit')")
    response = F.when(
        F.col("kind") == "response",
        F.struct(
            "captured",
            "record_id",
            "etag",
            "last_modified",
            "digest",
            F.map_entries("headers").alias("headers"),
        ),
    )
    rows = rows.withColumn("own", response)
    first = stored(_latest_before(rows, "url_key", bucket).withColumn("status", _status()).drop("own", "kind"), "revisits")
    settled = first.where("status in ('resolved', 'unverified')")
    # Few are left; they look once more, among the responses of all URLs of the loose kind.
    others = first.where("status not in ('resolved', 'unverified')").drop("full")
    others = others.withColumns({"kind": F.lit("revisit"), "own": F.lit(None).cast(rows.schema["own"].dataType)})
    responses = rows.where("kind = 'response'").withColumn("status", F.lit(None).cast("string"))
    second = _latest_before(responses.unionByName(others), "loose_key", bucket)
    second = second.withColumn("status", F.when(_status() == "resolved", "resolved").otherwise(F.col("status")))
    found = settled.unionByName(second.select(*settled.columns))
    permitted = F.array(*map(F.lit, PERMITTED))
    fresh = F.map_filter("headers", lambda name, value: F.array_contains(permitted, name) & value.isNotNull())
    stale = F.filter("full.headers", lambda e: ~F.array_contains(F.map_keys("fresh"), e["key"]))
    usable = F.col("status").isin("resolved", "unverified")
    return found.withColumn("fresh", fresh).select(
        "record_id",
        "url_key",
        "status",
        F.when(usable, F.col("full.record_id")).alias("full_id"),
        F.when(usable, F.col("full.digest")).alias("digest"),
        F.when(usable, F.map_concat(F.map_from_entries(stale), "fresh")).alias("headers"),
    )


def capture_log(pages: DataFrame) -> DataFrame:
    """Records for resolve_revisits from rows (page_id, url, html): a response for each page and up to two revisits.

    The revisits come under another spelling of the URL, some before the response, some with
    another or no entity tag.
    """
    rows = pages.where("page_id is not null and url is not null").select(
        "page_id", "url", F.md5(F.coalesce("html", F.lit("")).cast("binary")).alias("digest")
    )
    page = F.col("page_id")
    kind = F.explode(F.sequence(F.lit(0), (page % 3).cast("int"))).alias("n")
    rows = rows.select("*", kind)
    n = F.col("n")
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 8), F.lit('"'))
    day = F.concat(F.lit("day "), (page % 28).cast("string"))
    early = (n > 0) & (page % 7 == 0)
    return rows.select(
        (page * 4 + n).alias("record_id"),
        F.when(n == 0, F.col("url")).otherwise(F.concat("url", F.lit("#again"))).alias("url"),
        F.when(early, page * 10 - n).otherwise(page * 10 + n).alias("captured"),
        F.when(n == 0, "response").otherwise("revisit").alias("kind"),
        F.when((n > 0) & (page % 5 == 0), '"other"')
        .when((n > 0) & (page % 11 == 0), F.lit(None))
        .when(n == 2, F.concat(F.lit("W/"), tag))
        .otherwise(tag)
        .alias("etag"),
        F.when((n > 0) & (page % 22 == 0), F.lit(None)).otherwise(day).alias("last_modified"),
        F.when(n == 0, F.col("digest")).alias("digest"),
        F.map_from_arrays(
            F.array(F.lit("content-type"), F.lit("date"), F.lit("server")),
            F.array(
                F.when(n == 0, "text/html").otherwise("text/plain"),
                F.concat(F.lit("t"), (page * 10 + n).cast("string")),
                F.concat(F.lit("s"), n.cast("string")),
            ),
        ).alias("headers"),
    )
