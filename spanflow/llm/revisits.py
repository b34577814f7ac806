"""Resolution of not-modified revisits in web archives.

A revisit record says that a server answered "not modified". It is resolved to the
latest earlier full response of the same canonical URL: an as-of join. The validators
that the revisit repeats must agree with the response's; then the response's headers
apply, updated by those of the revisit that a not-modified answer may change.

The as-of join is done in three levels of window functions over distinct times: within
a second of a URL, within a day over its seconds, and over the days of a URL. Records of
one URL and time are reduced to one row with partial results first, so a group has at
most 86,400 rows by second or day, and no more than the distinct times of one second
otherwise, whatever the traffic of a URL; no payload takes part. The answers are joined
back by URL and time; of such a join Spark splits keys that are too large.

Records with a null or empty URL or no time resolve to nothing. Times count to the
microsecond. Of responses of one URL and time the one with the greatest id counts; a
response at the very time of a revisit is not earlier. A revisit without validators is accepted; one whose validator
the response lacks is not. Repeated rows give repeated results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fields of a not-modified answer that must not replace stored ones, for
# they describe a body or a connection.
KEPT_FIELDS = [
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type",
    "keep-alive", "proxy-authenticate", "proxy-authentication-info", "proxy-connection", "set-cookie",
    "te", "trailer", "transfer-encoding", "upgrade",
]
# Query parameters that only track a visit.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and ``m.``, no scheme, user or default port; path
    without a trailing slash or ``index.html``; query without tracking parameters; no fragment."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(bare, "^(?i)[a-z][a-z0-9+.-]*://([^/?@]*@)?", "")
    host = F.lower(F.regexp_extract(bare, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^(www|m)\\.", "")
    path = F.regexp_extract(bare, "^[^/?]*([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, "/index\\.html?$", "/"), "/+$", "")
    query = F.regexp_extract(bare, "\\?(.*)$", 1)
    parts = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)"))
    rest = F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(parts), "&"))).otherwise("")
    return F.when(F.trim(url) != "", F.concat(host, path, rest))


def bare_tag(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(tag), "^W/", "")


def lowered(headers: Column) -> Column:
    """Field names in lower case; of names that then clash the last value stays."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(
        F.transform(entries, lambda e, i: F.struct(e.alias("e"), i.alias("i"))),
        lambda x: ~F.exists(F.slice(entries, x["i"] + 2, F.size(entries)), lambda later: later["key"] == x["e"]["key"]),
    )
    return F.map_from_entries(F.transform(last, lambda x: x["e"]))


def merged_headers(stored: Column, answer: Column) -> Column:
    """Stored headers, updated by the permitted ones of a not-modified answer."""
    kept = F.array(*map(F.lit, KEPT_FIELDS))
    updates = F.map_filter(answer, lambda k, _: ~F.array_contains(kept, k))
    return F.map_concat(F.map_filter(stored, lambda k, _: ~F.map_contains_key(updates, k)), updates)


def _as_of(asked: DataFrame, responses: DataFrame) -> DataFrame:
    """``url, at, found``: for each distinct URL and time asked, the id of the latest response before."""
    times = (
        responses.select("url", "at", "record_id", F.lit(False).alias("wanted"))
        .union(asked.select("url", "at", F.lit(None).cast("bigint"), F.lit(True)))
        .groupBy("url", "at").agg(F.max("record_id").alias("record_id"), F.max("wanted").alias("wanted"))
        .withColumns({"second": F.date_trunc("second", "at"), "day": F.date_trunc("day", "at")})
    )

    def carried(frame: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
        """The last value before each row of its keys, or null."""
        over = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return frame.withColumn(name, F.last(value, ignorenulls=True).over(over))

    # One row for each second, then for each day: its last response, and whether one is asked for.
    seconds = times.groupBy("url", "day", "second").agg(
        F.max_by("record_id", F.when(F.col("record_id").isNotNull(), F.col("at"))).alias("last"), F.max("wanted").alias("wanted")
    )
    days = seconds.groupBy("url", "day").agg(
        F.max_by("last", F.when(F.col("last").isNotNull(), F.col("second"))).alias("last"), F.max("wanted").alias("wanted")
    )
    by_time = carried(times, ["url", "second"], "at", "record_id", "same_second").where("wanted")
    by_second = carried(seconds, ["url", "day"], "second", "last", "same_day").where("wanted")
    by_day = carried(days, ["url"], "day", "last", "earlier").where("wanted")
    return (
        by_time.join(by_second.select("url", "second", "same_day"), ["url", "second"])
        .join(by_day.select("url", "day", "earlier"), ["url", "day"])
        .select("url", "at", F.coalesce("same_second", "same_day", "earlier").alias("found"))
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row for each revisit of ``records``: its ``record_id``, ``url`` (canonical),
    ``response_id``, ``status`` and merged ``headers``.

    ``records`` has ``record_id`` (unique), ``kind`` (``response`` or ``revisit``), ``url``,
    ``at`` and ``headers``, a map. Status is ``resolved``, ``no response`` or ``validators
    differ``; only the first has a response and headers.
    """
    rows = records.select(
        F.col("record_id").cast("bigint").alias("record_id"), "kind", canonical_url(F.col("url")).alias("url"),
        F.col("at").cast("timestamp").alias("at"),
        lowered(F.coalesce(F.col("headers"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))).alias("headers"),
    )
    revisits = rows.where("kind = 'revisit'")
    responses = rows.where("kind = 'response' and record_id is not null")
    dated = "url is not null and at is not null"
    answers = _as_of(revisits.where(dated).select("url", "at"), responses.where(dated))
    stored = responses.select(F.col("record_id").alias("found"), F.col("headers").alias("stored"))
    joined = revisits.join(answers, ["url", "at"], "left").join(stored, "found", "left")
    sent, kept = F.col("headers"), F.col("stored")

    def agrees(name: str, form=lambda c: c) -> Column:
        own = form(sent[name])
        return own.isNull() | F.coalesce(own == form(kept[name]), F.lit(False))

    valid = agrees("etag", bare_tag) & (sent["etag"].isNotNull() | agrees("last-modified", F.trim))
    status = F.when(F.col("found").isNull(), "no response").when(valid, "resolved").otherwise("validators differ")
    good = F.col("status") == "resolved"
    return joined.withColumn("status", status).select(
        "record_id", "url", F.when(good, F.col("found")).alias("response_id"), "status",
        F.when(good, merged_headers(kept, sent)).alias("headers"),
    )
