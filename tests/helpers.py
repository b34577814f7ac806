"""Span records of the kinds that the tests need, and frames made of them."""

import copy
import hashlib
import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from spanflow.functions.json import with_document

START = datetime(2024, 5, 1, 12, 0, tzinfo=timezone.utc)


def ident(name: str, digits: int) -> str:
    """A hex id that follows from a name."""
    return hashlib.md5(name.encode()).hexdigest()[:digits]


def span(name: str, kind: str, milliseconds: int, **fields) -> dict:
    """A completed span of the one trace, called and numbered by its name."""
    begin = int(START.timestamp()) * 10**9 + len(name)
    ids = {"spanId": ident(name, 16), "traceId": TRACE}
    times = {"endTimeUnixNano": begin + milliseconds * 10**6, "startTimeUnixNano": begin}
    return {"name": name, "kind": kind, **fields, **times, **ids}


TRACE = ident("trace", 32)
TARGET = span(
    "orders.receive", "CONSUMER", 730,
    _aws={"xray": {"linking": True}},
    attributes={"batch": 3, "late": False},
    resource={"attributes": {"service.name": "orders", "team": "north"}},
)
TARGET_SPAN = TARGET["spanId"]
DECORATOR = {
    "_aws": {"xray": {"decorator_type": "managed_link", "target_id": TARGET_SPAN}},
    "links": [{"spanId": ident("far span", 16), "traceId": ident("far trace", 32), "_aws": {"xray": {"reference_type": "parent"}}}],
    "spanId": ident("decorator", 16),
    "traceId": TRACE,
}
CLIENT = span(
    "stock.lookup", "CLIENT", 45,
    attributes={"cache.hit": True, "shelf": 17},
    flags=3,
    parentSpanId=TARGET_SPAN,
    resource={"attributes": {"service.name": "stock"}},
    scope={"name": "shelves", "version": "2.1"},
    status={"code": "OK", "message": "found"},
)


def changed(original: dict, /, **fields) -> dict:
    """A copy with fields replaced; a field set to ``...`` is removed."""
    result = copy.deepcopy(original)
    for name, value in fields.items():
        if value is ...:
            result.pop(name, None)
        else:
            result[name] = value
    return result


def documents(spark, *texts):
    """One row per text or record, with ``n``, ``message`` and ``record``."""
    rows = [
        (i, text if isinstance(text, str) else json.dumps(text)) for i, text in enumerate(texts)
    ]
    return with_document(
        spark.createDataFrame(rows, "n int, message string"), F.col("message"), "record"
    )


def arrivals(spark, rows, first=0):
    """Keyed records from ``(seconds, event id, record)``; order of rows is arrival order."""
    data = [
        (
            START + timedelta(seconds=seconds),
            f"{i:06d}",
            event_id,
            "aws/spans",
            record["traceId"],
            json.dumps(record),
        )
        for i, (seconds, event_id, record) in enumerate(rows, first)
    ]
    schema = (
        "arrival_ts timestamp, arrival_seq string, source_event_id string,"
        " source_log_group string, trace_id string, message string"
    )
    return with_document(spark.createDataFrame(data, schema), F.col("message"), "record")


def texts(rows):
    return [json.loads(r[0]) if r[0] is not None else None for r in rows]
