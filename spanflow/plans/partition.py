"""Log events to keyed span records, with a quarantine for what does not parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanflow.functions.json import json_quote, parse_message, with_document
from spanflow.functions.patterns import DEFAULT_PATTERN
from spanflow.functions.records import subscription_filter, trace_id_of_record

REASON_BAD_JSON = "bad_json"
REASON_NO_TRACE_ID = "no_trace_id"


def parse_log_events(events: DataFrame) -> DataFrame:
    """Add ``record``, ``trace_id`` and, for malformed messages, ``malformed``."""
    return (
        with_document(events, F.col("message"), "record")
        .withColumn("trace_id", trace_id_of_record(F.col("record")))
        .withColumn(
            "malformed",
            F.when(F.col("record").isNull(), REASON_BAD_JSON).when(
                F.col("trace_id").isNull(), REASON_NO_TRACE_ID
            ),
        )
    )


def subscription_scan(events: DataFrame, pattern: str = DEFAULT_PATTERN) -> DataFrame:
    """Only the log events whose message is JSON that the filter pattern lets through."""
    parsed = with_document(events, F.col("message"), "_record")
    return parsed.where(
        F.col("_record").isNotNull() & subscription_filter(F.col("_record"), pattern)
    ).drop("_record")


def good_records(parsed: DataFrame) -> DataFrame:
    """Records with a text trace id; the empty text passes."""
    return parsed.where(F.col("malformed").isNull()).drop("malformed")


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("malformed").isNotNull())


def partition_records(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Log events to (keyed records, quarantined events)."""
    parsed = parse_log_events(events)
    return good_records(parsed), quarantine(parsed)


def wrap_record(records: DataFrame) -> DataFrame:
    """Add ``value``, the JSON text that goes to the keyed stream.

    The message is put in as it came: printing the parsed value again would turn
    1.0 into 1. The key is the trace id.
    """
    parts = []
    for name in ["source_log_group", "source_event_id", "trace_id"]:
        parts += [F.lit(f',"{name}":'), json_quote(F.col(name))]
    parts[0] = F.lit('{"source_log_group":')
    value = F.concat(*parts, F.lit(',"record":'), F.col("message"), F.lit("}"))
    return records.withColumn("key", F.col("trace_id")).withColumn("value", value)


MAX_PUT_RECORDS = 500
DEAD_LETTER_CHUNK = 10
# Rows of one batch that are numbered together; larger batches are split.
POSITION_BUCKET = 65536


def partition_batches(envelopes: DataFrame, size: int = MAX_PUT_RECORDS) -> DataFrame:
    """Log envelopes to valid records numbered and chunked inside their envelope.

    Parsing and filtering happen inside the envelope's array, so the position
    after the explode is already the rank among valid records: no shuffle.
    """
    parsed = envelopes.withColumn(
        "_parsed",
        F.transform(
            "log_events",
            lambda e: F.struct(
                e["id"].alias("source_event_id"),
                e["message"].alias("message"),
                parse_message(e["message"]).alias("record"),
            ),
        ),
    )
    valid = F.filter("_parsed", lambda e: trace_id_of_record(e["record"]).isNotNull())
    return (
        parsed.select(
            *[c for c in envelopes.columns if c != "log_events"],
            F.posexplode(valid).alias("rank", "_event"),
        )
        .select("*", "_event.*")
        .drop("_event")
        .withColumn("trace_id", trace_id_of_record(F.col("record")))
        .withColumn("chunk_index", F.floor(F.col("rank") / size).cast("bigint"))
        .withColumn("position", (F.col("rank") % size).cast("bigint"))
        .drop("rank")
    )


def chunk_records(
    rows: DataFrame, batch: str, pos: str, size: int, bucket: int = POSITION_BUCKET
) -> DataFrame:
    """Number the rows of each batch in ``pos`` order and cut them into chunks.

    Rows are ranked inside slices of ``bucket`` positions; the counts of the
    slices before give the offset. However large a batch is, no task ranks more
    than one slice. ``pos`` is a whole number; gaps are fine.
    """
    sliced = rows.withColumn("_slice", F.floor(F.col(pos) / bucket).cast("bigint"))
    before = Window.partitionBy(batch).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        sliced.groupBy(batch, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    rank = F.row_number().over(Window.partitionBy(batch, "_slice").orderBy(pos))
    number = F.col("_offset") + F.col("_rank") - 1
    return (
        sliced.withColumn("_rank", rank)
        .join(offsets, [batch, "_slice"])
        .withColumn("chunk_index", F.floor(number / size).cast("bigint"))
        .withColumn("position", (number % size).cast("bigint"))
        .drop("_slice", "_rank", "_offset")
    )
