"""Reconciled spans to OTLP rows, OTLP/JSON text and compact payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanflow.functions import otlp
from spanflow.functions.json import fields, json_quote, once, strict_array
from spanflow.operators.ranking import ID, in_order, with_sum_before
from spanflow.operators.staging import work_dir, written

CONTENT_TYPE = "application/json"
CARRIED = [
    "window_start", "trace_id", "is_target", "link_span_id", "source_event_id",
    "arrival_ts", "arrival_seq",
]


def with_raw_fields(spans: DataFrame) -> DataFrame:
    """Add ``raw``, the scalar fields of the record."""
    read = spans.withColumn("_read", fields(F.col("record"), otlp.RAW))
    raw = F.struct(*[column.alias(name) for name, column in otlp.raw_fields(F.col("_read")).items()])
    return once(read, raw, "raw").drop("_read")


def with_convert_error(spans: DataFrame) -> DataFrame:
    """Add ``convert_error``; null for spans that convert."""
    error = otlp.convert_error(F.col("raw"))
    return with_raw_fields(spans).withColumn("convert_error", error).drop("raw")


def checked(spans: DataFrame) -> DataFrame:
    """Spans with ``convert_error``, which those of ``reconcile`` without records bring along."""
    return spans if "convert_error" in spans.columns else with_convert_error(spans)


def convertible(spans: DataFrame) -> DataFrame:
    return checked(spans).where(F.col("convert_error").isNull()).drop("convert_error")


def conversion_errors(spans: DataFrame) -> DataFrame:
    return checked(spans).where(F.col("convert_error").isNotNull())


def span_links(record: Column, merged_links: Column) -> Column:
    """Merged links where a decorator matched, the record's own ones elsewhere."""
    return otlp.convert_links(
        F.coalesce(merged_links, strict_array(record, "$.links"))
    )


def otlp_rows(spans: DataFrame) -> DataFrame:
    """One row per span that converts; the others are in ``conversion_errors``."""
    record = F.col("record")
    columns = {
        **otlp.span_scalars(F.col("raw")),
        "resource_attributes": otlp.resource_attributes(record),
        "attributes": otlp.convert_attributes(record, "$.attributes"),
        "events": otlp.convert_events(record),
        "links": span_links(record, F.col("merged_links")),
    }
    found = with_raw_fields(spans).where(otlp.convert_error(F.col("raw")).isNull())
    return found.select(
        *CARRIED,
        F.col("source_log_group").alias("source"),
        *[column.alias(name) for name, column in columns.items()],
    )


def span_json() -> Column:
    """OTLP/JSON text of the span in an ``otlp_rows`` row."""

    def joined(name: str, element) -> Column:
        return F.concat(
            F.lit(f',"{name}":['), F.array_join(F.transform(name, element), ","), F.lit("]")
        )

    def id_field(name: str, column: str) -> Column:
        return F.concat(F.lit(f'"{name}":"'), F.col(column), F.lit('",'))

    return F.concat(
        F.lit("{"),
        id_field("traceId", "trace_id_hex"),
        id_field("spanId", "span_id_hex"),
        id_field("parentSpanId", "parent_span_id_hex"),
        F.lit('"flags":'), F.col("flags").cast("string"),
        F.lit(',"name":'), json_quote(F.col("name")),
        F.lit(',"kind":'), F.col("kind").cast("string"),
        F.lit(',"startTimeUnixNano":"'), F.col("start_time_unix_nano").cast("string"),
        F.lit('","endTimeUnixNano":"'), F.col("end_time_unix_nano").cast("string"),
        F.lit('","attributes":'), otlp.attributes_json(F.col("attributes")),
        joined("events", otlp.event_json),
        joined("links", otlp.link_json),
        F.lit(',"status":{"code":'), F.col("status_code").cast("string"),
        F.lit(',"message":'), json_quote(F.col("status_message")), F.lit("}}"),
    )


def resource_json() -> Column:
    return F.concat(
        F.lit('{"attributes":'), otlp.attributes_json(F.col("resource_attributes")), F.lit("}")
    )


def scope_json() -> Column:
    return F.concat(
        F.lit('{"name":'), json_quote(F.col("scope_name")),
        F.lit(',"version":'), json_quote(F.col("scope_version")), F.lit("}"),
    )


def otlp_json(rows: DataFrame) -> DataFrame:
    """Add the three texts a payload is made of."""
    return rows.select(
        "window_start", "trace_id", "is_target", "link_span_id", "source", "arrival_ts", "arrival_seq",
        "source_event_id",
        resource_json().alias("resource"),
        scope_json().alias("scope"),
        span_json().alias("span"),
    )


def single_payloads(texts: DataFrame, *keep: str) -> DataFrame:
    """One payload per span, tagged with its source and content type."""
    payload = F.concat(
        F.lit('{"resourceSpans":[{"resource":'), F.col("resource"),
        F.lit(',"scopeSpans":[{"scope":'), F.col("scope"),
        F.lit(',"spans":['), F.col("span"), F.lit("]}]}]}"),
    )
    return texts.select("window_start", "source", *keep, *_payload_columns(payload))


def _payload_columns(payload: Column) -> list[Column]:
    return [
        payload.alias("payload"),
        F.lit(CONTENT_TYPE).alias("content_type"),
        F.lit(None).cast("string").alias("content_encoding"),
    ]


MAX_PAYLOAD_SPANS = 512
MAX_PAYLOAD_BYTES = 1 << 20


def payload_cuts(
    texts: DataFrame, max_spans: int = MAX_PAYLOAD_SPANS, max_bytes: int = MAX_PAYLOAD_BYTES, size: Column | None = None
) -> DataFrame:
    """``texts`` with their ``_ordered_id``, ``byte_chunk`` and ``span_chunk``.

    Spans of a window and source stand in emission order. A span belongs to the byte chunk
    in whose ``max_bytes`` its first byte lies, so a chunk goes over that by less than its
    last span; inside it every ``max_spans`` spans make a span chunk. Only keys and sizes
    are ordered and summed, by ranges, so a window and source of any size is spread; the
    texts, written once, join when the chunks are known. ``size`` of a span is by default
    the bytes of its text.
    """
    group = ["window_start", "source"]
    size = F.octet_length("span") if size is None else size
    numbered = texts.withColumns({"bytes": size.cast("bigint"), "_text": F.monotonically_increasing_id()})
    stored = written(numbered, work_dir(texts.sparkSession))
    target = F.when(F.col("is_target"), F.col("link_span_id"))
    keys = stored.select(*group, "trace_id", "is_target", target.alias("target"), "arrival_ts", "arrival_seq", "source_event_id", "bytes", "_text")
    order = [F.col(c) for c in keys.columns[:-2]]
    summed = with_sum_before(in_order(keys, order), group, "bytes", "before")
    chunked = summed.withColumn("byte_chunk", F.floor(F.col("before") / max_bytes))
    # A byte chunk is bounded, so its spans may be ranked together.
    rank = F.row_number().over(Window.partitionBy(*group, "byte_chunk").orderBy(ID))
    chunked = chunked.withColumn("span_chunk", F.floor((rank - 1) / max_spans))
    return stored.join(chunked.select("_text", ID, "byte_chunk", "span_chunk"), "_text").drop("_text")


def compact_payloads(
    texts: DataFrame, max_spans: int = MAX_PAYLOAD_SPANS, max_bytes: int = MAX_PAYLOAD_BYTES, size: Column | None = None
) -> DataFrame:
    """Spans of a window and source packed into payloads, cut as ``payload_cuts`` says.

    Inside a payload spans stand under their resource and scope, in emission order, and
    ``byte_chunk, span_chunk`` order the payloads of a window and source the same way.
    """
    chunk = ["window_start", "source", "byte_chunk", "span_chunk"]
    # Spans travel to their payload once; scopes, resources and payloads are all packed there.
    numbered = payload_cuts(texts, max_spans, max_bytes, size).repartition(*chunk)
    spans = F.sort_array(F.collect_list(F.struct(ID, "span")))

    def texts_of(column: str, name: str) -> Column:
        return F.array_join(F.sort_array(F.collect_list(column)), ",").alias(name)

    scopes = (
        numbered.groupBy(*chunk, "resource", "scope")
        .agg(
            F.count(F.lit(1)).alias("spans"),
            F.sum("bytes").alias("bytes"),
            F.concat(
                F.lit('{"scope":'), F.col("scope"), F.lit(',"spans":['),
                F.array_join(F.transform(spans, lambda s: s["span"]), ","), F.lit("]}"),
            ).alias("scope_spans"),
        )
    )
    resources = (
        scopes.groupBy(*chunk, "resource")
        .agg(F.sum("spans").alias("spans"), F.sum("bytes").alias("bytes"), texts_of("scope_spans", "scope_spans"))
        .withColumn(
            "resource_spans",
            F.concat(
                F.lit('{"resource":'), F.col("resource"),
                F.lit(',"scopeSpans":['), F.col("scope_spans"), F.lit("]}"),
            ),
        )
    )
    return (
        resources.groupBy(*chunk)
        .agg(F.sum("spans").alias("spans"), F.sum("bytes").alias("bytes"), texts_of("resource_spans", "resource_spans"))
        .select(
            *chunk, "spans", "bytes",
            *_payload_columns(
                F.concat(F.lit('{"resourceSpans":['), F.col("resource_spans"), F.lit("]}"))
            ),
        )
    )


def write_otlp(payloads: DataFrame, path: str, mode: str = "append") -> None:
    """Payload rows as gzip Parquet; a frame without rows adds no payload."""
    payloads.write.mode(mode).option("compression", "gzip").parquet(path)
