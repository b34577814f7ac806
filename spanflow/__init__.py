"""Span logs on Spark: partition, reconcile in tumbling windows, export as OTLP."""

from spanflow.functions.json import configure
from spanflow.plans.export import compact_payloads, conversion_errors, otlp_json, otlp_rows, write_otlp
from spanflow.plans.metrics import partition_summary, relay_summary, trace_aggregate
from spanflow.plans.partition import partition_batches, partition_records, subscription_scan, wrap_record
from spanflow.plans.publish import (
    dead_letters,
    publish_ledger,
    publish_summary,
    publish_with_retry,
    replay_dead_letters,
    write_dead_letters,
)
from spanflow.plans.reconcile import emission_order, reconcile, reconcile_unique
from spanflow.sources.log_batches import read_envelopes, read_log_batches
from spanflow.sources.stream_records import read_partitioned, union_streams, write_partitioned
from spanflow.streaming.partition import partition_stream
from spanflow.streaming.relay import configure_stream, relay_stream, table_sink

__all__ = [
    "compact_payloads", "configure", "configure_stream", "conversion_errors", "dead_letters",
    "emission_order", "otlp_json", "otlp_rows", "partition_batches", "partition_records",
    "partition_stream", "partition_summary", "publish_ledger", "publish_summary",
    "publish_with_retry", "read_envelopes", "read_log_batches", "read_partitioned", "reconcile",
    "reconcile_unique", "relay_stream", "relay_summary", "replay_dead_letters",
    "subscription_scan", "table_sink", "trace_aggregate", "union_streams", "wrap_record",
    "write_dead_letters", "write_otlp", "write_partitioned",
]
