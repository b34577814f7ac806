"""Keyed stream records: decoding with fallbacks, and the keyed table sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanflow.functions.json import field, strict_str, with_document
from spanflow.functions.records import DEFAULT_LOG_GROUP, trace_id_of_record


def read_partitioned(stream: DataFrame) -> DataFrame:
    """Decode ``value`` (text or bytes) into keyed records.

    Rows also carry ``event_id`` and ``sequence_number`` of the stream. A payload
    that is not JSON or lacks one of the four fields is skipped; an empty event
    id, log group or trace id is filled in.
    """
    envelope = F.col("_envelope")
    decoded = with_document(stream, F.col("value").cast("string"), "_envelope").select(
        *[c for c in stream.columns if c != "value"],
        strict_str(envelope, "$.source_log_group").alias("source_log_group"),
        strict_str(envelope, "$.source_event_id").alias("source_event_id"),
        strict_str(envelope, "$.trace_id").alias("trace_id"),
        field(envelope, "$.record").alias("record"),
    )
    return fill_trace_id(fill_log_group(fill_event_id(drop_undecodable(decoded))))


def drop_undecodable(decoded: DataFrame) -> DataFrame:
    test = F.lit(True)
    for name in ["source_log_group", "source_event_id", "trace_id", "record"]:
        test &= F.col(name).isNotNull()
    return decoded.where(test)


def fill_event_id(decoded: DataFrame) -> DataFrame:
    """Empty event id: the stream's event id, else its sequence number."""
    event_id = F.col("source_event_id")
    return decoded.withColumn(
        "source_event_id",
        F.when(event_id == "", F.coalesce("event_id", "sequence_number")).otherwise(
            event_id
        ),
    )


def fill_log_group(decoded: DataFrame) -> DataFrame:
    """A null or empty log group becomes the default one."""
    group = F.coalesce(F.col("source_log_group"), F.lit(""))
    return decoded.withColumn(
        "source_log_group", F.when(group == "", DEFAULT_LOG_GROUP).otherwise(group)
    )


def fill_trace_id(decoded: DataFrame) -> DataFrame:
    """Null or empty trace id: the record's own; a record without one is skipped."""
    trace_id, own = F.col("trace_id"), trace_id_of_record(F.col("record"))
    return decoded.withColumn(
        "trace_id",
        F.when(trace_id == "", own).otherwise(F.coalesce(trace_id, own)),
    ).where(trace_id.isNotNull())


def write_partitioned(wrapped: DataFrame, path: str, mode: str = "append") -> None:
    """Write keyed records as Parquet, laid out by trace.

    A rebalance, unlike a plain repartition by key, lets adaptive execution cut
    a trace that outgrows a partition into several files.
    """
    wrapped.drop("record").hint("rebalance", "trace_id").write.mode(mode).parquet(path)


def write_kafka(wrapped: DataFrame, servers: str, topic: str) -> None:
    """Send keyed records to a Kafka topic; needs the Kafka package of Spark."""
    (
        wrapped.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def union_streams(live: DataFrame, replayed: DataFrame) -> DataFrame:
    """Replayed records join the live ones by column name."""
    return live.unionByName(replayed)
