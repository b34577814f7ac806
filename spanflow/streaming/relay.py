"""The stream: keyed records in, reconciled windows out when they close."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from spanflow.functions.json import configure
from spanflow.operators.linking import with_roles
from spanflow.operators.staging import removed, work_dir, written
from spanflow.operators.windows import ARRIVAL, WINDOW_LENGTH
from spanflow.plans.export import (
    compact_payloads,
    otlp_json,
    otlp_rows,
    with_convert_error,
    write_otlp,
)
from spanflow.plans.metrics import land_metrics, observe_relay, relay_totals, window_summary
from spanflow.plans.reconcile import reconcile_unique

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
# How far arrival clocks of parallel readers may differ before a record counts as late.
LATENESS = "5 minutes"


def configure_stream(spark: SparkSession) -> SparkSession:
    """Session options of ``configure``, and window state on disk, not on the heap.

    With changelogs a batch saves what it changed instead of the whole state.
    """
    spark.conf.set(PROVIDER, ROCKSDB)
    spark.conf.set(CHANGELOG, "true")
    return configure(spark)


def kafka_records(
    spark: SparkSession, servers: str, topic: str, rate: int | None = None
) -> DataFrame:
    """Keyed records of a Kafka topic from its end on, at most ``rate`` per trigger if given.

    Needs the Kafka package of Spark. Feed the result to ``read_partitioned``.
    """
    offset = F.format_string("%05d-%019d", F.col("partition"), F.col("offset"))
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
    )
    if rate:
        reader = reader.option("maxOffsetsPerTrigger", rate)
    return (
        reader.load()
        .select(
            "key",
            "value",
            F.lit(None).cast("string").alias("event_id"),
            offset.alias("sequence_number"),
            F.col("timestamp").alias("arrival_ts"),
            offset.alias("arrival_seq"),
        )
    )


def first_events(
    records: DataFrame, length: str = WINDOW_LENGTH, delay: str = LATENESS,
    heartbeats: DataFrame | None = None, size: Column | None = None, keep: list[str] | None = None,
) -> DataFrame:
    """First arrival of each event id per window, out when the window closes.

    State is one row per window and event id, so a trace or span that most
    records belong to is spread like all others. All events of a closed window
    come out in the same micro-batch. ``heartbeats``, a stream with ``arrival_ts``,
    moves time on where no records do, so that the last windows close as well.
    ``size`` is what a record counts in the window state, by default the bytes of its JSON.
    ``keep`` names the fields of a record that wait there, by default all.
    """
    if heartbeats is not None:
        beats = heartbeats.select("arrival_ts", F.lit(True).alias("heartbeat"))
        records = records.withColumn("heartbeat", F.lit(False)).unionByName(beats, allowMissingColumns=True)
    else:
        records = records.withColumn("heartbeat", F.lit(False))
    size = F.octet_length(F.to_json("record")) if size is None else size
    kept = [
        "trace_id", "source_log_group", "role", "link_span_id", "richness", "links",
        "record", "converts", "bytes", *ARRIVAL,
    ]
    prepared = with_roles(
        with_convert_error(records).withColumns(
            {
                "converts": F.col("convert_error").isNull(),
                "bytes": size.cast("bigint"),
            }
        ),
        keep,
    )
    return (
        prepared.withWatermark("arrival_ts", delay)
        .withColumn("arrived", F.when(~F.col("heartbeat"), F.struct(*ARRIVAL)))
        .groupBy(F.window("arrival_ts", length), "source_event_id")
        .agg(
            F.count("arrived").alias("copies"),
            F.min_by(F.struct(*kept), "arrived").alias("e"),
        )
        # A test of the heartbeat itself would move below the watermark and hide it.
        .where("copies > 0")
        .select(
            F.col("window.start").alias("window_start"), "source_event_id", "copies", "e.*"
        )
    )


def _milliseconds(spark: SparkSession, delay: str) -> int:
    return spark.sql(f"select unix_millis(timestamp'1970-01-01 00:00:00 UTC' + interval {delay})").first()[0]


class _Marks:
    """The newest arrival of each batch, in a file of its own, so that a repeated batch
    finds the marks of those before it again."""

    def __init__(self, spark: SparkSession, path: str, delay: str):
        self.spark, self.path, self.delay = spark, path, _milliseconds(spark, delay)

    def late_before(self, batch_id: int) -> int:
        """Milliseconds up to which windows had ended for the late rows of a batch. A batch
        raises the mark; the next one closes windows by it, and the one after drops what
        comes for them."""
        if batch_id < 2:
            return 0
        seen = self.spark.read.schema("newest bigint, batch_id bigint").parquet(self.path)
        newest = seen.where(F.col("batch_id") <= batch_id - 2).agg(F.max("newest")).first()[0]
        return 0 if newest is None else max(newest - self.delay, 0)

    def write(self, batch_id: int, newest: int | None) -> None:
        row = self.spark.createDataFrame([(newest,)], "newest bigint")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")


def relay_stream(
    records: DataFrame,
    on_close: Callable[[DataFrame, DataFrame, int], None],
    checkpoint: str,
    length: str = WINDOW_LENGTH,
    delay: str = LATENESS,
    heartbeats: DataFrame | None = None,
    late: str | None = None,
    decode: Callable[[DataFrame], DataFrame] | None = None,
    size: Column | None = None,
    metrics: str | None = None,
    keep: list[str] | None = None,
) -> DataStreamWriter:
    """Call ``on_close(spans, summary, batch_id)`` for the windows each batch closes.

    A batch that closes no window does not call it. A window closes ``delay`` after its
    end; records that come later still are written, one row each with their
    ``window_start``, to ``batch_id=...`` folders below ``late``, by default ``late`` in
    the checkpoint. ``late_summary`` counts them. After a failure the same batch id comes
    again with the same rows, so a sink that overwrites by batch id ends up right.

    With ``decode``, ``records`` are rows as they come, with ``arrival_ts``, and ``decode``
    makes keyed records of them. All rows pass beside the window state, which drops late
    ones unseen, and only late ones are decoded there, so a row is parsed once.
    ``metrics`` names a folder for the counters of each batch that closes windows. An
    ``on_close`` that needs a few fields of a record, or none, says so with ``keep``: the
    window state, what is written of a batch and the shuffles hold no more than these.
    """
    decode = decode or (lambda rows: rows)
    late = late or f"{checkpoint}/late"
    marks = _Marks(records.sparkSession, f"{checkpoint}/newest", delay)

    def close(batch: DataFrame, batch_id: int) -> None:
        mark, newest = marks.late_before(batch_id), Observation()
        # Three branches and the summary read the batch; without this each of
        # them would read the window state again. Parquet takes a fraction of what cached
        # rows would.
        stage = work_dir(batch.sparkSession)
        batch = written(batch.observe(newest, F.max(F.unix_millis("at")).alias("newest")).where(
            F.col("event").isNotNull() | (F.col("arrived").isNotNull() & (F.unix_millis(F.col("window.end")) <= mark))
        ), stage)
        try:
            found = batch.agg(F.count("event").alias("events"), F.count("arrived").alias("late")).first()
            if found.late:
                behind = decode(batch.where("event is null").select("arrived.*"))
                behind.withColumn("window_start", F.window("arrival_ts", length)["start"]).write.mode(
                    "overwrite"
                ).parquet(f"{late}/batch_id={batch_id}")
            if found.events:
                events = batch.where("event is not null").select("event.*")
                summary = window_summary(events)
                on_close(reconcile_unique(events), observe_relay(summary), batch_id)
                if metrics:
                    land_metrics(relay_totals(summary), metrics, "relay", batch_id)
            marks.write(batch_id, newest.get["newest"])
        finally:
            removed(batch.sparkSession, stage)

    events = first_events(decode(records), length, delay, heartbeats, size, keep)
    window = F.window("arrival_ts", length).alias("window")
    beside = records.select(window, F.col("arrival_ts").alias("at"), F.struct(*records.columns).alias("arrived"))
    if heartbeats is not None:
        beside = beside.unionByName(heartbeats.select(window, F.col("arrival_ts").alias("at")), allowMissingColumns=True)
    both = events.select(F.struct(*events.columns).alias("event")).unionByName(
        beside, allowMissingColumns=True
    )
    return (
        both.writeStream.outputMode("append")
        .foreachBatch(close)
        .option("checkpointLocation", checkpoint)
    )


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``window_start, events, state_bytes, is_final`` of the windows that are still open,
    as the window state of a stream has them after its last batch."""
    state = spark.read.format("statestore").option("operatorId", 0).load(checkpoint)
    # The one aggregate that is a struct holds the first arrival.
    first = next(f.name for f in state.schema["value"].dataType if "bytes" in getattr(f.dataType, "names", ()))
    rows = state.select(F.col("key")[state.schema["key"].dataType[0].name]["start"].alias("window_start"), F.col("value")[first]["bytes"].alias("bytes"))
    return rows.where("bytes is not null").groupBy("window_start").agg(
        F.count(F.lit(1)).alias("events"), F.sum("bytes").alias("state_bytes"), F.lit(False).alias("is_final")
    )


def late_summary(spark: SparkSession, late: str) -> DataFrame:
    """``window_start, late_records``: the rows of a late table, counted."""
    rows = spark.read.parquet(late)
    return rows.groupBy("window_start").agg(F.count(F.lit(1)).alias("late_records"))


def table_sink(path: str) -> Callable[[DataFrame, DataFrame, int], None]:
    """Write OTLP rows, payloads, window counters and the counters of what was emitted
    below ``path``, one folder per batch."""

    def write(spans: DataFrame, summary: DataFrame, batch_id: int) -> None:
        rows, items = f"{path}/spans/batch_id={batch_id}", Observation()
        counted = otlp_rows(spans).observe(items, F.count(F.lit(1)).alias("telemetry_items_count"))
        counted.write.mode("overwrite").parquet(rows)
        written = spans.sparkSession.read.parquet(rows)
        traces = written.select("window_start", "trace_id").distinct().agg(F.count(F.lit(1)).alias("emitted_trace_ids_count"))
        land_metrics(traces.withColumn("telemetry_items_count", F.lit(items.get["telemetry_items_count"])), f"{path}/metrics", "emit", batch_id)
        write_otlp(
            compact_payloads(otlp_json(written)), f"{path}/payloads/batch_id={batch_id}", "overwrite"
        )
        summary.write.mode("overwrite").parquet(f"{path}/summary/batch_id={batch_id}")

    return write


def late_records(query: StreamingQuery) -> int:
    """Rows dropped late as recent progress has them, copies of an event in a task once.
    ``late_summary`` of the late table has every record."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
