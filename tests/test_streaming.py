import json

from pyspark.sql import functions as F

from spanflow.plans.export import otlp_rows
from spanflow.plans.metrics import relay_summary
from spanflow.plans.partition import wrap_record
from spanflow.plans.reconcile import reconcile
from spanflow.sources.stream_records import read_partitioned
from spanflow.sources.log_batches import read_envelopes
from spanflow.streaming.partition import partition_stream
from spanflow.streaming.relay import late_records, late_summary, relay_stream, table_sink, work_dir
from tests.helpers import CLIENT, DECORATOR, TARGET, arrivals, changed

STREAM = "arrival_ts timestamp, arrival_seq string, event_id string, sequence_number string, value string"


def write_files(spark, rows, path, size, first=0):
    """Keyed records as files of ``size`` rows, oldest first."""
    frame = wrap_record(arrivals(spark, rows, first)).select(
        "arrival_ts", "arrival_seq", F.lit(None).cast("string").alias("event_id"),
        F.col("arrival_seq").alias("sequence_number"), "value",
    ).orderBy("arrival_seq").toPandas()
    for i, start in enumerate(range(0, len(frame), size)):
        part = spark.createDataFrame(frame[start : start + size], STREAM)
        part.coalesce(1).write.mode("append").parquet(f"{path}/part={i:03d}")


def source(spark, path):
    return (
        spark.readStream.schema(STREAM)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(path)
    )


def run(spark, path, out, checkpoint, delay="0 seconds", beats=None):
    query = relay_stream(
        read_partitioned(source(spark, path)), table_sink(out), checkpoint, delay=delay, heartbeats=beats
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def content(frame):
    columns = ["window_start", "source_event_id", "arrival_seq", "span_id_hex", F.to_json(F.struct("links", "attributes")).alias("j")]
    return sorted(map(tuple, frame.select(*columns).collect()))


def rows_of_two_minutes():
    rows = []
    for i in range(40):
        rows += [
            (i * 4, f"t{i % 30}", changed(TARGET, spanId=f"{i % 5:02x}", attributes={"k": 1})),
            (i * 4 + 1, f"d{i % 35}", changed(DECORATOR, _aws={"xray": {"decorator_type": "managed_link", "target_id": f"{i % 6:02x}"}})),
            (i * 4 + 2, f"c{i}", CLIENT),
        ]
    return rows + [(600, "last", CLIENT)]


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    rows = rows_of_two_minutes()
    path, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "check"))
    write_files(spark, rows[:70], path, 35)
    run(spark, path, out, checkpoint)
    write_files(spark, rows[70:], path + "/more", 30, first=70)
    run(spark, path, out, checkpoint)

    batch = arrivals(spark, rows)
    closed = F.col("window_start") < "2024-05-01 12:10:00"
    expected = otlp_rows(reconcile(batch)).where(closed)
    assert content(spark.read.parquet(f"{out}/spans")) == content(expected)
    size = F.octet_length(F.to_json("record")).cast("bigint")
    counters = relay_summary(batch, size).where(closed).orderBy("window_start")
    got = spark.read.parquet(f"{out}/summary").drop("batch_id").orderBy("window_start")
    assert got.select(counters.columns).collect() == counters.collect()


def test_the_newest_window_stays_open(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(spark, [(0, "a", CLIENT), (30, "b", CLIENT)], path, 1)
    run(spark, path, out, str(tmp_path / "check"))
    assert not (tmp_path / "out").exists()


def beats(spark, tmp_path):
    spark.sql("select timestamp'2100-01-01' as arrival_ts").write.parquet(str(tmp_path / "beats"))
    return spark.readStream.schema("arrival_ts timestamp").parquet(str(tmp_path / "beats"))


def test_a_heartbeat_closes_the_last_windows_and_payloads_are_written(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(spark, [(0, "a", CLIENT), (30, "b", CLIENT), (90, "c", CLIENT)], path, 5)
    run(spark, path, out, str(tmp_path / "check"), beats=beats(spark, tmp_path))
    assert sorted(r.source_event_id for r in spark.read.parquet(f"{out}/spans").collect()) == ["a", "b", "c"]
    payloads = spark.read.parquet(f"{out}/payloads").collect()
    assert sorted(r.spans for r in payloads) == [1, 2] and all(json.loads(r.payload) for r in payloads)


def test_records_of_a_slow_reader_are_kept_and_later_ones_counted(spark, tmp_path):
    # A close takes effect for late records one batch after it.
    rows = [(0, "a", CLIENT), (200, "b", CLIENT), (201, "b2", CLIENT), (10, "late", CLIENT), (900, "c", CLIENT), (901, "c2", CLIENT)]
    for delay, lost in (("5 minutes", 0), ("0 seconds", 1)):
        here = tmp_path / str(lost)
        path, out = str(here / "in"), str(here / "out")
        write_files(spark, rows, path, 1)
        query = run(spark, path, out, str(here / "check"), delay=delay)
        found = {r.source_event_id for r in spark.read.parquet(f"{out}/spans").collect()}
        assert ("late" in found) == (lost == 0) and late_records(query) == lost


def test_every_late_record_is_in_the_late_table(spark, tmp_path):
    # Two copies of a late event in one batch, a second window, more after a restart.
    rows = [(0, "a", CLIENT), (200, "b", CLIENT), (201, "b2", CLIENT), (202, "b3", CLIENT), (10, "late", CLIENT), (11, "late", CLIENT),
            (70, "late2", TARGET), (203, "on time", CLIENT), (900, "c", CLIENT), (901, "c2", CLIENT), (902, "c3", CLIENT), (903, "c4", CLIENT), (204, "late3", CLIENT), (2000, "open", CLIENT)]
    path, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "check"))
    write_files(spark, rows[:8], path, 2)
    run(spark, path, out, checkpoint)
    write_files(spark, rows[8:], path + "/more", 2, first=8)
    run(spark, path, out, checkpoint)
    late, spans = spark.read.parquet(f"{checkpoint}/late"), spark.read.parquet(f"{out}/spans")
    assert sorted(r.source_event_id for r in late.collect()) == ["late", "late", "late2", "late3"]
    assert sorted(r.source_event_id for r in spans.collect()) == ["a", "b", "b2", "b3", "c", "c2", "c3", "c4", "on time"]
    counts = late_summary(spark, f"{checkpoint}/late").orderBy("window_start").collect()
    assert [r.late_records for r in counts] == [2, 1, 1]


def test_logs_to_payloads_through_both_stages(spark, tmp_path):
    logs, keyed, out = (str(tmp_path / n) for n in ("logs", "keyed", "out"))
    events = [(f"e{i}", i, json.dumps(r)) for i, r in enumerate([CLIENT, TARGET, DECORATOR])]
    wire = "logGroup string, messageType string, logEvents array<struct<id:string,timestamp:bigint,message:string>>"
    spark.createDataFrame([("/logs/a", "DATA_MESSAGE", events), ("/logs/a", "DATA_MESSAGE", events[:1])], wire).coalesce(1).write.json(logs)
    stage = partition_stream(read_envelopes(spark, logs, streaming=True), keyed, str(tmp_path / "c1"))
    stage.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.input_records for r in spark.read.parquet(f"{keyed}/summary").collect()) == [1, 3]
    schema = spark.read.parquet(f"{keyed}/records").drop("batch_id").schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{keyed}/records")
    query = relay_stream(read_partitioned(stream), table_sink(out), str(tmp_path / "c2"), heartbeats=beats(spark, tmp_path))
    query.trigger(availableNow=True).start().awaitTermination()
    spans = spark.read.parquet(f"{out}/spans").orderBy("source_event_id").collect()
    assert [r.source_event_id for r in spans] == ["e0", "e1"] and len(spans[1].links) == 1
    assert sum(r.spans for r in spark.read.parquet(f"{out}/payloads").collect()) == 2


def test_log_stream_is_partitioned_and_quarantined(spark, tmp_path):
    logs, out = str(tmp_path / "logs"), str(tmp_path / "out")
    events = [("e0", 0, json.dumps(CLIENT)), ("e1", 1, "not-json"), ("e2", 2, json.dumps(TARGET))]
    schema = "log_group string, log_events array<struct<id:string,timestamp:bigint,message:string>>"
    spark.createDataFrame([("/logs/a", events)], schema).write.json(logs)
    query = partition_stream(read_envelopes(spark, logs, streaming=True), out, str(tmp_path / "check"))
    query.trigger(availableNow=True).start().awaitTermination()
    records = spark.read.parquet(f"{out}/records").orderBy("arrival_seq").collect()
    assert [json.loads(r.value)["source_event_id"] for r in records] == ["e0", "e2"]
    assert json.loads(records[0].value)["record"] == CLIENT
    assert [r.malformed for r in spark.read.parquet(f"{out}/quarantine").collect()] == ["bad_json"]
    assert spark.read.parquet(f"{out}/summary").first().malformed_records == 1


class Session:
    """Stands for a session of a cluster that names its shared folder, or does not."""

    def __init__(self, folder):
        self.conf = self
        self.folder = folder

    def get(self, name, default):
        return self.folder if name == "spark.checkpoint.dir" and self.folder else default


def test_shared_folder_is_read_from_the_session(tmp_path):
    assert work_dir(Session(str(tmp_path))).startswith(str(tmp_path))
    assert not work_dir(Session(None)).startswith(str(tmp_path))
