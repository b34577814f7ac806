"""What is shuffled, kept and read again on the way; rows are made here."""

import os
import re
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from checks import queries as q
from spanflow.functions import json
from spanflow.operators.staging import removed, written
from spanflow.plans import publish
from spanflow.sources import derived
from spanflow.streaming import lane, relay

LINEITEM = (
    "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double,"
    " l_extendedprice double, l_returnflag string, l_shipdate timestamp"
)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Line items of 600 orders: copies of rows, and rows without an order."""
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [
        (k if k % 97 else None, n, k * 7 + n, k * 3 + n, float(k % 50 + 1), 10.5 + k, "ANR"[k % 3], datetime(2024, 1, 1))
        for k in range(600) for n in range(1, 1 + k % 5)
    ]
    pq.write_table(spark.createDataFrame(rows + rows[:40], LINEITEM).toArrow(), f"{path}/lineitem.parquet")
    return path


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_texts_are_made_where_envelopes_are_packed(spark, tables):
    packed = derived.log_batches(q.configure(spark), tables)
    above, below = plan_of(packed).split("Exchange")
    assert "collect_list" in above and "not-json" in above
    assert "collect_list" not in below and "not-json" not in below
    found = sorted((str(r.batch_id), e.id, e.timestamp, e.message) for r in packed.collect() for e in r.log_events if e.message)
    made = derived.log_events(spark, tables).where("message is not null").collect()
    assert found == sorted((str(r.batch_id), r.source_event_id, r.arrival_s, r.message) for r in made)


@pytest.mark.parametrize("name", ["response_pairs", "request_failures", "record_balance"])
def test_records_are_made_once(spark, tables, name):
    """Frames that are joined with themselves are read off a table, not made of the texts once more."""
    frame = q.QUERIES[name](spark, tables)
    assert "lineitem.parquet" not in plan_of(frame) and frame.count()


@pytest.mark.parametrize("name", ["partition_metrics", "two_stage_spans", "stream_windows"])
def test_batches_of_streams_are_not_cached(spark, tables, monkeypatch, name):
    """Cached rows are plain on an executor's disk; what is read again is Parquet."""

    def refuse(frame, *_):
        raise AssertionError("cached")

    monkeypatch.setattr(DataFrame, "persist", refuse)
    assert q.QUERIES[name](spark, tables).count()


@pytest.mark.parametrize("name", ["retry_subset", "replayed_records"])
def test_requests_are_read_off_the_ledger(spark, tables, name):
    """The requests of a run are not made of the texts once more to meet its failures."""
    frame = q.QUERIES[name](spark, tables)
    assert "lineitem.parquet" not in plan_of(frame) and frame.count()


def test_replay_neither_caches_nor_joins_the_live_records(spark, tables, monkeypatch):
    def refuse(frame, *_):
        raise AssertionError("cached")

    sent = q.requests(spark, tables).groupBy("source_event_id", "trace_id").count().count()
    monkeypatch.setattr(DataFrame, "persist", refuse)
    monkeypatch.setattr(DataFrame, "join", lambda left, right, on, how="inner", join=DataFrame.join: (
        refuse(left) if on == q.publish.ROW else join(left, right, on, how)))
    found = q.replayed_once(spark, tables).collect()
    assert len(found) == sent and {r.copies for r in found} == {1}


def test_columns_of_live_records_stand_in_their_last_attempt(spark, tables):
    sent = q.requests(spark, tables)
    made = q.ledger(spark, tables, letters=True, live=["trace_id"])
    last = {(r.batch_id, r.chunk_index, r.position): r for r in q.publish.requests_of(made).collect()}
    rows = sent.select(*q.publish.ROW, "trace_id", "message").collect()
    assert len(rows) == len(last) > 0
    for r in rows:
        row = last[r.batch_id, r.chunk_index, r.position]
        assert row.trace_id == r.trace_id and row.message == (r.message if row.outcome == "dead" else None)
    assert {r.trace_id for r in made.where("outcome = 'retried'").collect()} == {None}
    assert q.publish.delivered(made).where("message is not null").count() == 0


def test_texts_travel_to_their_payload_once(spark, tables):
    texts = q.export.otlp_json(q.export.otlp_rows(q.spans(spark, tables)))
    plan = plan_of(q.export.compact_payloads(texts, 3, 700))
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*span_chunk", plan)) == 1
    assert re.search(r"Exchange hashpartitioning\([^)]*(resource|scope)[#,]", plan) is None


def test_stored_payloads_are_taken_apart_without_copies(spark, tables):
    found = q.stored_payloads(spark, tables)
    assert "array<variant>" not in found._jdf.queryExecution().analyzed().toString()
    rows = q.export.otlp_rows(q.spans(spark, tables)).select("trace_id_hex", "span_id_hex").collect()
    assert sorted((r.trace_id, r.span_id) for r in found.collect()) == sorted(tuple(r) for r in rows) != []


@pytest.mark.parametrize("name", ["emitted_spans_ordered", "emission_index", "otlp_convert_errors"])
def test_keys_of_spans_are_shuffled_without_records(spark, tables, name, monkeypatch):
    """Whether a span converts is found before the shuffle, which carries no record; all roles read one shuffle."""
    made = []
    monkeypatch.setattr(q.reconcile, "dedupe_events", lambda events, to=q.reconcile.dedupe_events: made.append(events) or to(events))
    assert q.QUERIES[name](spark, tables).count()
    assert made and not any("record" in events.columns for events in made)
    keys = q.span_keys(spark, tables)
    keys.collect()
    assert "ReusedExchange" in plan_of(keys) and plan_of(keys).split("Initial Plan")[0].count("FileScan parquet") == 1


def test_lane_is_dealt_and_counted_off_one_table(spark, tables, monkeypatch):
    """The events of a lane are not made once for the counts and once more for the buckets."""
    made = []
    monkeypatch.setattr(DataFrame, "join", lambda left, *rest, join=DataFrame.join, **more: made.append(plan_of(left)) or join(left, *rest, **more))
    assert q.lane_traces(spark, tables).count()
    assert made and not any("lineitem.parquet" in plan for plan in made)


def test_a_text_is_parsed_once(spark, tables):
    """What follows a document shows in the same parse, and texts without odd numbers skip the strict look."""
    plan = plan_of(q.record_roles(spark, tables))
    assert "get_json_object" not in plan and plan.count("parseJson") == 1 and "variant_explode" in plan


def test_documents_equal_those_of_parse_message(spark):
    texts = [
        '{"a":1}', '{"a":1} x', '{"a":1},{"b":2}', '{"a":1},2]', '{"a":1}]', '{"a":1}]x', "", " ", "null", None, "1", "1,2",
        '"a","b"]', "[1,2]", "[]", "]", "],[1", ' {"a":1}\n', '{"a":[{"b":{"c":{"d":1.0}}}]}', "-0", "[-0]", "1e400", "tru",
        '{"a":"\\ud800"}', '{"a":"\\ud83d\\ude00"}', "[" * 127 + "]" * 127, "[" * 128 + "]" * 128, '{"a":1,"a":2}', "9" * 310,
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "pos int, key string")
    once = json.with_document(rows, F.col("key"), "value").select("pos", "key", F.to_json("value").alias("now"))
    both = json.once(once, json.parse_message(F.col("key")), "was").withColumn("was", F.to_json("was")).orderBy("pos").collect()
    assert [r.key for r in both] == texts and [r.now for r in both] == [r.was for r in both]
    assert [r.now for r in both][:2] == ['{"a":1}', None] and both[24].now and both[25].now and not both[26].now


def test_kept_fields_give_the_same_links(spark, tables):
    """Records are cut down to their links before they are shuffled, stored or wait in the window state."""
    links = F.to_json(F.coalesce("merged_links", json.strict_array(F.col("record"), "$.links")))
    names = ["window_start", "trace_id", "is_target", "source_event_id", "arrival_seq"]
    whole, cut = (q.spans(spark, tables, keep=keep).select(*names, links.alias("links"), F.to_json("record").alias("r")) for keep in (None, ["links"]))
    assert sorted(map(repr, whole.drop("r").collect())) == sorted(map(repr, cut.drop("r").collect()))
    assert all(r.r.startswith('{"links":') for r in cut.collect()) and not all(r.r.startswith('{"links":') for r in whole.collect())


@pytest.mark.parametrize(("name", "kept"), [("stream_windows", []), ("two_stage_spans", []), ("stream_reconcile", ["links"])])
def test_the_window_state_holds_what_the_sink_needs(spark, tables, monkeypatch, name, kept):
    fields = []
    with_roles = relay.with_roles
    monkeypatch.setattr(relay, "with_roles", lambda records, keep=None: fields.append(keep) or with_roles(records, keep))
    assert q.QUERIES[name](spark, tables).count() and fields == [kept]


def test_stages_and_letters_are_small(spark, tables, tmp_path):
    frame = written(spark.range(10), f"{tmp_path}/stage")
    assert frame.count() == 10 and all("zstd" in f for f in frame.inputFiles())
    attempts = q.ledger(spark, tables, letters=True)
    letters = publish.dead_letters(attempts, None, "span-stream")
    publish.write_dead_letters(letters, f"{tmp_path}/letters")
    back = publish.read_dead_letters(spark, f"{tmp_path}/letters")
    assert back.count() == letters.count() and all(f.endswith(".gz") for f in back.inputFiles())


def test_the_ledger_goes_when_the_replay_has_read_it(spark, tables, monkeypatch):
    gone = []
    monkeypatch.setattr(q, "removed", lambda spark, path: gone.append(path) or removed(spark, path))
    assert q.replayed_once(spark, tables).count() and len(gone) == 1 and not os.path.exists(gone[0])


@pytest.mark.parametrize("last", [-1, 0, 8, 9, 10, 57, 99, 190, 999, 1009])
def test_folders_after_a_batch(spark, last, tmp_path):
    numbers = [*range(120), 189, 190, 191, 199, 200, 998, 999, 1000, 1008, 1009, 1010, 10090]
    for number in numbers:
        os.mkdir(f"{tmp_path}/batch_id={number}")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{tmp_path}/{lane.folders_after(last)}")
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    assert sorted(int(f.getPath().getName().split("=")[1]) for f in found) == [n for n in numbers if n > last]


def test_earlier_batches_use_up_no_trigger(spark, tmp_path):
    rows = spark.range(4000).select(F.col("id").cast("string").alias("key"), F.col("id").cast("string").alias("value"))
    for batch in range(3):
        rows.coalesce(1).write.option("maxRecordsPerFile", 1000).parquet(f"{tmp_path}/records/batch_id={batch}")
        spark.createDataFrame([(batch,)], "batch_id bigint").write.mode("append").parquet(f"{tmp_path}/summary")
        lane.start_after(spark, str(tmp_path), f"{tmp_path}/mark{min(batch, 1)}")
    stream = lane.lane_stream(spark, str(tmp_path), f"{tmp_path}/mark1", rate=4000, file_records=1000)
    sizes = []
    query = stream.writeStream.foreachBatch(lambda b, _: sizes.append((b.count(), b.rdd.getNumPartitions()))).option(
        "checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
    query.awaitTermination()
    # Eight files of earlier batches took two triggers; the four of the last one are dealt to all cores.
    assert sizes == [(4000, 4)]
