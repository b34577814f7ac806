import json
import sys

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import queries
from spanflow.plans import metrics, partition, publish
from spanflow.sources import log_batches, stream_records
from tests.helpers import CLIENT, TARGET, TRACE, changed

GROUP = "/logs/test-group"
ENVELOPE = "batch_id bigint, log_group string, log_events array<struct<id:string,timestamp:bigint,message:string>>"


def envelope(spark, messages, batch_id=0):
    texts = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    events = [(f"event-{i}", i, text) for i, text in enumerate(texts)]
    return spark.createDataFrame([(batch_id, GROUP, events)], ENVELOPE)


def requests(spark, messages):
    return partition.partition_batches(envelope(spark, messages)).withColumnRenamed(
        "log_group", "source_log_group"
    )


def test_envelope_files_round_trip(spark, tmp_path):
    path = str(tmp_path / "logs")
    envelope(spark, [CLIENT, "x"]).drop("batch_id").write.json(path)
    rows = log_batches.read_log_batches(log_batches.read_envelopes(spark, path)).collect()
    assert [(r.pos, r.source_event_id, r.source_log_group) for r in rows] == [
        (0, "event-0", GROUP), (1, "event-1", GROUP),
    ]


def test_malformed_records_go_to_quarantine(spark):
    messages = ["not-json", CLIENT, changed(CLIENT, traceId=...), changed(CLIENT, traceId=7), changed(CLIENT, traceId="")]
    events = log_batches.read_log_batches(envelope(spark, messages))
    good, bad = partition.partition_records(events)
    assert [r.source_event_id for r in good.collect()] == ["event-1", "event-4"]
    assert {r.source_event_id: r.malformed for r in bad.collect()} == {
        "event-0": "bad_json", "event-2": "no_trace_id", "event-3": "no_trace_id",
    }
    (counters,) = metrics.partition_summary(partition.parse_log_events(events), "batch_id").collect()
    assert (counters.input_records, counters.published_records, counters.malformed_records, counters.batches) == (5, 2, 3, 1)


def test_chunks_of_five_hundred(spark):
    messages = [CLIENT] * 300 + ["bad"] * 5 + [CLIENT] * 201
    found = requests(spark, messages).groupBy("chunk_index").count().orderBy("chunk_index").collect()
    assert [(r.chunk_index, r["count"]) for r in found] == [(0, 500), (1, 1)]


@pytest.mark.parametrize("bucket", [3, 7, 1000])
def test_chunking_over_slices_equals_plain_numbering(spark, bucket):
    rows = [(b, p) for b, step in ((1, 1), (2, 3), (3, 10)) for p in range(0, 100, step)]
    frame = partition.chunk_records(spark.createDataFrame(rows, "b int, p int"), "b", "p", 7, bucket)
    got = {(r.b, r.p): (r.chunk_index, r.position) for r in frame.collect()}
    expected = {}
    for b in (1, 2, 3):
        for i, p in enumerate(sorted(p for b2, p in rows if b2 == b)):
            expected[(b, p)] = (i // 7, i % 7)
    assert got == expected


def test_wrap_and_decode(spark):
    wrapped = partition.wrap_record(requests(spark, [changed(CLIENT, ratio=1.0), TARGET]))
    rows = wrapped.orderBy("position").collect()
    assert all(r.key == TRACE for r in rows)
    assert '"ratio": 1.0' in rows[0].value and json.loads(rows[1].value)["record"] == TARGET
    stream = wrapped.select("value", F.lit("k").alias("event_id"), F.lit("s").alias("sequence_number"))
    back = stream_records.read_partitioned(stream).collect()
    assert {(r.source_event_id, r.source_log_group, r.trace_id) for r in back} == {
        ("event-0", GROUP, TRACE), ("event-1", GROUP, TRACE),
    }


def test_decoding_fallbacks(spark):
    def wrapped(**fields):
        base = {"source_log_group": "", "source_event_id": "", "trace_id": "", "record": CLIENT}
        return json.dumps(changed(base, **fields))

    rows = [
        (wrapped(), "k1", "s1"), (wrapped(), None, "s2"), (wrapped(record={"traceId": 5}), "k3", "s3"),
        (wrapped(record=...), "k4", "s4"), (wrapped(trace_id=7), "k5", "s5"), ("broken", "k6", "s6"),
        (wrapped(trace_id="t", record=None), "k7", "s7"),
    ]
    frame = spark.createDataFrame(rows, "value string, event_id string, sequence_number string")
    found = sorted((r.source_event_id, r.source_log_group, r.trace_id) for r in stream_records.read_partitioned(frame).collect())
    assert found == [("k1", "aws/spans", TRACE), ("k7", "aws/spans", "t"), ("s2", "aws/spans", TRACE)]


def test_keyed_table(spark, tmp_path):
    path = str(tmp_path / "keyed")
    stream_records.write_partitioned(partition.wrap_record(requests(spark, [CLIENT, TARGET])), path)
    assert spark.read.parquet(path).count() == 2


def scripted(script):
    """A put that answers each (attempt, event id) from a script; no entry is success."""

    def put(chunk: pd.DataFrame, attempt: int) -> pd.DataFrame:
        entry = script.get(attempt)
        if isinstance(entry, str):
            raise type(entry, (Exception,), {})("down")
        codes = [(entry or {}).get(e) for e in chunk["source_event_id"]]
        return pd.DataFrame({"error_code": codes, "error_message": [c and f"m:{c}" for c in codes]})

    return put


THROTTLED = "ProvisionedThroughputExceededException"


def run(spark, messages, script, **options):
    sent = requests(spark, messages)
    ledger = publish.publish_with_retry(sent, scripted(script), **options)
    return sent, ledger, publish.publish_summary(ledger).first()


def calls(ledger):
    rows = ledger.orderBy("chunk_index", "attempt", "position").collect()
    result = {}
    for r in rows:
        result.setdefault((r.chunk_index, r.attempt), []).append(r.source_event_id)
    return list(result.values())


def test_only_the_failed_subset_is_retried(spark):
    sent, ledger, counters = run(spark, [CLIENT, TARGET, CLIENT], {1: {"event-1": THROTTLED}})
    assert calls(ledger) == [["event-0", "event-1", "event-2"], ["event-1"]]
    assert (counters.published_records, counters.retried_records, counters.recovered_on_retry) == (3, 1, 1)
    assert (counters.sent_to_failure_queue, counters.publish_attempts) == (0, 2)
    assert [r.source_event_id for r in publish.failed_subset_join(sent, ledger, 1).collect()] == ["event-1"]
    (delay,) = publish.retry_delays(ledger).collect()
    assert delay.base_ms == 200 and 0 <= delay.jitter_ms < 100


def test_terminal_failures_become_replayable_dead_letters(spark, tmp_path):
    sent, ledger, counters = run(spark, [CLIENT, TARGET], {1: {"event-0": "AccessDeniedException"}})
    assert (counters.published_records, counters.sent_to_failure_queue) == (1, 1)
    letters = publish.dead_letters(ledger, sent, "test-stream")
    (letter,) = letters.collect()
    assert (letter.kind, letter.stream_name, letter.source_event_id) == ("kinesis_publish_failure", "test-stream", "event-0")
    assert (letter.attempt_count, letter.last_error_code, letter.last_error_message) == (
        1, "AccessDeniedException", "m:AccessDeniedException",
    )
    path = str(tmp_path / "letters")
    publish.write_dead_letters(letters, path)
    (replayed,) = publish.replay_dead_letters(publish.read_dead_letters(spark, path)).collect()
    assert (replayed.trace_id, replayed.source_log_group) == (TRACE, GROUP)
    assert json.loads(replayed.message) == CLIENT
    (line,) = publish.read_dead_letters(spark, path).collect()
    assert json.loads(line.value)["record"] == CLIENT and json.loads(line.value)["attempt_count"] == 1


def test_dead_letters_are_sent_in_groups_and_failures_counted(spark):
    sent, ledger, _ = run(spark, [CLIENT] * 25, {1: {f"event-{i}": "Denied" for i in range(25)}})
    letters = publish.chunk_failures(publish.dead_letters(ledger, sent, "s"))

    def send(values):
        if any('"event-3"' in v for v in values):
            raise OSError("down")
        return sum('"event-20"' in v for v in values)

    results = publish.send_dead_letters(letters, send)
    assert [(r.sent, r.failed) for r in results.orderBy("send_index").collect()] == [(0, 10), (10, 0), (4, 1)]
    with pytest.raises(RuntimeError, match="11 of 25"):
        publish.require_sent(results)
    assert publish.require_sent(publish.send_dead_letters(letters, len_of_none)) == 25


def len_of_none(values):
    return 0


def test_waits_have_the_backoff_and_a_steady_jitter(spark, tmp_path):
    log = str(tmp_path / "waits")

    def pause(seconds, log=log):
        with open(log, "a") as file:
            file.write(f"{seconds}\n")

    run(spark, [CLIENT], {a: {"event-0": THROTTLED} for a in (1, 2, 3)}, pause=pause)
    with open(log) as file:
        waits = [float(line) for line in file]
    assert 0.2 <= waits[0] < 0.3 and abs(waits[1] - waits[0] - 0.2) < 1e-9


def test_a_failed_dead_letter_write_stops_the_job(spark, tmp_path):
    sent, ledger, _ = run(spark, [CLIENT], {1: {"event-0": "AccessDeniedException"}})
    blocked = tmp_path / "file"
    blocked.write_text("in the way")
    with pytest.raises(Exception):
        publish.write_dead_letters(publish.dead_letters(ledger, sent, "s"), str(blocked / "below"))


def test_a_raised_request_fails_all_its_rows_and_is_retried(spark):
    _, ledger, counters = run(spark, [CLIENT, CLIENT], {1: "ServiceUnavailable"})
    assert calls(ledger) == [["event-0", "event-1"]] * 2
    assert (counters.publish_attempts, counters.recovered_on_retry, counters.published_records) == (2, 2, 2)


def test_attempts_run_out(spark):
    _, ledger, counters = run(spark, [CLIENT], {a: {"event-0": THROTTLED} for a in (1, 2, 3)})
    assert (counters.publish_attempts, counters.sent_to_failure_queue, counters.recovered_on_retry) == (3, 1, 0)


def test_no_retry_without_time(spark):
    _, ledger, counters = run(spark, [CLIENT], {1: {"event-0": THROTTLED}}, budget_ms=lambda: 4999)
    assert (counters.publish_attempts, counters.retried_records, counters.sent_to_failure_queue) == (1, 0, 1)


def test_wrong_number_of_answers_is_retried(spark):
    def put(chunk, attempt):
        size = len(chunk) - (attempt == 1)
        return pd.DataFrame({"error_code": [None] * size, "error_message": [None] * size})

    ledger = publish.publish_with_retry(requests(spark, [CLIENT, CLIENT]), put)
    first = ledger.where("attempt = 1").first()
    assert first.error_code == "UnexpectedResponseRecordCount"
    assert publish.publish_summary(ledger).first().recovered_on_retry == 2


def test_several_chunks_with_mixed_outcomes(spark):
    _, ledger, counters = run(spark, [CLIENT] * 501, {1: {"event-499": THROTTLED}})
    sizes = [len(c) for c in calls(ledger)]
    assert sizes == [500, 1, 1] and calls(ledger)[1] == ["event-499"] and calls(ledger)[2] == ["event-500"]
    assert counters.published_records == 501


def test_scripted_ledger_equals_the_run(spark):
    script = {
        1: {"event-0": THROTTLED, "event-1": THROTTLED, "event-2": "AccessDeniedException"},
        2: {"event-1": THROTTLED}, 3: {"event-1": THROTTLED},
    }
    _, ran, _ = run(spark, [CLIENT] * 4, script)
    rows = [
        (0, 0, i, f"event-{i}", a, script[a].get(f"event-{i}"), "m:" + script[a].get(f"event-{i}", "") if script[a].get(f"event-{i}") else None, 60000)
        for i in range(4) for a in (1, 2, 3)
    ]
    outcomes = spark.createDataFrame(
        rows,
        "batch_id bigint, chunk_index bigint, position bigint, source_event_id string, attempt int,"
        " error_code string, error_message string, budget_ms bigint"
    )
    told = publish.publish_ledger(outcomes)
    key = ["position", "attempt"]
    assert told.select(ran.columns).orderBy(*key).collect() == ran.orderBy(*key).collect()
    assert sorted(r[0] for r in publish.recovered_ids(told).collect()) == ["event-0"]


def test_dead_letters_go_out_in_tens(spark):
    sent, ledger, _ = run(spark, [CLIENT] * 25, {1: {f"event-{i}": "Denied" for i in range(25)}})
    letters = publish.chunk_failures(publish.dead_letters(ledger, sent, "s"))
    sizes = letters.groupBy("send_index").count().orderBy("send_index").collect()
    assert [r["count"] for r in sizes] == [10, 10, 5]


def test_observed_metrics(spark):
    from pyspark.sql import Observation

    seen = Observation("partition")
    parsed = partition.parse_log_events(log_batches.read_log_batches(envelope(spark, [CLIENT, "x"])))
    assert metrics.observe_partition(parsed, seen).count() == 2
    assert seen.get == {"input_records": 2, "published_records": 1, "malformed_records": 1}


def test_chunks_cost_few_python_calls_per_record():
    """The ledger of a batch is put together once, not chunk by chunk and attempt by attempt."""

    class Requests:
        columns = [*publish.ROW, "source_event_id"]

        def select(self, *names):
            return self

        def mapInPandas(self, function, schema):
            return function

    n, calls = 4000, 0
    rows = pd.DataFrame({
        "batch_id": 7, "chunk_index": [i // 500 for i in range(n)], "position": [i % 500 for i in range(n)],
        "source_event_id": [f"e-{i // 4}-{i % 4 + 1}-0" for i in range(n)],
    })
    publish_all = publish.publish_with_retry(Requests(), queries.put, columns=[], together=True)

    def count(*_):
        nonlocal calls
        calls += 1

    # A chunk goes on in the next batch.
    parts = [rows[:1250], rows[1250:].reset_index(drop=True)]
    list(publish_all(iter(parts)))
    sys.setprofile(count)
    try:
        found = pd.concat(publish_all(iter(parts)), ignore_index=True)
    finally:
        sys.setprofile(None)
    assert calls < 80 * n  # 41; 180 when frames were made for every attempt
    cases = [(i // 4 + i % 4 + 1) % 20 for i in range(n)]
    expected = {"published": n - sum(c in (1, 2, 3) for c in cases), "dead": sum(c in (1, 2, 3) for c in cases),
                "retried": sum({0: 1, 1: 2}.get(c, 0) for c in cases)}
    assert found["outcome"].value_counts().to_dict() == expected
    last = found[found["outcome"] != "retried"].sort_values(["chunk_index", "position"])
    assert last["source_event_id"].tolist() == rows["source_event_id"].tolist()
