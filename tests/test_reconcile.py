import json
import random

from pyspark.sql import functions as F

from spanflow.operators import linking
from spanflow.operators.windows import dedupe_counts, dedupe_events, tumbling_window
from spanflow.plans.export import compact_payloads, conversion_errors, otlp_json, otlp_rows, single_payloads
from spanflow.plans.metrics import relay_summary
from spanflow.plans.reconcile import emission_order, reconcile
from tests.helpers import CLIENT, DECORATOR, TARGET, TARGET_SPAN, TRACE, arrivals, changed, documents

OTHER = "a" * 32


def emitted(spark, rows):
    return otlp_rows(reconcile(arrivals(spark, rows))).collect()


def summary(spark, rows):
    frame = relay_summary(arrivals(spark, rows), F.octet_length("message").cast("bigint"))
    return [r.asDict() for r in frame.orderBy("window_start").collect()]


def test_links_reach_the_target(spark):
    (row,) = emitted(spark, [(0, "e1", TARGET), (1, "e2", DECORATOR)])
    assert row.span_id_hex == TARGET_SPAN
    (link,) = row.links
    assert link.trace_id_hex == DECORATOR["links"][0]["traceId"]
    assert link.attributes[-1].key == "aws.xray.reference_type"
    assert json.loads(link.attributes[-1].value) == {"stringValue": "parent"}


def test_a_decorator_that_comes_first_still_links(spark):
    (row,) = emitted(spark, [(0, "e2", DECORATOR), (30, "e1", TARGET)])
    assert len(row.links) == 1


def test_duplicate_event_ids_are_dropped_across_traces(spark):
    rows = [(0, "e1", CLIENT), (1, "e1", changed(CLIENT, traceId=OTHER)), (70, "e1", CLIENT)]
    assert len(emitted(spark, rows)) == 2
    assert [s["deduped_source_events"] for s in summary(spark, rows)] == [1, 0]
    counts = dedupe_counts(tumbling_window(arrivals(spark, rows))).orderBy("window_start").collect()
    assert [(c.records, c.distinct_events, c.deduped_events) for c in counts] == [(2, 1, 1), (1, 1, 0)]


def test_traces_stay_apart(spark):
    other = changed(DECORATOR, traceId=OTHER)
    rows = [(0, "e1", TARGET), (1, "e2", other), (2, "e3", changed(CLIENT, traceId=OTHER))]
    found = emitted(spark, rows)
    assert len(found) == 2 and all(not r.links for r in found)
    (counters,) = summary(spark, rows)
    assert counters["aggregated_traces"] == 2
    assert counters["late_decorators_dropped"] == 1


def test_decorator_in_a_later_window_is_late(spark):
    rows = [(0, "e1", TARGET), (61, "e2", DECORATOR), (62, "e3", DECORATOR)]
    (row,) = emitted(spark, rows)
    assert row.links == []
    assert [(s["emitted_spans"], s["late_decorators_dropped"]) for s in summary(spark, rows)] == [(1, 0), (0, 2)]


def test_unmatched_target_keeps_its_links_as_they_are(spark):
    own = [{"traceId": "bb", "spanId": "02"}, {"traceId": "aa", "spanId": "01"}, {"traceId": "bb", "spanId": "02"}]
    target = changed(TARGET, links=own)
    (row,) = emitted(spark, [(0, "e1", target)])
    assert [link.trace_id_hex for link in row.links] == ["bb", "aa", "bb"]
    (row,) = emitted(spark, [(0, "e1", target), (1, "e2", changed(DECORATOR, links="none"))])
    assert [link.trace_id_hex for link in row.links] == ["aa", "bb"]


def test_the_richer_target_wins_and_a_tie_keeps_the_first(spark):
    poor, rich = changed(TARGET, name="poor", attributes={}), changed(TARGET, name="rich")
    tie = changed(TARGET, name="tie")
    assert [r.name for r in emitted(spark, [(0, "a", poor), (1, "b", rich), (2, "c", tie)])] == ["rich"]


def test_ordinary_spans_are_not_merged_by_span_id(spark):
    assert len(emitted(spark, [(0, "a", CLIENT), (1, "b", CLIENT)])) == 2


def test_skipped_records_still_count_their_trace(spark):
    rows = [(0, "a", changed(CLIENT, endTimeUnixNano=None)), (1, "b", changed(CLIENT, traceId=OTHER, endTimeUnixNano=None))]
    (counters,) = summary(spark, rows)
    assert (counters["aggregated_traces"], counters["emitted_spans"], counters["emitted_trace_ids"]) == (2, 0, 0)


def test_empty_trace_id_is_kept_and_counted(spark):
    (counters,) = summary(spark, [(0, "a", changed(CLIENT, traceId=""))])
    assert (counters["emitted_spans"], counters["empty_trace_id"]) == (1, 1)


def test_emission_order(spark):
    rows = [
        (3, "t2", changed(TARGET, spanId="02")), (2, "t1", changed(TARGET, spanId="01")),
        (1, "c1", CLIENT), (5, "c2", CLIENT), (4, "x", changed(CLIENT, traceId="00")),
    ]
    frame = reconcile(arrivals(spark, rows)).orderBy(*emission_order())
    assert [r.source_event_id for r in frame.collect()] == ["x", "c1", "c2", "t1", "t2"]


def test_order_of_rows_and_partitions_does_not_matter(spark):
    rows = []
    for i in range(60):
        rows += [
            (i, f"t{i}", changed(TARGET, spanId=f"{i % 7:02x}", name=f"n{i}", attributes={"k": i})),
            (i, f"d{i % 50}", changed(DECORATOR, _aws={"xray": {"decorator_type": "managed_link", "target_id": f"{i % 9:02x}"}},
                                      links=[{"traceId": "aa", "spanId": f"{i % 5:02x}", "flags": i}])),
            (i, f"c{i % 40}", CLIENT),
        ]
    frame = arrivals(spark, rows)

    def result(f):
        columns = ["source_event_id", "arrival_seq", "name", F.to_json(F.struct("links")).alias("l")]
        return sorted(map(tuple, otlp_rows(reconcile(f)).select(*columns).collect()))

    first = result(frame)
    assert first and result(frame.repartition(5, F.rand(1))) == first


def test_popular_target_gets_every_distinct_link(spark):
    rows = [(0, "t", TARGET)] + [
        (1, f"d{i}", changed(DECORATOR, links=[{"traceId": "aa", "spanId": f"{i % 30:04x}", "flags": i}])) for i in range(300)
    ]
    random.Random(3).shuffle(rows)
    rows = sorted(rows, key=lambda r: r[0])
    (row,) = emitted(spark, rows)
    first = {}
    for _, event_id, record in rows[1:]:
        link = record["links"][0]
        first.setdefault(link["spanId"], link["flags"])
    assert [(e.span_id_hex, e.flags) for e in row.links] == sorted(first.items())


def test_conversion_errors_are_kept_apart(spark):
    bad = [
        changed(CLIENT, endTimeUnixNano="1"), changed(CLIENT, endTimeUnixNano=-5), changed(CLIENT, endTimeUnixNano=1.0),
        changed(CLIENT, spanId="zz"), changed(CLIENT, parentSpanId="123"), changed(CLIENT, traceId="x!"),
    ]
    rows = [(i, f"e{i}", r) for i, r in enumerate([*bad, CLIENT])]
    spans = reconcile(arrivals(spark, rows))
    errors = {r.source_event_id: r.convert_error for r in conversion_errors(spans).collect()}
    assert errors == {
        "e0": "end_time", "e1": "end_time", "e2": "end_time", "e3": "span_id", "e4": "parent_span_id", "e5": "trace_id",
    }
    assert [r.source_event_id for r in otlp_rows(spans).collect()] == ["e6"]


def test_span_fields(spark):
    (row,) = emitted(spark, [(0, "a", CLIENT)])
    assert (row.kind, row.status_code, row.status_message, row.flags) == (3, 1, "found", 3)
    assert (row.scope_name, row.scope_version, row.parent_span_id_hex) == ("shelves", "2.1", TARGET_SPAN)
    assert int(row.end_time_unix_nano) == CLIENT["endTimeUnixNano"]
    (row,) = emitted(spark, [(0, "a", {"traceId": TRACE, "endTimeUnixNano": 2**64 - 1})])
    assert int(row.end_time_unix_nano) == 2**64 - 1 and int(row.start_time_unix_nano) == 0
    assert (row.name, row.span_id_hex, row.scope_name, row.events, row.links) == ("UnnamedSpan", "", "", [], [])


def test_span_name_falls_back(spark):
    (row,) = emitted(spark, [(0, "a", changed(CLIENT, name="", _aws={"xray": {"name": "other"}}))])
    assert row.name == "other"


def test_service_name_is_projected_only_when_the_key_is_missing(spark):
    attributes = {"aws.local.service": "local", "service.name": "own"}
    cases = [({}, attributes), ({"service.name": None}, attributes), ({}, {"aws.local.service": 5, "service.name": "own"}), ({}, {})]
    rows = [
        (i, f"e{i}", changed(CLIENT, resource={"attributes": r}, attributes=a)) for i, (r, a) in enumerate(cases)
    ]
    found = {r.source_event_id: {a.key: a.value for a in r.resource_attributes} for r in emitted(spark, rows)}
    assert found["e0"] == {"service.name": '{"stringValue":"local"}'}
    assert found["e1"] == {"service.name": '{"stringValue":"null"}'}
    assert found["e2"] == {"service.name": '{"stringValue":"own"}'}
    assert found["e3"] == {}


def test_events_and_links_skip_bad_elements(spark):
    record = changed(
        CLIENT,
        events=["x", {"timeUnixNano": -1, "name": 5}, {"timeUnixNano": 9, "name": "n", "attributes": {"k": 1}}],
        links=[{"traceId": "aa", "spanId": "zz"}, {"traceId": "0xAA", "spanId": "0b", "flags": 2**32 + 1}, 3],
    )
    (row,) = emitted(spark, [(0, "a", record)])
    assert [(int(e.time_unix_nano), e.name, len(e.attributes)) for e in row.events] == [(0, "", 0), (9, "n", 1)]
    assert [(e.trace_id_hex, e.span_id_hex, e.flags) for e in row.links] == [("aa", "0b", 1)]


def payload_spans(payload):
    document = json.loads(payload)
    return [
        (resource["resource"], scope["scope"], span)
        for resource in document["resourceSpans"] for scope in resource["scopeSpans"] for span in scope["spans"]
    ]


def test_payloads_hold_every_span_once(spark):
    rows = [
        (i % 100, f"e{i}", changed(CLIENT, spanId=f"{i:016x}", resource={"attributes": {"service.name": f"s{i % 3}"}}))
        for i in range(120)
    ]
    text = otlp_json(otlp_rows(reconcile(arrivals(spark, rows))))
    singles = [payload_spans(r.payload)[0][2]["spanId"] for r in single_payloads(text).collect()]
    assert sorted(singles) == sorted(f"{i:016x}" for i in range(120))
    sizes = {r.source_event_id: len(r.span.encode()) for r in text.collect()}
    largest, total = max(sizes.values()), sum(sizes.values())
    for most_spans, most_bytes in ((16, 1 << 20), (1000, 2000), (4, 2000), (1000, 1)):
        packed = compact_payloads(text, most_spans, most_bytes).collect()
        spans = [s for r in packed for s in payload_spans(r.payload)]
        assert sorted(s[2]["spanId"] for s in spans) == sorted(singles) and sum(r.bytes for r in packed) == total
        assert all(r.spans == len(payload_spans(r.payload)) <= most_spans and r.bytes < most_bytes + largest for r in packed)
        assert len(packed) <= total // most_bytes + 120 // most_spans + 4
        assert all(s[0]["attributes"][0]["key"] == "service.name" for s in spans)
    whole = compact_payloads(text).collect()
    assert len(whole) == 2 and {len(json.loads(r.payload)["resourceSpans"]) for r in whole} == {3}


def test_first_arrival_is_kept(spark):
    frame = tumbling_window(arrivals(spark, [(5, "e", changed(CLIENT, name="late")), (1, "e", changed(CLIENT, name="early"))]))
    (row,) = dedupe_events(frame).collect()
    assert row.arrival_seq == "000001"


def test_the_deduplicated_events_are_shuffled_once(spark):
    frame = reconcile(arrivals(spark, [(0, "e1", TARGET), (1, "e2", DECORATOR), (2, "e3", CLIENT)]))
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 2
    # Each map task cuts its rows to one per key before either shuffle.
    assert "arrival_seq" in final and final.count("row_number(), 1, Partial") == 2


def test_roles_drop_what_is_not_needed(spark):
    rows = arrivals(spark, [(0, "a", changed(CLIENT, endTimeUnixNano=None)), (1, "b", DECORATOR), (2, "c", TARGET)])
    found = {r.source_event_id: r for r in linking.with_roles(rows).collect()}
    assert found["a"].record is None and found["b"].record is None and found["c"].record is not None
    assert found["b"].links is not None and found["c"].richness == 4
    assert documents(spark, TARGET).count() == 1


def test_payloads_depend_on_their_window_alone(spark):
    rows = [(i % 50, f"e{i}", changed(CLIENT, spanId=f"{i:016x}")) for i in range(70)]
    others = [(600 + i % 50, f"o{i}", changed(CLIENT, spanId=f"{i:016x}")) for i in range(400)]

    def payloads(data):
        text = otlp_json(otlp_rows(reconcile(arrivals(spark, data))))
        return sorted(r.payload for r in compact_payloads(text, max_spans=16).where("window_start < '2024-05-01 12:05:00'").collect())

    assert payloads(rows) == payloads(rows + others) and len(payloads(rows)) == 5


def test_payload_spans_stand_in_emission_order(spark):
    rows = [(i, f"e{i}", changed(TARGET if i % 3 == 0 else CLIENT, spanId=f"{40 - i:016x}")) for i in range(30)]
    (packed,) = compact_payloads(otlp_json(otlp_rows(reconcile(arrivals(spark, rows))))).collect()
    spans = [s[2]["spanId"] for s in payload_spans(packed.payload)]
    targets = [f"{40 - i:016x}" for i in range(30) if i % 3 == 0]
    assert [s for s in spans if s in targets] == sorted(targets)
    assert [s for s in spans if s not in targets] == [f"{40 - i:016x}" for i in range(30) if i % 3]


def test_no_record_is_lost_where_keys_are_null(spark):
    from spanflow.plans.metrics import record_balance
    from spanflow.plans.reconcile import unplaced

    frame = arrivals(spark, [(0, "a", CLIENT), (1, "b", TARGET), (1, "b", TARGET), (2, "c", DECORATOR), (3, "d", changed(CLIENT, endTimeUnixNano="x")), (70, "e", CLIENT)])
    none = F.lit(None).cast("string")
    bare = frame.withColumns({"source_log_group": none, "trace_id": none})
    assert reconcile(bare).count() == reconcile(frame).count() == 4
    assert {r.source_log_group for r in reconcile(bare).collect()} == {"aws/spans"}
    lost = bare.withColumn("arrival_ts", F.when(F.col("source_event_id") != "e", F.col("arrival_ts")))
    assert [r.reason for r in unplaced(lost).collect()] == ["no_arrival"]
    rows = record_balance(lost).orderBy(F.col("window_start").asc_nulls_last()).collect()
    assert [(r.records, r.duplicates, r.decorators, r.emitted, r.conversion_errors, r.unplaced, r.residual) for r in rows] == [
        (5, 1, 1, 2, 1, 0, 0), (1, 0, 0, 0, 0, 1, 0),
    ]
