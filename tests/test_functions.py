import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanflow.functions import otlp
from spanflow.functions.json import (
    parse_message,
    strict_array,
    strict_bool,
    strict_str,
    strict_true,
    strict_u64,
)
from spanflow.functions.links import normalize_links, union_links
from spanflow.functions.records import (
    classify_record,
    is_completed_span,
    is_linkable_target,
    record_richness,
    subscription_filter,
)
from spanflow.functions.retry import base_backoff_ms, has_retry_budget, is_retryable_error
from tests.helpers import CLIENT, DECORATOR, TARGET, changed, documents

R = F.col("record")


def values(frame, column):
    return [r[0] for r in frame.orderBy("n").select(column).collect()]


@pytest.mark.parametrize(
    "text, valid",
    [
        ('{"a":1}', True), (' {"a":1} ', True), ("1", True), ("null", True), ('{"a":1,"a":2}', True),
        ('{"a":1} x', False), ("{}{}", False), ("", False), ("   ", False), ("1,2", False),
        ("1],[2", False), ("{}]", False), ('{"a":1,}', False), ("not-json", False), ("{", False),
        (r'{"a":"\ud83d\ude00"}', True), (r'{"a":"\ud83d"}', False), (r'{"a":"\ude00"}', False),
        (r'{"a":"\\ud83d"}', True), (r'{"a":"\ud83d\ud83d"}', False), (r'{"a":"\u00e9"}', True),
    ],
)
def test_only_one_whole_document_parses(spark, text, valid):
    frame = spark.createDataFrame([(text,)], "m string").select(parse_message(F.col("m")).isNotNull())
    assert frame.first()[0] is valid


def test_the_last_of_a_repeated_key_wins(spark):
    frame = documents(spark, '{"traceId":"a","traceId":"b"}')
    assert values(frame, strict_str(R, "$.traceId")) == ["b"]


def test_getters_do_not_convert_types(spark):
    frame = documents(spark, {"v": "true"}, {"v": True}, {"v": 1}, {"v": None}, {}, {"v": ["x"]}, [1])
    assert values(frame, strict_str(R, "$.v")) == ["true", None, None, None, None, None, None]
    assert values(frame, strict_bool(R, "$.v")) == [None, True, None, None, None, None, None]
    assert values(frame, strict_true(R, "$.v")) == [False, True, False, False, False, False, False]
    assert values(frame, F.size(strict_array(R, "$.v"))) == [None] * 5 + [1, None]


def test_unsigned_integers(spark):
    texts = ["5", "0", "-1", "1.0", "1.5", '"5"', "null", "18446744073709551615", "18446744073709551616", "9223372036854775807"]
    frame = documents(spark, *[f'{{"v":{t}}}' for t in texts])
    expected = [5, 0, None, None, None, None, None, 2**64 - 1, None, 2**63 - 1]
    assert values(frame, strict_u64(R, "$.v")) == expected


def test_flags_keep_the_low_32_bits(spark):
    frame = documents(spark, {"flags": 256}, {"flags": 2**32 + 5}, {"flags": 2**64 - 1}, {}, {"flags": -1})
    assert values(frame, otlp.flags32(R)) == [256, 5, 2**32 - 1, 0, 0]


def test_hex_cleaning(spark):
    cases = {
        "77aa00ff": "77aa00ff", "0xBEEF": "beef", "0XC0": "c0",
        "d0:0d_f0-0d c0 de": "d00df00dc0de", " e5 ": "e5", "": "", "-": "",
        "c0-ffg": None, "fade5": None, "0x0xfe": None, "c\x0bafe": None, "ü7": None, "\u00a0e5\u2003": "e5",
    }
    frame = spark.createDataFrame(list(enumerate(cases)), "n int, s string")
    assert values(frame, otlp.clean_hex(F.col("s"))) == list(cases.values())


def test_enums(spark):
    frame = spark.createDataFrame(list(enumerate(["server", "CLIENT", "Consumer", "x", None])), "n int, s string")
    assert values(frame, otlp.span_kind(F.col("s"))) == [2, 3, 5, 0, 0]
    frame = spark.createDataFrame(list(enumerate(["ok", "ERROR", "UNSET", None])), "n int, s string")
    assert values(frame, otlp.status_code(F.col("s"))) == [1, 2, 0, 0]


def test_roles(spark):
    both = changed(TARGET, _aws={"xray": {"linking": True, "decorator_type": "managed_link", "target_id": "x"}})
    frame = documents(
        spark, TARGET, DECORATOR, CLIENT, both,
        changed(TARGET, endTimeUnixNano=None), changed(TARGET, spanId=...),
        changed(DECORATOR, _aws={"xray": {"decorator_type": "managed_link", "target_id": 7}}),
        changed(TARGET, attributes={}, _aws={"xray": {"linking": "true"}}),
        changed(CLIENT, endTimeUnixNano="soon"), "[1]",
    )
    assert values(frame, classify_record(R)) == [
        "target", "decorator", "ordinary", "decorator", "incomplete", "target_no_span",
        "decorator_no_target", "ordinary", "ordinary", "incomplete",
    ]


def test_linkable_by_nested_attribute_only(spark):
    frame = documents(
        spark, {"attributes": {"aws.internal": {"linking": True}}},
        {"attributes": {"aws": {"internal": {"linking": True}}}}, {"attributes": {"aws.internal": True}},
    )
    assert values(frame, is_linkable_target(R)) == [True, False, False]
    assert values(documents(spark, {"endTimeUnixNano": {}}), is_completed_span(R)) == [True]


def test_richness_counts_right_types_only(spark):
    frame = documents(
        spark, TARGET, {"attributes": [1, 2], "links": {"a": 1}, "events": [1, 2]}, "[1,2]", {"resource": {"attributes": {"a": 1}}}
    )
    assert values(frame, record_richness(R)) == [4, 2, 0, 1]


def test_subscription_filter(spark):
    frame = documents(
        spark, CLIENT, DECORATOR, {"attributes": {"aws.local.service": "x"}}, {"attributes": {}},
        {"attributes": {"aws.local.service": "x", "aws.xray.inprogress": False}},
    )
    assert values(frame, subscription_filter(R)) == [True, True, True, False, False]


def links_of(spark, links, pending=None):
    frame = documents(spark, {"links": links, "pending": pending})
    own = strict_array(R, "$.links")
    column = normalize_links(own) if pending is None else union_links(own, strict_array(R, "$.pending"))
    return json.loads(frame.select(F.to_json(column)).first()[0])


def test_links_are_unique_and_stably_sorted(spark):
    links = [
        {"traceId": "t2", "spanId": "s2"}, {"traceId": "t1", "spanId": "s1", "flags": 1},
        {"traceId": "t1", "spanId": "s1", "flags": 2}, {"traceId": "t1", "spanId": 5}, {"spanId": "s"}, "text",
        {"traceId": "T1", "spanId": "s1"},
    ]
    assert links_of(spark, links) == [
        {"traceId": "T1", "spanId": "s1"}, {"flags": 1, "spanId": "s1", "traceId": "t1"}, {"spanId": "s2", "traceId": "t2"},
    ]


def test_union_prefers_existing_links_and_survives_a_wrong_type(spark):
    mine, theirs = {"traceId": "t", "spanId": "s", "flags": 1}, {"traceId": "t", "spanId": "s", "flags": 2}
    assert links_of(spark, [mine], [theirs])[0]["flags"] == 1
    assert links_of(spark, "none", [theirs])[0]["flags"] == 2
    assert links_of(spark, [], []) == []


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "a:b", ""]), st.sampled_from(["b", "c", "b:c", ""])), max_size=12))
def test_normalize_matches_plain_python(spark, ids):
    links = [{"traceId": t, "spanId": s, "i": i} for i, (t, s) in enumerate(ids)]
    seen, expected = set(), []
    for link in sorted(links, key=lambda e: (e["traceId"], e["spanId"])):
        key = link["traceId"] + ":" + link["spanId"]
        if key not in seen:
            seen.add(key)
            expected.append(link["i"])
    assert [e["i"] for e in links_of(spark, links)] == expected


def plain_value(value):
    if value is None:
        return {"stringValue": "null"}
    if isinstance(value, bool):
        return {"boolValue": value}
    if isinstance(value, int) and -(2**63) <= value < 2**63:
        return {"intValue": str(value)}
    if isinstance(value, (int, float)):
        return {"doubleValue": float(value)}
    if isinstance(value, str):
        return {"stringValue": value}
    if isinstance(value, list):
        return {"arrayValue": {"values": [plain_value(v) for v in value]}}
    return {"kvlistValue": {"values": [{"key": k, "value": plain_value(value[k])} for k in sorted(value)]}}


def deep(levels, value):
    for i in range(levels):
        value = [value, i] if i % 2 else {"k": value, "é\"": "x,]}:{"}
    return value


def test_attribute_values_at_any_depth(spark):
    record = {
        "a": {
            "s": 'q"\\\n', "i": -7, "b": False, "n": None, "d": 2.5, "z": 1.0, "big": 2**64, "l": [], "o": {},
            "nest": {"x": [1, 1.0, {"y": None}]}, "d3": deep(3, 1), "d9": deep(9, -2.25), "d30": deep(30, "end"),
        }
    }
    rows = documents(spark, record).select(F.explode(otlp.convert_attributes(R, "$.a"))).collect()
    assert [r[0].key for r in rows] == sorted(record["a"])
    for row in rows:
        assert json.loads(row[0].value) == plain_value(record["a"][row[0].key]), row[0].key


def test_retry_rules(spark):
    codes = ["ServiceUnavailable", "AccessDeniedException", "UnexpectedResponseRecordCount", None]
    frame = spark.createDataFrame(list(enumerate(codes)), "n int, c string")
    assert values(frame, is_retryable_error(F.col("c"))) == [True, False, False, False]
    frame = spark.createDataFrame([(i, i) for i in range(1, 8)], "n int, a int")
    assert values(frame, base_backoff_ms(F.col("a"))) == [200, 400, 800, 1600, 2000, 2000, 2000]
    frame = spark.createDataFrame([(0, 4999), (1, 5000)], "n int, b int")
    assert values(frame, has_retry_budget(F.col("b"))) == [False, True]


def test_numbers_and_depth_beyond_the_limits_are_malformed(spark):
    deep = lambda n: "[" * n + "]" * n
    cases = {
        '{"a":1e400}': False, '{"a":[-1E+999]}': False, '{"a":' + "9" * 400 + "}": False, '{"a":1e308}': True,
        '{"a":1e-400}': True, '{"a":"1e400"}': True, '{"a":"\\"1e400"}': True, deep(127): True, deep(128): False,
        "[" + ",".join(["[]"] * 300) + "]": True, '{"a":"' + "[" * 200 + '"}': True,
    }
    frame = documents(spark, *cases)
    assert values(frame, R.isNotNull()) == list(cases.values())


def test_parsing_needs_the_session_option(spark):
    from spanflow.functions.json import DUPLICATE_KEYS

    spark.conf.set(DUPLICATE_KEYS, "false")
    try:
        with pytest.raises(RuntimeError):
            documents(spark, "{}")
    finally:
        spark.conf.set(DUPLICATE_KEYS, "true")


def test_values_keep_their_type_at_any_depth(spark):
    def value(depth, leaf):
        return leaf if depth == 0 else value(depth - 1, f'{{"k":{leaf},"l":[{leaf},"1.0, -0 "]}}' if depth % 2 else f'[{leaf}]')

    def converted(v):
        if isinstance(v, dict):
            return {"kvlistValue": {"values": [{"key": k, "value": converted(v[k])} for k in sorted(v)]}}
        if isinstance(v, list):
            return {"arrayValue": {"values": [converted(x) for x in v]}}
        if isinstance(v, str):
            return {"stringValue": v}
        return {"doubleValue": v} if isinstance(v, float) else {"intValue": str(v)}

    cases = [f'{{"attributes":{{"a":{value(d, leaf)}}}}}' for d in range(7) for leaf in ("1.0", "1", "2.50", "-3.00", "-0")]
    frame = documents(spark, *cases)
    found = values(frame, otlp.convert_attributes(R, "$.attributes")[0]["value"])
    for text, got in zip(cases, found):
        want = converted(json.loads(text, parse_int=lambda t: -0.0 if t == "-0" else int(t))["attributes"]["a"])
        assert repr(json.loads(got)) == repr(want), text


def test_filter_patterns(spark):
    from spanflow.functions.patterns import DEFAULT_PATTERN, filter_pattern

    docs = [
        '{"a":{"b c":5,"d":["x",{"y":"op-1"}]},"t":true,"z":null,"s":"5"}',
        '{"a":{"b c":5.0,"d":[]},"t":"true","s":"a\\"b*c"}',
        '{"a":{"b c":"5"},"t":false,"n":12345678901234567890123}',
        '{"a":1,"resource":{"attributes":{"service.name":null}}}',
        '{"_aws":{"xray":{"decorator_type":"managed_link"}},"attributes":{"aws.xray.inprogress":false}}',
        '{"attributes":{"aws.local.service":"x","aws.xray.inprogress":0}}',
    ]
    patterns = {
        "{ $.a.['b c'] = 5 }": [0, 1], '{ $.a["b c"] != 5 }': [2], "{$.a.['b c'] >= 5 && $.t IS TRUE}": [0], "{ $.t IS FALSE }": [2],
        "{ $.a.d[1].y = op-* }": [0], '{ $.a.d[1].y = "*-1" || $.s = "5" }': [0], "{ $.s = 5 }": [], '{ $.s = "a\\"b*" }': [1],
        "{ $.z IS NULL }": [0], "{ $.z = * }": [0], "{ $.z EXISTS && $.q NOT EXISTS }": [0], "{ $.n > 1e22 }": [2], "{ $.t = %^tr% }": [1],
        "{ $.a.d = * && ($.s = 5 || $.s = %b%) || $.a = 1 }": [1, 3], "{ $.t != \"x\" }": [0, 1, 2], DEFAULT_PATTERN: [3, 4],
        "{ $.s != \"5\" }": [1],
    }
    frame = documents(spark, *docs)
    for text, want in patterns.items():
        test = filter_pattern(text)(F.col("record"))
        rows = frame.select("n", test.alias("holds")).orderBy("n").collect()
        assert [r.n for r in rows if r.holds] == want and all(r.holds is not None for r in rows), text
    for wrong in ("$.a = 1", "{ }", "{ $.a }", "{ $.a = }", "{ ($.a = 1 }", "{ $.a = 1 $.b = 2 }", "{ a = 1 }", "{ $.a < x }", "{ $.a = 1) }", "{ $.a && $.b = 1 }"):
        with pytest.raises(ValueError):
            filter_pattern(wrong)


def test_the_tests_of_all_messages_pass_over_them_once(spark):
    """No search for the 64th bracket byte by byte; limits hold next to other runs of digits."""
    assert "substring_index" not in str(parse_message(F.col("message")))
    fine = ["[1e99,2E+099]", f"[{'1' * 308},{'9' * 16}]", f'["{"7" * 400}",1,"1e999"]', "[" * 63 + "]" * 63]
    beyond = [f"[12,1{'0' * 309}]", "[5,6e0400,7]", "[1E+400]", "[" * 128 + "]" * 128, '{"a":' * 128 + "1" + "}" * 128]
    rows = spark.createDataFrame([(t,) for t in fine + beyond], "message string")
    found = [r[0] for r in rows.select(parse_message(F.col("message")).isNotNull()).collect()]
    assert found == [True] * len(fine) + [False] * len(beyond)


def test_documents_are_built_once():
    """Taking a document out of a larger one would build it a second time."""
    assert "variant_get" not in str(parse_message(F.col("message")))
