"""Span record to OTLP columns: ids, enums, attributes, events and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanflow.functions.json import (
    U64,
    json_quote,
    let,
    present,
    str_of,
    strict_array,
    strict_object,
    strict_str,
    strict_u64,
    type_name,
    u64_of,
    wrap_u32,
)
from spanflow.functions.records import LOCAL_SERVICE, SERVICE_NAME

# Enum numbers of the OTLP span kind and status code.
SPAN_KINDS = {"INTERNAL": 1, "SERVER": 2, "CLIENT": 3, "PRODUCER": 4, "CONSUMER": 5}
STATUS_CODES = {"OK": 1, "ERROR": 2}
UNNAMED_SPAN = "UnnamedSpan"
REFERENCE_TYPE = "aws.xray.reference_type"

# Unicode white space (trimmed) and ASCII white space (dropped).
UNICODE_SPACE = (
    r"[\x09-\x0D\x20\x85\xA0  -     　]"
)
HEX_SEPARATORS = r"[:\-_ \t\n\f\r]"

# Levels of nesting that attribute values are unfolded by; deeper ones are
# rewritten token by token, to any depth.
NESTING = 2

# Tokens of compact JSON text: key with colon, string, bracket or comma, the rest.
JSON_TOKENS = (
    r'"[^"\\]*+(?:\\.[^"\\]*+)*+":'
    r'|"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    r"|[{}\[\],]"
    r'|[^{}\[\],:"]+'
)


def clean_hex(text: Column) -> Column:
    """Lower-case hex digits; null for a bad character or an odd digit count."""
    trimmed = F.regexp_replace(text, f"^{UNICODE_SPACE}+|{UNICODE_SPACE}+$", "")
    bare = F.regexp_replace(trimmed, "^0[xX]", "")
    digits = F.regexp_replace(bare, HEX_SEPARATORS, "")
    return F.when(_is_hex(text), F.lower(text)).when(_is_hex(digits), F.lower(digits))


def _is_hex(text: Column) -> Column:
    # unhex() alone pads an odd digit count.
    return (F.length(text) % 2 == 0) & F.unhex(text).isNotNull()


def decode_hex(text: Column) -> Column:
    return F.unhex(clean_hex(text))


def _enum(text: Column, numbers: dict[str, int]) -> Column:
    pairs = [F.lit(x) for pair in numbers.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(text)), F.lit(0))


def span_kind(kind: Column) -> Column:
    return _enum(kind, SPAN_KINDS)


def status_code(code: Column) -> Column:
    return _enum(code, STATUS_CODES)


# What ``raw_fields`` reads of a record.
RAW = (
    "struct<traceId:variant,spanId:variant,parentSpanId:variant,name:variant,kind:variant,"
    "startTimeUnixNano:variant,endTimeUnixNano:variant,flags:variant,"
    "status:struct<code:variant,message:variant>,scope:struct<name:variant,version:variant>,"
    "_aws:struct<xray:struct<name:variant>>>"
)


def raw_fields(read: Column) -> dict[str, Column]:
    """What a span is made of, checked for type; ``read`` are the fields of ``RAW``, read once."""
    return {
        "trace_id": str_of(read["traceId"]),
        "span_id": str_of(read["spanId"]),
        "parent_span_id": str_of(read["parentSpanId"]),
        "name": str_of(read["name"]),
        "xray_name": str_of(read["_aws"]["xray"]["name"]),
        "kind": str_of(read["kind"]),
        "start": u64_of(read["startTimeUnixNano"]),
        "end": u64_of(read["endTimeUnixNano"]),
        "status_code": str_of(read["status"]["code"]),
        "status_message": str_of(read["status"]["message"]),
        "flags": u64_of(read["flags"]),
        "scope_name": str_of(read["scope"]["name"]),
        "scope_version": str_of(read["scope"]["version"]),
        "is_object": read.isNotNull(),
    }


def span_name(name: Column, xray_name: Column) -> Column:
    return F.coalesce(
        F.nullif(name, F.lit("")), F.nullif(xray_name, F.lit("")), F.lit(UNNAMED_SPAN)
    )


def flags32(doc: Column) -> Column:
    return wrap_u32(strict_u64(doc, "$.flags"))


def clean_id(raw: Column) -> Column:
    """Clean hex of an id field; empty when absent, null when it is not hex."""
    return F.when(raw.isNull(), F.lit("")).otherwise(clean_hex(raw))


def convert_error(raw: Column) -> Column:
    """Why the record of these raw fields cannot become a span; null when it can."""
    return (
        F.when(~raw["is_object"], "not_an_object")
        .when(raw["end"].isNull(), "end_time")
        .when(clean_id(raw["trace_id"]).isNull(), "trace_id")
        .when(clean_id(raw["span_id"]).isNull(), "span_id")
        .when(clean_id(raw["parent_span_id"]).isNull(), "parent_span_id")
    )


def span_scalars(raw: Column) -> dict[str, Column]:
    def text(name: str) -> Column:
        return F.coalesce(raw[name], F.lit(""))

    return {
        "trace_id_hex": clean_id(raw["trace_id"]),
        "span_id_hex": clean_id(raw["span_id"]),
        "parent_span_id_hex": clean_id(raw["parent_span_id"]),
        "name": span_name(raw["name"], raw["xray_name"]),
        "kind": span_kind(raw["kind"]),
        "start_time_unix_nano": F.coalesce(raw["start"], F.lit(0).cast(U64)),
        "end_time_unix_nano": raw["end"],
        "status_code": status_code(raw["status_code"]),
        "status_message": text("status_message"),
        "flags": wrap_u32(raw["flags"]),
        "scope_name": text("scope_name"),
        "scope_version": text("scope_version"),
    }


def _key_value(key: Column, value: Column) -> Column:
    return F.concat(F.lit('{"key":'), json_quote(key), F.lit(',"value":'), value, F.lit("}"))


def _wrapped(name: str, text: Column) -> Column:
    return F.concat(F.lit(f'{{"{name}":'), text, F.lit("}"))


def nested_value(value: Column) -> Column:
    """OTLP/JSON text of an object or array of any depth.

    What each JSON token turns into depends only on the token and the ones next
    to it, so one pass over the tokens does it, without recursion. The one thing
    the printed value does not tell is a fraction of zero: 1.0 prints as 1.
    """

    def rewrite(tokens: Column) -> Column:
        def one(token: Column, i: Column) -> Column:
            before, after = F.get(tokens, i - 1), F.get(tokens, i + 1)
            is_key, is_text = token.endswith('":'), token.startswith('"')
            return (
                F.when(token == "{", '{"kvlistValue":{"values":[')
                .when(token == "[", '{"arrayValue":{"values":[')
                .when(token == "]", "]}}")
                .when(token == "}", F.when(before == "{", "]}}").otherwise("}]}}"))
                .when(token == ",", F.when(after.endswith('":'), "},").otherwise(","))
                .when(
                    is_key,
                    F.concat(F.lit('{"key":'), F.rtrim(token, F.lit(":")), F.lit(',"value":')),
                )
                .when(is_text, _wrapped("stringValue", token))
                .when(token.isin("true", "false"), _wrapped("boolValue", token))
                .when(token == "null", '{"stringValue":"null"}')
                .when(
                    token.rlike("^-?[0-9]+$") & token.try_cast("bigint").isNotNull(),
                    _wrapped("intValue", F.concat(F.lit('"'), token, F.lit('"'))),
                )
                .otherwise(_wrapped("doubleValue", token.try_cast("double").cast("string")))
            )

        return F.array_join(F.transform(tokens, one), "")

    tokens = F.regexp_extract_all(F.to_json(value), F.lit(JSON_TOKENS), F.lit(0))
    return let(tokens, rewrite)


def any_value(value: Column, depth: int = NESTING) -> Column:
    """OTLP/JSON text of one JSON value.

    Integers of 64 signed bits are intValue, all other numbers doubleValue, a
    JSON null is the text "null".
    """

    def convert(kind: Column) -> Column:
        is_object, is_array = kind.startswith("OBJECT"), kind.startswith("ARRAY")
        double = F.try_variant_get(value, "$", "double").cast("string")
        column = (
            F.when(kind == "STRING", _wrapped("stringValue", F.to_json(value)))
            .when(
                kind == "BIGINT",
                _wrapped("intValue", F.concat(F.lit('"'), F.to_json(value), F.lit('"'))),
            )
            .when(kind == "BOOLEAN", _wrapped("boolValue", F.to_json(value)))
            .when(kind == "VOID", F.lit('{"stringValue":"null"}'))
            .when(~is_object & ~is_array, _wrapped("doubleValue", double))
        )
        if depth == 0:
            return column.otherwise(nested_value(value))
        # Objects and arrays share one branch, so the expression grows by one
        # level per depth instead of doubling.
        elements = F.coalesce(
            F.map_entries(strict_object(value, "$")),
            F.transform(
                strict_array(value, "$"),
                lambda e: F.struct(F.lit(None).cast("string").alias("key"), e.alias("value")),
            ),
        )
        texts = F.transform(
            elements,
            lambda e: let(
                any_value(e["value"], depth - 1),
                lambda text: F.when(e["key"].isNull(), text).otherwise(
                    _key_value(e["key"], text)
                ),
            ),
        )
        name = F.when(is_object, "kvlistValue").otherwise("arrayValue")
        nested = F.concat(
            F.lit('{"'), name, F.lit('":{"values":['), F.array_join(texts, ","), F.lit("]}}")
        )
        return column.otherwise(nested)

    return let(type_name(value), convert)


ATTRIBUTES = "array<struct<key:string,value:string>>"


def convert_attributes(doc: Column, path: str) -> Column:
    """Object at ``path`` to key-sorted ``key`` and OTLP value text; else empty."""
    entries = F.transform(
        F.map_entries(strict_object(doc, path)),
        lambda e: F.struct(e["key"].alias("key"), any_value(e["value"]).alias("value")),
    )
    return F.coalesce(F.sort_array(entries), F.array().cast(ATTRIBUTES))


def _string_attribute(key: str, text: Column) -> Column:
    value = F.concat(F.lit('{"stringValue":'), json_quote(text), F.lit("}"))
    return F.array(F.struct(F.lit(key).alias("key"), value.alias("value")))


def resource_attributes(record: Column) -> Column:
    """Resource attributes, with a service name projected from the span if missing.

    Only an absent key counts as missing; a null value is a value.
    """
    own = convert_attributes(record, "$.resource.attributes")
    service = F.coalesce(
        strict_str(record, f"$.attributes['{LOCAL_SERVICE}']"),
        strict_str(record, f"$.attributes['{SERVICE_NAME}']"),
    )
    missing = ~present(record, f"$.resource.attributes['{SERVICE_NAME}']")
    return F.when(
        missing & service.isNotNull(),
        F.sort_array(F.concat(own, _string_attribute(SERVICE_NAME, service))),
    ).otherwise(own)


def convert_events(record: Column) -> Column:
    """Span events; elements that are not objects are left out."""
    objects = F.filter(
        strict_array(record, "$.events"), lambda e: strict_object(e, "$").isNotNull()
    )
    events = F.transform(
        objects,
        lambda e: F.struct(
            F.coalesce(
                strict_u64(e, "$.timeUnixNano"), F.lit(0).cast(U64)
            ).alias("time_unix_nano"),
            F.coalesce(strict_str(e, "$.name"), F.lit("")).alias("name"),
            convert_attributes(e, "$.attributes").alias("attributes"),
        ),
    )
    return F.coalesce(
        events,
        F.array().cast(
            f"array<struct<time_unix_nano:decimal(20,0),name:string,attributes:{ATTRIBUTES}>>"
        ),
    )


def link_attributes(link: Column) -> Column:
    """Attributes of a link and, last, its reference type."""
    own = convert_attributes(link, "$.attributes")
    reference = strict_str(link, "$._aws.xray.reference_type")
    return F.when(
        reference.isNotNull(), F.concat(own, _string_attribute(REFERENCE_TYPE, reference))
    ).otherwise(own)


def convert_links(links: Column) -> Column:
    """Span links whose two ids are hex text; all others are left out."""
    converted = F.transform(
        links,
        lambda link: F.struct(
            let(strict_str(link, "$.traceId"), clean_hex).alias("trace_id_hex"),
            let(strict_str(link, "$.spanId"), clean_hex).alias("span_id_hex"),
            link_attributes(link).alias("attributes"),
            flags32(link).alias("flags"),
        ),
    )
    return F.coalesce(
        F.filter(
            converted,
            lambda e: e["trace_id_hex"].isNotNull() & e["span_id_hex"].isNotNull(),
        ),
        F.array().cast(
            "array<struct<trace_id_hex:string,span_id_hex:string,"
            f"attributes:{ATTRIBUTES},flags:bigint>>"
        ),
    )


def attributes_json(attributes: Column) -> Column:
    return F.concat(
        F.lit("["),
        F.array_join(
            F.transform(attributes, lambda a: _key_value(a["key"], a["value"])), ","
        ),
        F.lit("]"),
    )


def event_json(event: Column) -> Column:
    return F.concat(
        F.lit('{"timeUnixNano":"'), event["time_unix_nano"].cast("string"),
        F.lit('","name":'), json_quote(event["name"]),
        F.lit(',"attributes":'), attributes_json(event["attributes"]), F.lit("}"),
    )


def link_json(link: Column) -> Column:
    return F.concat(
        F.lit('{"traceId":"'), link["trace_id_hex"],
        F.lit('","spanId":"'), link["span_id_hex"],
        F.lit('","attributes":'), attributes_json(link["attributes"]),
        F.lit(',"flags":'), link["flags"].cast("string"), F.lit("}"),
    )
