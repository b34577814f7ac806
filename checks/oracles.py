"""DuckDB SQL that answers each registered query from the same tables.

DuckDB parses the derived messages with its own JSON functions. For a repeated
key it reads the first value where the format wants the last, so the one
shadowed key the data contains is removed from the text beforehand.
"""

from __future__ import annotations

from checks.queries import HEX_SPELLINGS
from spanflow.plans.metrics import RELAY_COUNTERS, ROLES
from spanflow.sources.derived import SHADOWED_NAME, duckdb_events_sql

EVENT = "source_event_id, arrival_seq"


def _type(path: str, doc: str = "doc") -> str:
    return f"json_type({doc}, '{path}')"


def _str(path: str, doc: str = "doc") -> str:
    return (
        f"case when {_type(path, doc)} = 'VARCHAR'"
        f" then json_extract_string({doc}, '{path}') end"
    )


def _true(path: str, doc: str = "doc") -> str:
    return (
        f"coalesce({_type(path, doc)} = 'BOOLEAN'"
        f" and json_extract_string({doc}, '{path}') = 'true', false)"
    )


def _u64(path: str, doc: str = "doc") -> str:
    return (
        f"case when {_type(path, doc)} = 'UBIGINT'"
        f" then cast(json_extract_string({doc}, '{path}') as bigint) end"
    )


def _is(path: str, text: str) -> str:
    return f"coalesce(({_str(path)}) = '{text}', false)"


def _number(path: str) -> str:
    kinds = "('UBIGINT', 'BIGINT', 'HUGEINT', 'DOUBLE')"
    return f"(case when {_type(path)} in {kinds} then cast(json_extract_string(doc, '{path}') as double) end)"


LINKING = "$._aws.xray.linking"
INTERNAL = '$.attributes."aws.internal".linking'
SERVICE = '$.resource.attributes."service.name"'
LOCAL = '$.attributes."aws.local.service"'

DECORATOR = f"coalesce({_str('$._aws.xray.decorator_type')} = 'managed_link', false)"
LINKABLE = f"({_true(LINKING)} or {_true(INTERNAL)})"
COMPLETED = f"coalesce({_type('$.endTimeUnixNano')} <> 'NULL', false)"
TARGET_ID = _str("$._aws.xray.target_id")
SPAN_ID = _str("$.spanId")

ROLE = (
    f"case when {DECORATOR} then case when ({TARGET_ID}) is null"
    " then 'decorator_no_target' else 'decorator' end"
    f" when not {COMPLETED} then 'incomplete'"
    f" when {LINKABLE} then case when ({SPAN_ID}) is null"
    " then 'target_no_span' else 'target' end"
    " else 'ordinary' end"
)


def _keys(path: str) -> str:
    return (
        f"case when {_type(path)} = 'OBJECT' then len(json_keys(doc, '{path}')) else 0 end"
    )


def _items(path: str) -> str:
    return f"case when {_type(path)} = 'ARRAY' then json_array_length(doc, '{path}') else 0 end"


RICHNESS = " + ".join(
    [
        _keys("$.attributes"),
        _keys("$.resource.attributes"),
        _items("$.links"),
        _items("$.events"),
    ]
)

# Common table expressions, each built on the ones before.
STEPS = {
    "ev": duckdb_events_sql(),
    "parsed": (
        "select *, case when json_valid(message) then"
        f" cast(replace(message, {SHADOWED_NAME}, '') as json) end as doc from ev"
    ),
    "rec": (
        "select * exclude (trace_id, source_log_group),"
        f" {_str('$.traceId')} as trace_id,"
        " case when source_log_group = '' then 'aws/spans' else source_log_group end"
        " as source_log_group,"
        " arrival_s - arrival_s % 60 as window_s"
        f" from parsed where doc is not null and ({_str('$.traceId')}) is not null"
    ),
    "ded": (
        f"select *, {ROLE} as role from rec qualify row_number() over"
        " (partition by window_s, source_event_id order by arrival_s, arrival_seq) = 1"
    ),
    "best": (
        f"select *, {SPAN_ID} as link_span_id, {RICHNESS} as richness from ded"
        " where role = 'target' qualify row_number() over"
        f" (partition by window_s, trace_id, {SPAN_ID}"
        f" order by {RICHNESS} desc, arrival_s, arrival_seq) = 1"
    ),
    "dec": f"select *, {TARGET_ID} as link_span_id from ded where role = 'decorator'",
    "dlink": (
        "select d.window_s, d.trace_id, d.link_span_id, d.arrival_s, d.arrival_seq,"
        " e.key::int as pos, e.value as link from dec d, json_each(d.doc, '$.links') e"
    ),
    "pend_link": (
        f"select window_s, trace_id, link_span_id, {_str('$.traceId', 'link')} as t,"
        f" {_str('$.spanId', 'link')} as s, link from dlink"
        f" where ({_str('$.traceId', 'link')}) is not null and ({_str('$.spanId', 'link')}) is not null"
        " qualify row_number() over (partition by window_s, trace_id, link_span_id, t || ':' || s"
        " order by t, s, arrival_s, arrival_seq, pos) = 1"
    ),
    "pend": (
        "select c.window_s, c.trace_id, c.link_span_id, c.decorator_records, coalesce(l.links, '') as links"
        " from (select window_s, trace_id, link_span_id, count(*) as decorator_records from dec group by all) c"
        " left join (select window_s, trace_id, link_span_id,"
        " string_agg(t || ':' || s || ':' || json_extract_string(link, '$.flags'), ',' order by t, s) as links"
        " from pend_link group by all) l using (window_s, trace_id, link_span_id)"
    ),
    "own_link": (
        "select b.window_s, b.trace_id, b.link_span_id, e.key::int as pos, e.value as link,"
        f" {_str('$.traceId', 'e.value')} as t, {_str('$.spanId', 'e.value')} as s"
        " from best b, json_each(b.doc, '$.links') e"
    ),
    "all_link": (
        "select window_s, trace_id, link_span_id, 0 as part, pos, t, s, link from own_link"
        " join pend using (window_s, trace_id, link_span_id)"
        " where t is not null and s is not null"
        " union all select window_s, trace_id, link_span_id, 1, 0, t, s, link from pend_link"
    ),
    "merged_link": (
        "select * from all_link qualify row_number() over"
        " (partition by window_s, trace_id, link_span_id, t || ':' || s order by t, s, part, pos) = 1"
    ),
    # Links of every best target after the merge, with their order.
    "final_link": (
        "select window_s, trace_id, link_span_id, link, t, s, cast(row_number() over"
        " (partition by window_s, trace_id, link_span_id order by t, s) as bigint) - 1 as pos"
        " from merged_link join (select window_s, trace_id, link_span_id from best) using (window_s, trace_id, link_span_id)"
        " union all select window_s, trace_id, link_span_id, link, t, s, pos from own_link"
        " anti join pend using (window_s, trace_id, link_span_id)"
    ),
    "emit": (
        "select window_s, trace_id, false as is_target, source_event_id, arrival_s, arrival_seq,"
        " source_log_group, doc, q from ded where role = 'ordinary'"
        " union all select window_s, trace_id, true, source_event_id, arrival_s, arrival_seq,"
        " source_log_group, doc, q from best"
    ),
}


def _hex_ok(path: str) -> str:
    text = _str(path)
    return (
        f"coalesce(regexp_full_match(regexp_replace(regexp_replace(trim({text}), '^0[xX]', ''),"
        " '[:\\-_ \\t\\n\\f\\r]', '', 'g'), '([0-9a-fA-F]{2})*'), true)"
    )


def _clean(path: str) -> str:
    text = _str(path)
    return (
        f"coalesce(lower(regexp_replace(regexp_replace(trim({text}), '^0[xX]', ''),"
        " '[:\\-_ \\t\\n\\f\\r]', '', 'g')), '')"
    )


ERROR = (
    f"case when ({_u64('$.endTimeUnixNano')}) is null then 'end_time'"
    f" when not {_hex_ok('$.traceId')} then 'trace_id'"
    f" when not {_hex_ok('$.spanId')} then 'span_id'"
    f" when not {_hex_ok('$.parentSpanId')} then 'parent_span_id' end"
)
STEPS["conv"] = f"select * from rec where ({ERROR}) is null"


def _code(text: str, numbers: dict[str, int]) -> str:
    whens = " ".join(f"when '{name}' then {number}" for name, number in numbers.items())
    return f"cast(case upper({text}) {whens} else 0 end as bigint)"


def _flags(doc: str = "doc") -> str:
    return f"coalesce(({_u64('$.flags', doc)}) % 4294967296, 0)"


# Text of an attribute value; the data nests lists and objects two deep.
def _scalar_value(value: str) -> str:
    text = f"json_extract_string({value}, '$')"
    return (
        f"case json_type({value}) when 'VARCHAR' then '{{\"stringValue\":' || to_json({text}) || '}}'"
        f" when 'UBIGINT' then '{{\"intValue\":\"' || {text} || '\"}}'"
        f" when 'BIGINT' then '{{\"intValue\":\"' || {text} || '\"}}'"
        f" when 'BOOLEAN' then '{{\"boolValue\":' || {text} || '}}'"
        f" when 'NULL' then '{{\"stringValue\":\"null\"}}'"
        f" when 'DOUBLE' then '{{\"doubleValue\":' || {text} || '}}'"
    )


def _value(value: str) -> str:
    """OTLP text of a scalar, or of the two nested values the data contains."""
    linking = (
        "'{\"kvlistValue\":{\"values\":[{\"key\":\"linking\",\"value\":' ||"
        f" ({_scalar_value(f'json_extract({value}, $$$.linking$$)')} end) || '}}]}}}}'"
    )
    tags = (
        "'{\"arrayValue\":{\"values\":[{\"stringValue\":\"a\"},' ||"
        f" ({_scalar_value(f'json_extract({value}, $$$[1]$$)')} end) ||"
        " ',{\"kvlistValue\":{\"values\":[{\"key\":\"z\",\"value\":{\"arrayValue\":"
        "{\"values\":[{\"boolValue\":true}]}}}]}}]}}'"
    )
    return f"{_scalar_value(value)} when 'OBJECT' then {linking} when 'ARRAY' then {tags} end"


def _attributes_json(doc: str, path: str) -> str:
    """Attributes of an event or link, all of them scalars, as a JSON list."""
    return (
        "'[' || coalesce((select string_agg('{\"key\":' || to_json(a.key) || ',\"value\":' ||"
        f" ({_scalar_value('a.value')} end) || '}}', ',' order by a.key)"
        f" from json_each({doc}, '{path}') a), '')"
    )


def sql(*needs: str, select: str) -> str:
    """A query over the steps it names and all that these build on."""
    names = list(STEPS)
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name in wanted:
            return
        wanted.add(name)
        words = set(STEPS[name].replace("(", " ").replace(")", " ").replace(",", " ").split())
        for other in names:
            if other != name and other in words:
                add(other)

    for name in needs:
        add(name)
    steps = ", ".join(f"{name} as ({STEPS[name]})" for name in names if name in wanted)
    return f"with {steps} {select}"


STEPS["sent"] = (
    "select batch_id, (rn - 1) // 500 as chunk_index, (rn - 1) % 500 as position,"
    " source_event_id, trace_id, message from"
    " (select *, row_number() over (partition by batch_id order by arrival_s, arrival_seq) as rn from rec)"
)
STEPS["answer"] = (
    "select *, case when c = 0 and attempt = 1 or c in (1, 3) then 'ProvisionedThroughputExceededException'"
    " when c = 2 then 'AccessDeniedException' end as error_code from"
    " (select *, (cast(split_part(source_event_id, '-', 2) as bigint)"
    " + cast(split_part(source_event_id, '-', 3) as bigint)) % 20 as c from sent),"
    " (select unnest([1, 2, 3]) as attempt)"
)
STEPS["led"] = (
    "select batch_id, chunk_index, position, source_event_id, cast(attempt as bigint) as attempt, error_code,"
    " 'failed: ' || error_code as error_message,"
    " case when error_code is null then 'published'"
    " when error_code like 'Prov%' and c <> 3 and attempt < 3 then 'retried' else 'dead' end as outcome"
    " from answer where attempt = 1 or c = 0 and attempt = 2 or c = 1"
)
ROW = "batch_id, chunk_index, position"
EMISSION = f"window_s, trace_id, is_target, case when is_target then {SPAN_ID} end nulls first, arrival_s, arrival_seq"

SUMMARY = (
    "select d.window_s as window_start, r.n - d.n as deduped_source_events, d.traces as aggregated_traces,"
    " coalesce(e.n, 0) as emitted_spans, coalesce(e.traces, 0) as emitted_trace_ids,"
    " coalesce(l.n, 0) as late_decorators_dropped, d.bytes as state_bytes, d.empty as empty_trace_id, true as is_final from"
    " (select window_s, count(*) as n, count(distinct trace_id) as traces, cast(sum(strlen(message)) as bigint) as bytes,"
    " count(distinct trace_id) filter (trace_id = '') as empty from ded group by 1) d"
    " join (select window_s, count(*) as n from rec group by 1) r using (window_s)"
    f" left join (select window_s, count(*) as n, count(distinct trace_id) as traces from emit where ({ERROR}) is null"
    " group by 1) e using (window_s)"
    " left join (select window_s, cast(sum(decorator_records) as bigint) as n from pend"
    " anti join best using (window_s, trace_id, link_span_id) group by 1) l using (window_s)"
)

LINK_TEXT = "string_agg(t || ':' || s || ':' || json_extract_string(link, '$.flags'), ',' order by t, s, pos)"

PUBLISHED = (
    "select count(*) filter (outcome = 'published') as published_records,"
    " count(distinct source_event_id) filter (outcome = 'retried') as retried_records,"
    " (select count(distinct source_event_id) from (select source_event_id from led where attempt > 1"
    " group by batch_id, chunk_index, attempt, source_event_id having bool_and(outcome = 'published'))) as recovered_on_retry,"
    " count(*) filter (outcome = 'dead') as sent_to_failure_queue, (select count(*) from (select count(*) as n from"
    " (select *, (row_number() over (partition by batch_id, chunk_index order by attempt, position) - 1) // 10 as send_index"
    " from led where outcome = 'dead') group by batch_id, chunk_index, send_index) where n = 10) as failure_queue_send_failures,"
    " count(distinct (batch_id, chunk_index, attempt)) as publish_attempts from led"
)

ORACLES: dict[str, str] = {
    "linked_targets": sql(
        "best", "pend", "final_link",
        select=(
            f"select b.window_s, b.trace_id, b.link_span_id, {EVENT},"
            " coalesce(p.decorator_records, 0) as decorator_records, coalesce(l.links, '') as links"
            " from best b left join pend p using (window_s, trace_id, link_span_id)"
            " left join (select window_s, trace_id, link_span_id,"
            " string_agg(t || ':' || s || ':' || json_extract_string(link, '$.flags'), ',' order by pos) as links"
            " from final_link group by all) l using (window_s, trace_id, link_span_id)"
        ),
    ),
    "subscription_filtered": sql(
        "parsed",
        select=(
            f"select {EVENT} from parsed where doc is not null and (({_type(SERVICE)} is not null"
            f" or {_type(LOCAL)} is not null) and {_type('$.attributes.\"aws.xray.inprogress\"')} is null"
            f" or {DECORATOR})"
        ),
    ),
    "filter_patterns": sql(
        "parsed",
        select=(
            f"select {EVENT}, {_is('$.kind', 'SERVER')} and {_number('$.attributes.\"http.status_code\"')} >= 203 is true as server_errors,"
            f" ({_str('$.name')}) like 'op-%' is true or {_is('$.status.code', 'ERROR')} as named_or_failed,"
            f" ({_true('$.attributes.ok')} or {_type('$.parentSpanId')} is null) and"
            f" {_type('$.flags')} is not null and ({_number('$.flags')} = 258) is not true as roots,"
            f" ({_number('$.links[0].flags')} = 256) is true and ({_type('$.endTimeUnixNano')} = 'NULL') is true"
            f" and ({_type('$.name')} is not null and {_type('$.scope.name')} is not null or {_is('$.name', '')}) as open_parents,"
            f" regexp_matches({_str('$.name')}, '^op-[135]$') is true and ({_number('$.attributes.ratio')} < 17.5) is true"
            f" and {_true('$.attributes.tags[2].z[0]')} as odd_names from parsed where doc is not null"
        ),
    ),
    "partition_good": sql(
        "parsed",
        select=(
            f"select {EVENT}, {_str('$.traceId')} as trace_id from parsed"
            f" where doc is not null and ({_str('$.traceId')}) is not null"
        ),
    ),
    "partition_quarantine": sql(
        "parsed",
        select=(
            f"select {EVENT}, case when doc is null then 'bad_json' else 'no_trace_id' end as malformed,"
            f" message from parsed where doc is null or ({_str('$.traceId')}) is null"
        ),
    ),
    "record_fields": sql(
        "rec",
        select=(
            f"select {EVENT}, trace_id, {SPAN_ID} as span_id, {TARGET_ID} as target_id,"
            f" cast({_items('$.links')} as bigint) as links from rec"
        ),
    ),
    "record_flags": sql(
        "rec",
        select=(
            f"select {EVENT}, {COMPLETED} as completed, {LINKABLE} as linkable,"
            f" {DECORATOR} as decorator from rec"
        ),
    ),
    "record_roles": sql("rec", select=f"select {EVENT}, {ROLE} as role from rec"),
    "record_richness": sql(
        "rec", select=f"select {EVENT}, cast({RICHNESS} as bigint) as richness from rec"
    ),
    "deduped_events": sql(
        "ded", select=f"select window_s, {EVENT}, trace_id, source_log_group from ded"
    ),
    "dedupe_counts": sql(
        "rec",
        select=(
            "select window_s, count(*) as records, count(distinct source_event_id) as distinct_events,"
            " count(*) - count(distinct source_event_id) as deduped_events from rec group by window_s"
        ),
    ),
    "best_targets": sql(
        "best",
        select=(
            "select window_s, trace_id, link_span_id, cast(richness as bigint) as richness,"
            f" {EVENT} from best"
        ),
    ),
    "pending_links": sql(
        "pend", select="select window_s, trace_id, link_span_id, links, decorator_records from pend"
    ),
    "normalized_links": sql(
        "rec",
        select=(
            f"select {EVENT}, coalesce((select {LINK_TEXT} from"
            f" (select e.key::int as pos, e.value as link, {_str('$.traceId', 'e.value')} as t,"
            f" {_str('$.spanId', 'e.value')} as s from json_each(doc, '$.links') e) x"
            " where t is not null and s is not null and not exists"
            f" (select 1 from json_each(doc, '$.links') f where f.key::int < x.pos"
            f" and {_str('$.traceId', 'f.value')} = t and {_str('$.spanId', 'f.value')} = s)), '') as links"
            f" from rec where {_type('$.links')} = 'ARRAY'"
        ),
    ),
    "unlinked_targets": sql(
        "best", "pend",
        select=(
            f"select window_s, trace_id, link_span_id, {EVENT} from best"
            " anti join pend using (window_s, trace_id, link_span_id)"
        ),
    ),
    "late_decorators": sql(
        "best", "pend",
        select=(
            "select window_s, cast(sum(decorator_records) as bigint) as late_decorators_dropped"
            " from pend anti join best using (window_s, trace_id, link_span_id) group by window_s"
        ),
    ),
    "emitted_spans_ordered": sql(
        "emit",
        select=(
            f"select window_s, trace_id, is_target, {EVENT}, source_log_group"
            f" from emit where ({ERROR}) is null"
        ),
    ),
    "emission_index": sql(
        "emit",
        select=(
            f"select window_s, is_target, {EVENT}, row_number() over (order by {EMISSION}) as emission_index"
            f" from emit where ({ERROR}) is null"
        ),
    ),
    "otlp_scalars": sql(
        "conv",
        select=(
            f"select {EVENT}, {_clean('$.traceId')} as trace_id_hex, {_clean('$.spanId')} as span_id_hex,"
            f" {_clean('$.parentSpanId')} as parent_span_id_hex,"
            f" coalesce(nullif({_str('$.name')}, ''), nullif({_str('$._aws.xray.name')}, ''), 'UnnamedSpan') as name,"
            f" {_code(f'({_str('$.kind')})', {'INTERNAL': 1, 'SERVER': 2, 'CLIENT': 3, 'PRODUCER': 4, 'CONSUMER': 5})} as kind,"
            f" coalesce({_u64('$.startTimeUnixNano')}, 0) as start_time_unix_nano,"
            f" {_u64('$.endTimeUnixNano')} as end_time_unix_nano,"
            f" {_code(f'({_str('$.status.code')})', {'OK': 1, 'ERROR': 2})} as status_code,"
            f" coalesce({_str('$.status.message')}, '') as status_message, {_flags()} as flags,"
            f" coalesce({_str('$.scope.name')}, '') as scope_name, coalesce({_str('$.scope.version')}, '') as scope_version,"
            " '{\"stringValue\":\"' || "
            f"(case when {_type(SERVICE)} is not null then json_extract_string(doc, '{SERVICE}')"
            f" else {_str(LOCAL)} end) || '\"}}' as service_name from conv"
        ),
    ),
    "otlp_attributes": sql(
        "conv",
        select=(
            f"select {EVENT}, a.key as key, {_value('a.value')} as value"
            " from conv, json_each(doc, '$.attributes') a"
        ),
    ),
    "otlp_resource_attributes": sql(
        "conv",
        select=(
            f"select {EVENT}, a.key as key, {_scalar_value('a.value')} end as value"
            " from conv, json_each(doc, '$.resource.attributes') a union all"
            f" select {EVENT}, 'service.name', '{{\"stringValue\":' || to_json({_str(LOCAL)}) || '}}'"
            f" from conv where {_type(SERVICE)} is null and ({_str(LOCAL)}) is not null"
        ),
    ),
    "otlp_events": sql(
        "conv",
        select=(
            f"select {EVENT}, row_number() over (partition by {EVENT} order by e.key::int) - 1 as pos,"
            f" coalesce({_u64('$.timeUnixNano', 'e.value')}, 0) as time_unix_nano,"
            f" coalesce({_str('$.name', 'e.value')}, '') as name,"
            f" {_attributes_json('e.value', '$.attributes')} || ']' as attributes"
            " from conv, json_each(doc, '$.events') e where json_type(e.value) = 'OBJECT'"
        ),
    ),
    "otlp_links": sql(
        "best", "ded", "final_link",
        select=(
            f"select window_s, {EVENT}, pos, lower(t) as trace_id_hex, lower(s) as span_id_hex,"
            f" {_flags('link')} as flags, {_attributes_json('link', '$.attributes')} ||"
            " ',{\"key\":\"aws.xray.reference_type\",\"value\":{\"stringValue\":\"' ||"
            " json_extract_string(link, '$._aws.xray.reference_type') || '\"}}]' as attributes"
            f" from (select b.window_s, {EVENT}, l.pos, l.t, l.s, l.link from"
            f" (select * from best where ({ERROR}) is null) b"
            " join final_link l using (window_s, trace_id, link_span_id)"
            f" union all select window_s, {EVENT}, e.key::bigint, {_str('$.traceId', 'e.value')},"
            f" {_str('$.spanId', 'e.value')}, e.value from"
            f" (select * from ded where role = 'ordinary' and ({ERROR}) is null) o,"
            " json_each(o.doc, '$.links') e)"
        ),
    ),
    "otlp_convert_errors": sql(
        "emit",
        select=f"select window_s, {EVENT}, {ERROR} as convert_error from emit where ({ERROR}) is not null",
    ),
    "otlp_payloads": sql(
        "emit",
        select=(
            "select window_s, source, least(4, n - 4 * i) as spans, content_type from ("
            "select window_s, source_log_group as source, count(*) as n, 'application/json' as content_type,"
            f" unnest(range(cast(ceil(count(*) / 4) as bigint))) as i from emit where ({ERROR}) is null group by 1, 2)"
        ),
    ),
    "payload_cuts": sql(
        "emit",
        select=(
            "select window_s, source, byte_chunk, span_chunk, count(*) as spans, cast(sum(b) as bigint) as bytes from"
            f" (select *, (row_number() over (partition by window_s, source, byte_chunk order by {EMISSION}) - 1) // 3 as span_chunk from"
            f" (select *, cast(coalesce(sum(b) over (partition by window_s, source order by {EMISSION}"
            " rows between unbounded preceding and 1 preceding), 0) as bigint) // 40 as byte_chunk from"
            f" (select *, source_log_group as source, strlen(source_event_id) as b from emit where ({ERROR}) is null))) group by all"
        ),
    ),
    "stored_payloads": sql(
        "emit",
        select=(
            f"select window_s, source_log_group as source, {_clean('$.traceId')} as trace_id, {_clean('$.spanId')} as span_id"
            f" from emit where ({ERROR}) is null"
        ),
    ),
    "otlp_payload_fields": sql(
        "conv",
        select=(
            f"select {EVENT}, source_log_group as source, 'application/json' as content_type, trace_id,"
            f" coalesce(nullif({_str('$.name')}, ''), nullif({_str('$._aws.xray.name')}, ''), 'UnnamedSpan') as name,"
            f" cast({_u64('$.endTimeUnixNano')} as varchar) as end_time,"
            f" coalesce({_str('$.scope.version')}, '') as scope_version,"
            f" cast({_keys('$.resource.attributes')} + case when {_type(SERVICE)} is null and ({_str(LOCAL)})"
            " is not null then 1 else 0 end as bigint) as resource_attributes,"
            f" cast({_keys('$.attributes')} as bigint) as attributes,"
            f" cast({_items('$.events')} - case when q = 31 then 1 else 0 end as bigint) as events,"
            f" cast({_items('$.links')} as bigint) as links from conv"
        ),
    ),
    "hex_cleaning": (
        "select event_id, raw, case when regexp_full_match(digits, '([0-9a-fA-F]{2})*') then lower(digits) end as clean"
        " from (select *, regexp_replace(regexp_replace(trim(raw), '^0[xX]', ''), '[:\\-_ \\t\\n\\f\\r]', '', 'g') as digits"
        f" from (select event_id, {HEX_SPELLINGS} as raw from events))"
    ),
    "log_scan": sql(
        "ev",
        select=(
            "select batch_id, row_number() over (partition by batch_id order by arrival_s, arrival_seq) - 1 as pos,"
            " source_event_id, arrival_s as event_timestamp, message from ev"
        ),
    ),
    "partition_summary": sql(
        "parsed",
        select=(
            "select batch_id, count(*) as input_records, count(*) filter (ok) as published_records,"
            " count(*) filter (not ok) as malformed_records,"
            " cast(ceil(count(*) filter (ok) / 500) as bigint) as batches from"
            f" (select batch_id, doc is not null and ({_str('$.traceId')}) is not null as ok from parsed) group by batch_id"
        ),
    ),
    "chunk_500": sql(
        "sent", select=f"select {ROW}, source_event_id, trace_id from sent"
    ),
    "chunk_10": (
        "select user_id, event_id, (rn - 1) // 10 as chunk_index, (rn - 1) % 10 as position from"
        " (select user_id, event_id, row_number() over (partition by user_id order by event_id) as rn from events)"
    ),
    "wrapped_records": sql(
        "rec",
        select=(
            f"select {EVENT}, trace_id as key, '{{\"source_log_group\":' || to_json(source_log_group)"
            " || ',\"source_event_id\":' || to_json(source_event_id) || ',\"trace_id\":' || to_json(trace_id)"
            " || ',\"record\":' || message || '}' as value from rec"
        ),
    ),
    "stored_records": sql(
        "rec",
        select=f"select {EVENT}, trace_id as key, source_log_group, trace_id, {SPAN_ID} as span_id from rec",
    ),
    "decoded_fallbacks": sql(
        "parsed",
        select=(
            "select arrival_seq, case when q % 7 = 0 then case when n % 2 = 1 then 'k-' || source_event_id"
            " else arrival_seq end else source_event_id end as source_event_id,"
            " case when source_log_group = '' then 'aws/spans' else source_log_group end as source_log_group,"
            f" {_str('$.traceId')} as trace_id, {SPAN_ID} as span_id from parsed"
            f" where doc is not null and q <> 11 and ({_str('$.traceId')}) is not null"
        ),
    ),
    "trace_aggregate": sql(
        "ded",
        select=(
            "select window_s as window_start, trace_id, "
            + ", ".join(f"count(*) filter (role = '{role}') as {role}" for role in ROLES)
            + " from ded group by all"
        ),
    ),
    "relay_summary": sql("rec", "ded", "best", "emit", "pend", select=SUMMARY),
    "stream_windows": sql(
        "rec", "ded", "best", "emit", "pend",
        select=SUMMARY,
    ),
    "record_balance": sql(
        "rec", "ded", "best", "emit",
        select=(
            "select *, records - duplicates - decorators - skipped - replaced - emitted - conversion_errors - unplaced as residual from ("
            "select d.window_s as window_start, r.n as records, r.n - d.n as duplicates, d.decorators, d.skipped,"
            " d.targets - coalesce(b.n, 0) as replaced, coalesce(e.good, 0) as emitted, coalesce(e.bad, 0) as conversion_errors, 0 as unplaced from"
            " (select window_s, count(*) as n, count(*) filter (role = 'decorator') as decorators, count(*) filter (role = 'target') as targets,"
            " count(*) filter (role not in ('decorator', 'target', 'ordinary')) as skipped from ded group by 1) d"
            " join (select window_s, count(*) as n from rec group by 1) r using (window_s)"
            " left join (select window_s, count(*) as n from best group by 1) b using (window_s)"
            f" left join (select window_s, count(*) filter (({ERROR}) is null) as good, count(*) filter (({ERROR}) is not null) as bad"
            " from emit group by 1) e using (window_s))"
        ),
    ),
    "two_stage_spans": sql("emit", select="select window_s, trace_id, is_target, source_event_id from emit"),
    "publish_ledger": sql("led", select="select * from led"),
    "publish_summary": sql("led", select=PUBLISHED),
    "retry_subset": sql(
        "led",
        select=f"select {ROW}, source_event_id from led where attempt = 1 and outcome = 'retried'",
    ),
    "recovered_ids": sql(
        "led",
        select=(
            "select distinct source_event_id from led where attempt > 1"
            " group by batch_id, chunk_index, attempt, source_event_id having bool_and(outcome = 'published')"
        ),
    ),
    "retry_plan": sql(
        "led",
        select=(
            "select batch_id, chunk_index, attempt, count(*) as failed_records,"
            " cast(least(200 * (1 << least(attempt - 1, 4)), 2000) as bigint) as base_ms, true as jitter_in_range"
            " from led where outcome = 'retried' group by batch_id, chunk_index, attempt"
        ),
    ),
    "retry_budgets": sql(
        "led",
        select=(
            "select *, budget_ms >= 5000 as again from (select batch_id, chunk_index, attempt, 5000 + 300 * (batch_id % 3)"
            " - cast(sum(cast(least(200 * (1 << least(attempt - 1, 4)), 2000) as bigint))"
            " over (partition by batch_id, chunk_index order by attempt) as bigint) as budget_ms"
            " from (select distinct batch_id, chunk_index, attempt from led where outcome = 'retried'))"
        ),
    ),
    "failed_attempts": sql(
        "led",
        select=f"select {ROW}, source_event_id, attempt, error_code, outcome = 'dead' as stamped from led where outcome <> 'published'",
    ),
    "dead_letters": sql(
        "led", "sent",
        select=(
            "select batch_id, chunk_index, position, 'kinesis_publish_failure' as kind, 'span-stream' as stream_name,"
            " s.trace_id as partition_key, s.source_event_id, s.trace_id, 'aws/spans' as source_log_group,"
            " s.message as record, attempt as attempt_count, error_code as last_error_code,"
            " error_message as last_error_message, (row_number() over (partition by batch_id, chunk_index"
            " order by attempt, position) - 1) // 10 as send_index"
            " from (select * exclude (source_event_id) from led where outcome = 'dead') join sent s"
            " using (batch_id, chunk_index, position)"
        ),
    ),
    "replayed_records": sql(
        "led", "sent",
        select=(
            "select source_event_id, trace_id, count(*) as copies from (select source_event_id, trace_id from sent"
            " union all select s.source_event_id, s.trace_id from sent s semi join"
            " (select * from led where outcome = 'dead') using (batch_id, chunk_index, position)) group by all"
        ),
    ),
    "response_pairs": sql(
        "answer",
        select=(
            f"select {ROW}, source_event_id, case when short then 'UnexpectedResponseRecordCount' else error_code end as error_code,"
            " case when short then 'sent ' || n || ' records, answers: ' || (n - 1)"
            " else 'failed: ' || error_code end as error_message,"
            " short or coalesce(error_code like 'Prov%', false) as retryable from"
            " (select *, (batch_id + chunk_index) % 3 = 0 as short, count(*) over (partition by batch_id, chunk_index) as n"
            " from answer where attempt = 1)"
        ),
    ),
    "request_failures": sql(
        "sent",
        select=(
            f"select {ROW}, source_event_id, 1 as attempt, 'ServiceUnavailable' as error_code,"
            " 'unavailable' as error_message, true as retryable from sent where (batch_id + chunk_index) % 5 = 0"
        ),
    ),
    "stream_reconcile": sql(
        "emit", "final_link", "rec",
        select=(
            f"select e.window_s, e.trace_id, e.is_target, {EVENT}, coalesce(l.links, '') as links from"
            " emit e left join"
            f" (select {EVENT}, b.window_s, true as is_target, string_agg(f.t || ':' || f.s || ':' ||"
            " json_extract_string(f.link, '$.flags'), ',' order by f.pos) as links"
            " from best b join final_link f using (window_s, trace_id, link_span_id) group by all"
            f" union all select {EVENT}, o.window_s, false, string_agg({_str('$.traceId', 'k.value')} || ':' ||"
            f" {_str('$.spanId', 'k.value')} || ':' || json_extract_string(k.value, '$.flags'), ',' order by k.key::int)"
            " from (select * from ded where role = 'ordinary') o, json_each(o.doc, '$.links') k group by all) l"
            f" using ({EVENT}, window_s, is_target)"
        ),
    ),
    "open_window_state": sql(
        "ded",
        select=(
            "select window_s as window_start, count(*) as events, cast(sum(strlen(message)) as bigint) as state_bytes, false as is_final from ded"
            " where window_s + 60 > (select max(arrival_s) from ev) - 300 group by 1"
        ),
    ),
    "relay_metrics": sql(
        "rec", "ded", "best", "emit", "pend",
        select=(
            f"select * from (unpivot (select count(*) as windows, {', '.join(f'cast(sum({c}) as bigint) as {c}' for c in RELAY_COUNTERS)}"
            f" from ({SUMMARY})) on columns(*) into name counter value total), (select 'relay' as stage)"
            " union all select counter, total, 'emit' from (unpivot (select cast(sum(emitted_spans) as bigint) as telemetry_items_count,"
            f" cast(sum(emitted_trace_ids) as bigint) as emitted_trace_ids_count from ({SUMMARY})) on columns(*) into name counter value total)"
        ),
    ),
    "partition_metrics": sql(
        "ev", "rec", "led", "sent",
        select=(
            "select 0 as batch_id, 'aws/spans' as log_group, (select count(*) from ev) as input_records, (select count(*) from rec) as publishable_records,"
            " (select count(*) from ev) - (select count(*) from rec) as malformed_records,"
            " (select count(distinct (batch_id, chunk_index)) from sent) as publish_batches, * rename (published_records as published_to_stream)"
            " from (" + PUBLISHED + ")"
        ),
    ),
    "replayed_once": sql(
        "sent", select="select source_event_id, trace_id, cast(1 as bigint) as copies from sent group by all"
    ),
    "lane_traces": sql(
        "ded",
        select=(
            "select window_s as window_start, trace_id, "
            + ", ".join(f"count(*) filter (role = '{role}') as {role}" for role in ROLES)
            + " from ded group by all"
        ),
    ),
    "lane_from_latest": sql("rec", select="select source_event_id, trace_id from rec where batch_id % 2 = 1"),
}
