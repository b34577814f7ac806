"""Span links: ordering, de-duplication and union, all inside one array value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanflow.functions.json import let, strict_str

EMPTY_LINKS = "array<variant>"


def link_trace_id(link: Column) -> Column:
    return strict_str(link, "$.traceId")


def link_span_id(link: Column) -> Column:
    return strict_str(link, "$.spanId")


def link_key(trace_id: Column, span_id: Column) -> Column:
    """Identity of a link: the two raw id texts, joined by a colon."""
    return F.concat(trace_id, F.lit(":"), span_id)


def empty_links() -> Column:
    return F.array().cast(EMPTY_LINKS)


def sort_links(links: Column) -> Column:
    """Links with two text ids, stably sorted by trace id and span id (byte order).

    VARIANT has no order, so positions are sorted and the links fetched by them.
    """

    def positions(array: Column) -> Column:
        tagged = F.transform(
            array,
            lambda link, i: F.struct(
                link_trace_id(link).alias("t"),
                link_span_id(link).alias("s"),
                i.alias("i"),
            ),
        )
        return F.sort_array(
            F.filter(tagged, lambda e: e["t"].isNotNull() & e["s"].isNotNull())
        )

    return let(
        links,
        lambda array: F.transform(positions(array), lambda e: F.get(array, e["i"])),
    )


def normalize_links(links: Column) -> Column:
    """Sort as ``sort_links`` and keep the first link of each ``link_key``."""

    def keyed(array: Column) -> Column:
        def tag(link: Column, i: Column) -> Column:
            trace, span = link_trace_id(link), link_span_id(link)
            return F.struct(
                link_key(trace, span).alias("k"),
                trace.alias("t"),
                span.alias("s"),
                i.alias("i"),
            )

        return F.sort_array(
            F.filter(F.transform(array, tag), lambda e: e["k"].isNotNull())
        )

    def firsts(entries: Column) -> Column:
        return F.filter(
            entries,
            lambda e, i: (i == 0) | (F.get(entries, i - 1)["k"] != e["k"]),
        )

    def ordered(entries: Column) -> Column:
        return F.sort_array(
            F.transform(entries, lambda e: F.struct(e["t"], e["s"], e["i"]))
        )

    return let(
        links,
        lambda array: F.transform(
            ordered(let(keyed(array), firsts)), lambda e: F.get(array, e["i"])
        ),
    )


def union_links(existing: Column, pending: Column) -> Column:
    """Existing links first, then pending ones, normalized."""
    none = empty_links()
    return normalize_links(
        F.concat(F.coalesce(existing, none), F.coalesce(pending, none))
    )
