"""Fields, flags and the role of one span record (VARIANT in, scalar out)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanflow.functions.json import (
    field,
    strict_array,
    strict_object,
    strict_str,
    strict_true,
)
from spanflow.functions.patterns import DEFAULT_PATTERN, filter_pattern

# Record fields and marker texts of the span log format.
SERVICE_NAME = "service.name"
LOCAL_SERVICE = "aws.local.service"
DECORATOR_TYPE = "managed_link"
DEFAULT_LOG_GROUP = "aws/spans"

ROLE_DECORATOR = "decorator"
ROLE_DECORATOR_NO_TARGET = "decorator_no_target"
ROLE_INCOMPLETE = "incomplete"
ROLE_TARGET = "target"
ROLE_TARGET_NO_SPAN = "target_no_span"
ROLE_ORDINARY = "ordinary"


def trace_id_of_record(record: Column) -> Column:
    return strict_str(record, "$.traceId")


def span_id_of_record(record: Column) -> Column:
    return strict_str(record, "$.spanId")


def is_completed_span(record: Column) -> Column:
    """The end time is there and not JSON null, whatever its type."""
    end = field(record, "$.endTimeUnixNano")
    return end.isNotNull() & ~F.coalesce(F.is_variant_null(end), F.lit(False))


def is_linkable_target(record: Column) -> Column:
    return strict_true(record, "$._aws.xray.linking") | strict_true(
        record, "$.attributes['aws.internal'].linking"
    )


def is_managed_link_decorator(record: Column) -> Column:
    return F.coalesce(
        strict_str(record, "$._aws.xray.decorator_type") == DECORATOR_TYPE,
        F.lit(False),
    )


def decorator_target_span_id(record: Column) -> Column:
    return strict_str(record, "$._aws.xray.target_id")


def decorator_links(record: Column) -> Column:
    """The links array; empty when absent or of another type."""
    return F.coalesce(
        strict_array(record, "$.links"), F.array().cast("array<variant>")
    )


def record_richness(record: Column) -> Column:
    """How much a record carries: attributes, resource attributes, links, events."""
    sizes = [
        F.size(strict_object(record, "$.attributes")),
        F.size(strict_object(record, "$.resource.attributes")),
        F.size(strict_array(record, "$.links")),
        F.size(strict_array(record, "$.events")),
    ]
    # size() of null is null in ANSI mode and -1 in legacy mode; both count 0.
    total = F.lit(0)
    for size in sizes:
        total = total + F.greatest(F.coalesce(size, F.lit(0)), F.lit(0))
    return total


def subscription_filter(record: Column, pattern: str = DEFAULT_PATTERN) -> Column:
    """Whether a filter pattern lets the record through. The default one does so for spans
    of a known service that are not in progress, and for link decorators."""
    return filter_pattern(pattern)(record)


def classify_record(record: Column) -> Column:
    """Role of a record; the decorator test comes before all others."""
    decorator = F.when(
        decorator_target_span_id(record).isNull(), ROLE_DECORATOR_NO_TARGET
    ).otherwise(ROLE_DECORATOR)
    target = F.when(
        span_id_of_record(record).isNull(), ROLE_TARGET_NO_SPAN
    ).otherwise(ROLE_TARGET)
    return (
        F.when(is_managed_link_decorator(record), decorator)
        .when(~is_completed_span(record), ROLE_INCOMPLETE)
        .when(is_linkable_target(record), target)
        .otherwise(ROLE_ORDINARY)
    )
