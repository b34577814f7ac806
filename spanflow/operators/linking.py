"""Targets, decorators and the join that brings their links together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanflow.functions.json import only_fields, strict_array
from spanflow.functions.links import (
    link_key,
    link_span_id,
    link_trace_id,
    sort_links,
    union_links,
)
from spanflow.functions.records import (
    ROLE_DECORATOR,
    ROLE_ORDINARY,
    ROLE_TARGET,
    classify_record,
    decorator_target_span_id,
    record_richness,
    span_id_of_record,
)
from spanflow.operators.windows import ARRIVAL, first_arrival

LINK_KEYS = ["window_start", "trace_id", "link_span_id"]


def with_roles(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Add the role and what each role needs later, and drop what it does not.

    ``link_span_id``  span a target offers, or a decorator asks for
    ``richness``      targets only
    ``links``         decorators only: the whole ``$.links`` value
    ``record``        kept for records that can be emitted, null otherwise; with ``keep``
                      only these fields of it, so that no more is shuffled or stored

    All of it is row-local, so it runs before any shuffle and the shuffle
    carries no record that can never come out again.
    """
    record, role = F.col("record"), F.col("role")
    kept = record if keep is None else only_fields(record, keep)
    return records.withColumn("role", classify_record(record)).withColumns(
        {
            "link_span_id": F.when(role == ROLE_TARGET, span_id_of_record(record)).when(
                role == ROLE_DECORATOR, decorator_target_span_id(record)
            ),
            "richness": F.when(role == ROLE_TARGET, record_richness(record)),
            "links": F.when(
                role == ROLE_DECORATOR,
                F.coalesce(
                    F.try_variant_get(record, "$.links", "variant"),
                    F.try_parse_json(F.lit("[]")),
                ),
            ),
            "record": F.when(role.isin(ROLE_TARGET, ROLE_ORDINARY), kept),
        }
    )


def without_records(events: DataFrame) -> DataFrame:
    """Events of ``with_roles`` that know whether they can be ``emitted``, in place of the record."""
    return events.withColumn("emitted", F.when(F.col("record").isNotNull(), True)).drop("record")


def _shape(events: DataFrame, record: bool, key: bool, richness: bool, links: bool) -> Column:
    """Which role-specific columns are filled.

    Each role has its own pattern. Testing the whole pattern, not just the role,
    makes all three branches read the same columns, so Spark shuffles the
    deduplicated events once and reuses that exchange for every branch. The tests
    of the window and of texts hold for every record that has a window and are there for the
    same reason.
    """
    test, whole = F.col("window_start").isNotNull(), "record" in events.columns
    for name in ["trace_id", "source_log_group", *([] if whole else ["convert_error"])]:
        test &= F.length(F.coalesce(F.col(name), F.lit(""))) >= 0
    for name, filled in [
        ("record" if whole else "emitted", record),
        ("link_span_id", key),
        ("richness", richness),
        ("links", links),
    ]:
        test &= F.col(name).isNotNull() if filled else F.col(name).isNull()
    return test


def ordinary_spans(events: DataFrame) -> DataFrame:
    return events.where(_shape(events, True, False, False, False))


def target_spans(events: DataFrame) -> DataFrame:
    return events.where(_shape(events, True, True, True, False))


def decorators(events: DataFrame) -> DataFrame:
    return events.where(_shape(events, False, True, False, True))


def best_target(targets: DataFrame) -> DataFrame:
    """One target per window, trace and span: the richest, then the earliest."""
    rank = first_arrival(LINK_KEYS, F.col("richness").desc())
    return targets.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def pending_links(found: DataFrame) -> DataFrame:
    """Per window, trace and asked-for span: normalized links and decorator count.

    Links are de-duplicated as rows, with map-side partial results, before they
    are gathered, so one popular span costs its distinct links and no more.
    """
    array = F.filter(
        strict_array(F.col("links"), "$"),
        lambda link: link_trace_id(link).isNotNull() & link_span_id(link).isNotNull(),
    )
    rows = found.select(
        *LINK_KEYS, *ARRIVAL, F.posexplode_outer(array).alias("pos", "link")
    )
    trace, span = link_trace_id(F.col("link")), link_span_id(F.col("link"))
    first = F.struct(trace.alias("t"), span.alias("s"), *ARRIVAL, F.col("pos"))
    distinct = (
        rows.withColumn("first", first)
        .withColumn("link_key", link_key(trace, span))
        .groupBy(*LINK_KEYS, "link_key")
        .agg(
            F.min_by("link", "first").alias("link"),
            # The first row of each decorator stands for the decorator itself.
            F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("decorators"),
        )
    )
    return distinct.groupBy(*LINK_KEYS).agg(
        sort_links(F.collect_list("link")).alias("pending_links"),
        F.sum("decorators").alias("decorator_records"),
    )


def link_merge_join(targets: DataFrame, pending: DataFrame) -> DataFrame:
    """Targets left-joined to their pending links.

    ``merged_links`` is null where no decorator matched: such a target keeps its
    own links as they are, not even normalized. Targets without records get none.
    """
    if "record" not in targets.columns:
        return targets.join(pending, LINK_KEYS, "left")
    own = strict_array(F.col("record"), "$.links")
    return targets.join(pending, LINK_KEYS, "left").withColumn(
        "merged_links",
        F.when(
            F.col("decorator_records").isNotNull(),
            union_links(own, F.col("pending_links")),
        ),
    )


def unlinked_targets(targets: DataFrame, pending: DataFrame) -> DataFrame:
    return targets.join(pending, LINK_KEYS, "left_anti")


def late_decorators(pending: DataFrame, targets: DataFrame) -> DataFrame:
    """Per window: decorator records whose target never came.

    Only the distinct keys of the targets meet the join, so copies of one target
    do not pile up in one partition.
    """
    offered = targets.select(*LINK_KEYS).distinct()
    return (
        pending.join(offered, LINK_KEYS, "left_anti")
        .groupBy("window_start")
        .agg(F.sum("decorator_records").alias("late_decorators_dropped"))
    )
