"""The keyed lane as a bucketed table, so that work per trace reads it without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanflow.operators.staging import work_dir, written
from spanflow.plans.metrics import ROLES

BUCKETS = 64
# Rows of a trace that one bucket may hold; a larger trace is cut into slices.
HOT_TRACE = 1_000_000
WHOLE = -1


def write_lane(events: DataFrame, name: str, path: str, buckets: int = BUCKETS, hot: int = HOT_TRACE) -> DataFrame:
    """Events with ``trace_id`` and ``source_event_id`` as table ``name`` below ``path``.

    The table is bucketed by trace and ``slice`` and sorted by trace. A trace of more than
    ``hot`` rows is dealt to slices by event; all others are whole, in slice -1. There are
    at most as many hot traces as the rows fill ``hot`` times over, so Spark can broadcast
    their list, and where it does not, only they are split in the join. The events are
    written once before they are counted and dealt, not made twice.
    """
    events = written(events, work_dir(events.sparkSession))
    counts = events.groupBy("trace_id").agg(F.count(F.lit(1)).alias("_n"))
    large = counts.where(F.col("_n") > hot).select("trace_id", F.ceil(F.col("_n") / hot).alias("_slices"))
    number = F.pmod(F.xxhash64("source_event_id"), F.col("_slices")).cast("int")
    sliced = events.join(large, "trace_id", "left").withColumn("slice", F.coalesce(number, F.lit(WHOLE))).drop("_slices")
    (
        sliced.repartition(buckets, "trace_id", "slice")
        .write.bucketBy(buckets, "trace_id", "slice").sortBy("trace_id")
        .option("path", path).mode("overwrite").saveAsTable(name)
    )
    return events.sparkSession.table(name)


def lane_trace_aggregate(spark: SparkSession, name: str) -> DataFrame:
    """``trace_aggregate`` of a lane's events, which have a ``window_start`` and a ``role``.

    Whole traces are counted in their bucket. The slices of a hot trace are too, and only
    the counts of each slice are shuffled to be added up.
    """
    lane, keys = spark.table(name), ["window_start", "trace_id"]
    counts = [F.count_if(F.col("role") == role).alias(role) for role in ROLES]
    whole = lane.where(F.col("slice") == WHOLE).groupBy(*keys, "slice").agg(*counts).drop("slice")
    parts = lane.where(F.col("slice") != WHOLE).groupBy(*keys, "slice").agg(*counts)
    hot = parts.groupBy(*keys).agg(*[F.sum(role).alias(role) for role in ROLES])
    return whole.unionByName(hot)

