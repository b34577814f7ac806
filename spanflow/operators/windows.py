"""Tumbling windows and first arrival inside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW_LENGTH = "60 seconds"
ARRIVAL = ["arrival_ts", "arrival_seq"]


def tumbling_window(df: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """Add ``window_start``, the start of the arrival-clock window of each row."""
    return df.withColumn("window_start", F.window("arrival_ts", length)["start"])


def first_arrival(keys: list[str], *best_first: Column) -> Column:
    """Rank 1 for the best row per key; ties go to the earlier arrival.

    A filter on rank 1 lets Spark cut each map task to one row per key before
    the shuffle, so a key that holds much of the data does not flood one task.
    """
    order = list(best_first) + [F.col(c).asc() for c in ARRIVAL]
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def dedupe_events(df: DataFrame) -> DataFrame:
    """Keep the first arrival of each ``source_event_id`` in a window.

    The same id in a later window is new again, and the trace plays no part.
    """
    rank = first_arrival(["window_start", "source_event_id"])
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def dedupe_counts(df: DataFrame) -> DataFrame:
    """Per window: records seen, distinct event ids, duplicates dropped."""
    return (
        df.groupBy("window_start", "source_event_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("window_start")
        .agg(
            F.sum("copies").alias("records"),
            F.count(F.lit(1)).alias("distinct_events"),
        )
        .withColumn("deduped_events", F.col("records") - F.col("distinct_events"))
    )
