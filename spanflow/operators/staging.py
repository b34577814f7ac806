"""Tables written to the shared folder on the way."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """A fresh folder under the cluster's shared checkpoint folder, or its warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir", "spark-warehouse"
    )
    return os.path.join(shared, f"run-{uuid.uuid4().hex}")


def written(frame: DataFrame, path: str) -> DataFrame:
    """``frame`` written below ``path`` and read back: work is done once, and what follows
    reads the same rows however often a task is repeated. The owner of the folder clears it.
    Span texts repeat a lot, and zstd leaves about half of what the default codec does."""
    frame.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Remove a table of ``written`` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
