"""What the operators share: the staging folder, row keys, Arrow text access."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a task holds in working arrays at once (about 40 bytes of arrays each).
SLICE_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, a folder of the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stages"


#: Lets Spark remove the shuffle files of a query when the query ends.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written once to the shared folder and read back: work is done
    once, and a lost executor costs a read, not the lineage. Its shuffle files go
    as soon as it is written."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/spanflow-{uuid.uuid4().hex}/{name}"
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)
    read = spark.read.schema(frame.schema).parquet(path)
    read.staged_at = path
    return read


def discard(frame: DataFrame) -> None:
    """Removes what ``stage`` wrote for ``frame``, when all that follows from it is written."""
    jvm = frame.sparkSession.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(frame.staged_at)
    folder.getFileSystem(frame.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def text_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator works on, so that other columns cannot clash."""
    return docs.select(
        docs[doc_id].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text")
    )


def with_key(rows: DataFrame) -> DataFrame:
    """Adds ``key_id`` and ``key_text``, never null: together they name a document
    even where ids are null or two texts share one id."""
    return rows.withColumns(
        {"key_id": F.coalesce("doc_id", F.lit(-(2**63))), "key_text": F.xxhash64("text")}
    )


KEY = ["key_id", "key_text"]


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's text leaves that remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string array, without a copy; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds at most ``SLICE_BYTES`` of text, or one row."""
    for batch in batches:
        _, at = utf8(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(at, at[first] + SLICE_BYTES, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def segments(
    batches: Iterator[pa.RecordBatch], overlap: int, most: int = SLICE_BYTES // 2, text: str = "text"
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Pieces of texts for work on windows: row numbers, bytes, offsets, each piece's
    place in its text, and the batch. A text longer than ``most`` is cut into pieces of
    that length plus ``overlap`` bytes, so that memory does not grow with a text."""
    for batch in batches:
        raw, at = utf8(batch.column(text))
        rows, parts, places, size = [], [], [], 0

        def gathered():
            ends = np.cumsum([0] + [len(p) for p in parts])
            return np.array(rows, np.int64), np.concatenate(parts), ends, np.array(places, np.int64), batch  # noqa: B023

        for i in range(batch.num_rows):
            own = raw[at[i] : at[i + 1]]
            for place in range(0, max(len(own), 1), most):
                if place and place + overlap >= len(own):
                    break
                piece = own[place : place + most + overlap]
                if size and size + len(piece) > most:
                    yield gathered()
                    rows, parts, places, size = [], [], [], 0
                rows.append(i)
                parts.append(piece)
                places.append(place)
                size += len(piece)
        if rows:
            yield gathered()
