"""Exact duplicates by an extendible-hash index on shared files, in DataFrame functions only.

1. Fold. Rows are grouped by hash key and whole normalised text, so copies fall together
   inside every map task before anything is shuffled, and collisions of the key are told
   apart by comparing bytes. What is left, one entry for each different text, is written
   to the shared folder: the store that the index points into.
2. Directory. A bucket is named by the leading bits of its keys. The directory starts
   with as many bits as even hashing needs and doubles while a bucket holds more than
   ``capacity`` entries; only overfull buckets are split and get the longer name.
   Entries that share one whole key cannot be split and stay in one bucket.
3. Owners. Buckets are ranges of keys; each owner task takes some neighbouring ones,
   numbers the entries of equal key as a chain, and writes them in key order. The owners
   carry keys and digests; the texts stay in the store.
4. Lookup. A row goes to its bucket by the directory, to the chain by its key, and to
   the entry by the digest of its bytes.

No step gathers copies: a hot text is one entry, and its rows meet it in a join whose
hot key Spark may split.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanflow.llm.common import discard, stage, text_rows

KEY_BITS = 63
#: Entries that a bucket may hold before it is split.
CAPACITY = 8192

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null is empty. Texts of ASCII alone take the
    faster function, which does the same to them."""
    whole = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(
        F.translate(whole, _UPPER, _LOWER)
    )


def _keyed(docs: DataFrame, bits: int) -> DataFrame:
    rows = text_rows(docs).select("doc_id", normalised(F.col("text")).alias("text"))
    return rows.withColumn("key", F.shiftrightunsigned(F.xxhash64("text"), 64 - bits))


@dataclass
class Index:
    """``entries``: one row for each text, with ``key, text, keep_id, group_size``.
    ``directory``: ``depth, address, bucket``, where ``bucket`` is the first key that the
    bucket may hold. ``buckets``: ``bucket, key, chain, text_sha256, keep_id, group_size``,
    sorted by key in files of the owners' ranges."""

    entries: DataFrame
    directory: DataFrame
    buckets: DataFrame
    depths: list[int]
    bits: int


def _address(depth: int, bits: int) -> Column:
    return F.shiftright("key", bits - depth)


def _directory(keys: DataFrame, capacity: int, bits: int) -> tuple[DataFrame, list[int]]:
    """The buckets by depth. Every round counts the keys of buckets that are overfull."""
    total = keys.count()
    depth = min(bits, max(0, math.ceil(math.log2(max(total, 1) / capacity)) - 1))
    levels, depths = None, []
    while True:
        counts = keys.groupBy(_address(depth, bits).alias("address")).agg(
            F.count(F.lit(1)).alias("entries"), (F.min("key") != F.max("key")).alias("divisible")
        )
        counts = stage(counts, f"level_{depth}")
        overfull = (F.col("entries") > capacity) & F.col("divisible")
        whole = counts.where(~overfull).select(
            F.lit(depth).alias("depth"), "address", F.shiftleft("address", bits - depth).alias("bucket"), "entries"
        )
        levels = whole if levels is None else levels.unionByName(whole)
        depths.append(depth)
        split = counts.where(overfull).select("address")
        if split.isEmpty():
            return stage(levels, "directory"), depths
        keys = stage(
            keys.withColumn("address", _address(depth, bits)).join(split, "address", "left_semi").select("key"), "overfull"
        )
        depth += 1


def _with_bucket(rows: DataFrame, directory: DataFrame, depths: list[int], bits: int) -> DataFrame:
    """Adds ``bucket``; of the key's names at the few depths in use, one is in the directory."""
    names = F.array(*[F.struct(F.lit(d).alias("depth"), _address(d, bits).alias("address")) for d in depths])
    named = rows.withColumn("_name", F.explode(names))
    named = named.select(*rows.columns, F.col("_name.depth").alias("depth"), F.col("_name.address").alias("address"))
    return named.join(directory.select("depth", "address", "bucket"), ["depth", "address"]).drop("depth", "address")


def build_index(docs: DataFrame, capacity: int = CAPACITY, bits: int = KEY_BITS) -> Index:
    """The index over ``doc_id, text`` of ``docs``, on shared files.

    Of equal texts the largest ``doc_id`` is kept; null ids count only where a text has no
    other. ``bits`` below 63 makes collisions, and so chains, likelier.
    """
    folded = _keyed(docs, bits).groupBy("key", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    entries = stage(folded.withColumn("text_sha256", F.sha2("text", 256)), "entries")
    directory, depths = _directory(entries.select("key"), capacity, bits)
    owned = _with_bucket(entries.drop("text"), directory, depths, bits).repartitionByRange("bucket")
    chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("text_sha256"))
    buckets = owned.withColumn("chain", chain).sortWithinPartitions("bucket", "key", "chain")
    return Index(entries, directory, stage(buckets, "buckets"), depths, bits)


def lookup(docs: DataFrame, index: Index) -> DataFrame:
    """``doc_id, keep_id, group_size, text_sha256`` for every row whose text is in the index."""
    rows = _keyed(docs, index.bits).select("doc_id", "key", F.sha2("text", 256).alias("text_sha256"))
    placed = _with_bucket(rows, index.directory, index.depths, index.bits)
    found = index.buckets.select("bucket", "key", "text_sha256", "keep_id", "group_size")
    return placed.join(found, ["bucket", "key", "text_sha256"]).select("doc_id", "keep_id", "group_size", "text_sha256")


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, bits: int = KEY_BITS
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal
    texts the row with the largest id stays. Rows that repeat an id and text are all kept
    or all not; rows without an id are kept where no row of their text has one. Texts of
    any length work, other columns of ``docs`` take no part, and no rows give none.
    """
    two = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    index = build_index(two, capacity, bits)
    discard(index.entries)
    found = lookup(two, index)
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
