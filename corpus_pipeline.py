"""A corpus pipeline: each stage calls one operator on all that the stage before kept.

Quality classifier, MinHash near-duplicates, repeated strings, benchmark
decontamination, packing. A stage takes ``(spark, docs, sf_dir)``; all but the last
return the columns that they got. ``run`` writes each stage's rows to the shared
folder and reads them for the next.

Rows with a null id or text go through all stages like others: a null text has no
words, no repeats and no tokens but the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanflow.llm import gam, packing, positional_index, suffix_buckets, superminhash
from spanflow.llm.common import KEY, stage, text_rows, with_key
from spanflow.llm.queries import table, tokenizer


def _fresh(docs: DataFrame) -> str:
    """A prefix that no column of ``docs`` starts with."""
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in docs.columns), default=0))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the documents named by ``doc_id, key_text`` of ``gone``."""
    mark = _fresh(docs)
    named = gone.select(F.col("doc_id").alias(f"{mark}id"), F.col("key_text").alias(f"{mark}text")).distinct()
    same = docs["doc_id"].cast("bigint").eqNullSafe(named[f"{mark}id"]) & (
        F.xxhash64(docs["text"].cast("string")) == named[f"{mark}text"]
    )
    return docs.join(named, same, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts."""
    scores = gam.quality_scores(docs, table(spark, sf_dir, "labels"))
    return _without(docs, scores.where("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies. Documents without an
    id or without words are in no group and stay; rows that repeat an id stay together."""
    mark = _fresh(docs)
    groups = superminhash.near_duplicate_groups(docs)
    gone = groups.where("doc_id != component_id").select(F.col("doc_id").alias(f"{mark}id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone[f"{mark}id"], "left_anti")


#: Bytes of a repeated string: less than 50 words of any language take.
REPEATED_BYTES, REPEATED_GRAM = 224, 64


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the bytes that strings of ``REPEATED_BYTES`` cover which occur
    elsewhere; a character cut in two goes whole, and ``n_chars`` follows the text."""
    mark = _fresh(docs)
    spans = suffix_buckets.spans_of_texts(with_key(text_rows(docs)), REPEATED_BYTES, REPEATED_GRAM)
    names = [f"{mark}{c}" for c in (*KEY, "spans")]
    keyed = docs.withColumns(
        {names[0]: F.coalesce(docs["doc_id"].cast("bigint"), F.lit(-(2**63))), names[1]: F.xxhash64(docs["text"].cast("string"))}
    )
    joined = keyed.join(spans.toDF(*names), names[:2], "left")
    cut = F.arrow_udf(suffix_buckets.cut_text, "string")
    text = F.when(F.col(names[2]).isNull(), F.col("text")).otherwise(cut(F.col("text").cast("string"), F.col(names[2])))
    done = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(F.col(names[2]).isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return done.select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark window occurs."""
    found = positional_index.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("n_hit > 0"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences and offsets."""
    return packing.packed_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("minhash near-duplicates", near_duplicates),
    ("suffix-array repeats", repeated_strings),
    ("benchmark decontamination", decontaminated),
    ("packing", packed),
]

#: The classifier, the tokenizer and the packing plan have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"stage_{number}")
    return docs
