"""Benchmark decontamination over a distributed positional inverted index.

Only DataFrame expressions: no Python runs on the rows.

1. Corpus counts of every term that occurs in the benchmark, over all documents.
2. Each test window (consecutive words of an item) is looked up by its two rarest terms
   by these counts, and their offsets in the window; a window of one word by that word twice.
3. The index stores a posting for every occurrence of such a term in the corpus: term,
   document and position. Those of a window's rarest term also hold the terms around it,
   as far as any window can reach. Very frequent terms cost nothing unless a window has
   no two rarer ones.
4. The lists are intersected at their offsets: a posting of a rarest term asks once for
   each distance that a second term may have, fewer than two windows' lengths, and not
   once for each window; only what meets a posting there is looked up among the windows.
5. What is left is compared with the other terms in place, which makes an exact phrase
   match; all of them within ``slop`` places of theirs, whatever their order, make a
   proximity match.

The tables of test terms and windows are broadcast only when their counted rows stay
under a bound; else they are shuffled, and Spark splits keys that are too large.
A null or empty text has no words. Items or documents without words match nothing.
Repeated items count once each by their id; repeated documents get equal rows. Equally
rare terms are taken by name, then offset. A very long text is one row with one array of
its words. Of both tables only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanflow.llm.common import KEY, discard, stage, text_rows, with_key

#: What separates words: all ASCII but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of a test-side table that may be broadcast (under 100 bytes each).
BROADCAST_ROWS = 200_000


def terms(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null has none."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), upper, lower), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def _hinted(frame: DataFrame, rows: int, bound: int) -> DataFrame:
    return F.broadcast(frame) if rows <= bound else frame


def test_windows(items: DataFrame, width: int) -> DataFrame:
    """``window_id, words, item_ids`` of the distinct windows of all items.

    An item with fewer words than ``width``, but not none, is one window.
    """
    last = F.greatest(F.size("words") - width, F.lit(0))
    return (
        items.withColumn("words", terms(F.col("text"))).where(F.size("words") > 0)
        .select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        .select("item_id", F.slice("words", F.col("at") + 1, F.lit(width)).alias("words"))
        .distinct()
        .groupBy("words").agg(F.collect_set("item_id").alias("item_ids"))
        .withColumn("window_id", F.xxhash64("words"))
    )


def build_index(
    keyed: DataFrame, windows: DataFrame, width: int, bound: int, slop: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Postings of the windows' two rarest terms, and the windows with them: ``first``
    at ``offset`` in the window, and ``second``, ``gap`` places after it."""
    vocabulary = windows.select(F.explode("words").alias("term")).distinct()
    size = vocabulary.count()
    occurrences = keyed.select(F.explode(terms(F.col("text"))).alias("term"))
    counts = occurrences.join(_hinted(vocabulary, size, bound), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(vocabulary.join(counts, "term", "left").fillna(0, ["n"]), "term_counts")
    ranked = (
        windows.select("window_id", "words", F.posexplode("words").alias("offset", "term"))
        .join(counts, "term")
        .groupBy("window_id", "words").agg(F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("rarest"))
        .select("window_id", "words", F.get("rarest", F.lit(0)).alias("a"), F.coalesce(F.get("rarest", F.lit(1)), F.get("rarest", F.lit(0))).alias("b"))
        .where("a.n > 0")
    )
    probes = stage(
        ranked.select(
            "window_id", "words", F.col("a.term").alias("first"), F.col("a.offset").alias("offset"),
            F.col("b.term").alias("second"), (F.col("b.offset") - F.col("a.offset")).alias("gap"),
        ),
        "probes",
    )
    wanted = (
        probes.select(F.col("first").alias("term"), F.lit(True).alias("leads"))
        .union(probes.select("second", F.lit(False)))
        .groupBy("term").agg(F.max("leads").alias("leads"))
    )
    reach = width - 1 + slop
    before = F.greatest(F.col("position") - reach, F.lit(0))
    postings = (
        keyed.select(*KEY, terms(F.col("text")).alias("words"))
        .select(*KEY, "words", F.posexplode("words").alias("position", "term"))
        .join(_hinted(wanted, size, bound), "term")
        .select(
            "term", *KEY, "position", "leads", before.alias("around_from"),
            F.when(F.col("leads"), F.slice("words", before + 1, F.lit(2 * reach + 1))).alias("around"),
        )
    )
    return stage(postings, "postings"), probes


def candidates(postings: DataFrame, probes: DataFrame, bound: int, slop: int = 0) -> DataFrame:
    """``key_id, key_text, position, window_id``: postings of a window's rarest term that
    have one of its second term at the distance between them, or ``slop`` places off it."""
    rows = probes.count()
    gaps = F.transform(F.sequence(F.lit(-slop), F.lit(slop)), lambda off: F.col("gap") + off) if slop else F.array("gap")
    pairs = probes.select(F.col("first").alias("term"), "second", "window_id", F.explode(gaps).alias("gap"))
    pair_rows = rows * (2 * slop + 1)
    asked = (
        postings.where("leads").select(*KEY, "position", "term")
        .join(_hinted(pairs.select("term", "gap").distinct(), pair_rows, bound), "term")
        .withColumn("at", F.col("position") + F.col("gap"))
    )
    # One posting stands at a place; repeated documents bring it several times.
    second = postings.select(*KEY, F.col("position").alias("at"), F.col("term").alias("second")).dropDuplicates([*KEY, "at"])
    return (
        asked.join(second, [*KEY, "at"])
        .join(_hinted(pairs, pair_rows, bound), ["term", "gap", "second"])
        .select(*KEY, "position", "window_id").distinct()
    )


def matches(postings: DataFrame, probes: DataFrame, bound: int, slop: int | None = None) -> DataFrame:
    """``key_id, key_text, start, length, window_id``: places where a window stands.

    Without ``slop``, exact phrases. With it, every term of the window must stand
    within ``slop`` places of where the rarest term's posting puts it.
    """
    wanted = probes.select("window_id", F.col("words").alias("wanted"), "offset")
    met = (
        candidates(postings, probes, bound, slop or 0)
        .join(postings.where("leads").select(*KEY, "position", "around_from", "around"), [*KEY, "position"])
        .join(_hinted(wanted, probes.count(), bound), "window_id")
    )
    start = F.col("position") - F.col("offset")
    first = start - F.col("around_from") + 1  # counted from 1, within what stands around
    if slop is None:
        fits = (start >= 0) & (F.slice("around", F.greatest(first, F.lit(1)), F.size("wanted")) == F.col("wanted"))
    else:
        places = F.transform("wanted", lambda w, i: F.exists(
            F.slice("around", F.greatest(first + i - slop, F.lit(1)), F.greatest(F.least(first + i + slop, F.size("around")) - F.greatest(first + i - slop, F.lit(1)) + 1, F.lit(0))),
            lambda x: x == w,
        ))
        fits = F.forall(places, lambda p: p)
    return met.where(fits).select(
        *KEY, F.greatest(start, F.lit(0)).alias("start"), F.size("wanted").alias("length"), "window_id"
    )


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", width: int = 10, slop: int | None = None, bound: int = BROADCAST_ROWS,
) -> DataFrame:
    """``doc_id, key_text, n_words, n_hit, item_ids`` for every row of ``docs``.

    ``n_hit`` counts the words inside any match; ``item_ids`` are the ids, as strings in
    ascending order, of the items with a matching window, null ids left out.
    """
    keyed = with_key(text_rows(docs, doc_id, text))
    tests = items.select(items[item_id].cast("string").alias("item_id"), items[item_text].cast("string").alias("text"))
    windows = stage(test_windows(tests, width), "windows")
    postings, probes = build_index(keyed, windows, width, bound, slop or 0)
    # Repeated rows give equal postings, hence distinct.
    found = stage(matches(postings, probes, bound, slop).distinct(), "matches")
    discard(postings)
    covered = found.select(
        *KEY, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("word")
    ).distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_hit"))
    items_of = (
        found.select(*KEY, "window_id").distinct()
        .join(windows.select("window_id", F.explode("item_ids").alias("item_id")), "window_id")
        .groupBy(*KEY).agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    sizes = keyed.select("doc_id", *KEY, F.size(terms(F.col("text"))).cast("bigint").alias("n_words"))
    return (
        sizes.join(covered.join(items_of, KEY, "left"), KEY, "left")
        .select("doc_id", "key_text", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
    )
