"""Near-duplicate vectors by neighbour descent.

Vectors are compared only under one label. Equal vectors form a class with one
representative. The neighbour graph holds for each vector the most similar ones found:

1. It starts from vectors that share a cell of random hyperplanes, in as many tables as
   leave a pair at the threshold apart in all of them with a probability of ``MISS``.
2. In each round a vector's neighbours, in both directions, are compared with one
   another: each is a neighbour's neighbour of the others. Only what is new on at least
   one side is compared. Rounds end when no list with room gains a link.
3. A list whose entries all reach the threshold is saturated: more links may exist than
   it has room for. Lists double until they are not, up to ``LIST_MOST`` entries; a vector
   that is saturated still lies in a dense group, and its list is enlarged to the whole
   label: it is compared with all rows in blocks, which return counts and joining links
   in place of pairs.
4. An audit compares the vectors whose id is divisible by 20 with all rows in blocks. While
   one of them lacks a link, the graph is refined from further tables; a label that still
   lacks one after ``PASSES`` is compared in blocks as a whole. So recall among the audited
   is 1 when the result is returned; what the graph alone found is logged.
5. Entries at or above the threshold, confirmed in double precision, are the links.

Blocks: rows are dealt to parts by a hash of their id, and what is asked for is sent to
every part, so a task holds one part and no data go through the driver. Groups that a task
compares have a bounded number of members: a crowded cell is cut by further hyperplanes, a
crowded neighbourhood is dealt out at random, by another deal in each round; vectors of a
dense group saturate their lists in any deal.

Work grows a little faster than the rows, as the tables do (power 1.2), but for the audit,
which is a twentieth of all pairs of a label, and for dense groups, whose links can only
be counted pair by pair.

Vectors without a label, null, all zero, or with null or non-finite components link with
nothing. Vectors of other length than the one compared with do not link. Rows that
repeat an id share that id's links.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanflow.llm.common import stage
from spanflow.llm.components import connected_components

#: Entries of a list at first and at most, members of a compared group and of a cell.
LIST, LIST_MOST = 10, 40
GROUP = 128
CELL = 32
#: The chance that a pair at the threshold shares no cell; bits of a cell's code.
MISS = 1e-6
CODE = 48
ROUNDS, PASSES = 4, 3
AUDITED = 20
#: Components that a part holds, rows of a part of a small table, rows and columns of a product.
PART_COMPONENTS, PART_ROWS, PARTS = 1 << 21, 1024, 64
ROWS, COLUMNS = 512, 2048
#: Single precision is within this of a cosine.
SLACK = 1e-3
_PAIR = "id bigint, other bigint, sim double"


def usable(vectors: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """``id, label, v``: the vectors that can link, scaled by their largest component, so
    that norms stay within range. The length of a vector is part of its label."""
    rows = vectors.select(
        vectors[vec_id].cast("bigint").alias("id"), vectors[label].cast("string").alias("label"),
        vectors[vector].cast("array<double>").alias("v"),
    ).where("id is not null and label is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("most", F.array_max(F.transform("v", F.abs)))
    # Adding zero makes negative zeros equal to positive ones.
    return rows.select(
        "id", F.concat_ws(":", F.size("v"), "label").alias("label"), F.transform("v", lambda x: x / F.col("most") + 0.0).alias("v")
    )


def classes(rows: DataFrame) -> DataFrame:
    """``id, label, copies, unit``: one representative of equal vectors, of length one,
    padded with zeros to the greatest length there is."""
    longest = rows.agg(F.max(F.size("v")).alias("n")).first().n or 0
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    reps = rows.groupBy("label", "v").agg(F.min("id").alias("id"), F.countDistinct("id").alias("copies"))
    unit = F.concat(F.transform("v", lambda x: x / F.col("norm")), F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("v")))
    return reps.withColumn("norm", norm).select("id", "label", "copies", unit.alias("unit"))


def _matrix(column: pa.Array, dtype=np.float32) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1)


def _linked(one: np.ndarray, two: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``one`` and in ``two`` of all pairs of rows whose product reaches ``least``.

    Single precision decides where its error cannot matter, double precision the rest.
    """
    few, other = one.astype(np.float32), two.astype(np.float32)
    slack = (one.shape[1] + 8) * 2.0**-23
    for a in range(0, len(one), ROWS):
        for b in range(0, len(two), COLUMNS):
            sims = few[a : a + ROWS] @ other[b : b + COLUMNS].T
            i, j = np.nonzero(sims >= least - slack)
            if not len(i):
                continue
            good = sims[i, j] >= least + slack
            i, j = i + a, j + b
            unsure = np.flatnonzero(~good)
            for part in np.array_split(unsure, len(unsure) // 65536 + 1):
                good[part] = np.einsum("ij,ij->i", one[i[part]], two[j[part]]) >= least
            yield i[good], j[good]


def _join(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Joins the sets of ``u`` and ``v``, pair by pair. Each place of ``parent`` holds the
    root of its set, before and after."""
    while True:
        x, y = parent[u], parent[v]
        apart = x != y
        if not apart.any():
            return
        u, v = u[apart], v[apart]
        parent[np.maximum(x, y)[apart]] = np.minimum(x, y)[apart]
        while (parent != (up := parent[parent])).any():
            parent[:] = up


def _by_label(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """Each label with the places of its rows."""
    column = table.column("label")
    coded = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).dictionary_encode()
    codes = coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    ends = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
    for k, label in enumerate(coded.dictionary.to_pylist()):
        yield label, order[ends[k] : ends[k + 1]]


def tables_for(bits: int, least: float) -> int:
    """Tables after which a pair at ``least`` has shared a cell of ``bits`` hyperplanes but
    for a chance of ``MISS``."""
    together = (1 - math.acos(least) / math.pi) ** bits
    return 1 if together >= 1 else math.ceil(math.log(MISS) / math.log1p(-together))


def _codes(tables: int, seed: int):
    """A row for each table: the sides of ``CODE`` hyperplanes on which a vector lies."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("unit"))
            for table in range(tables):
                planes = np.random.default_rng((seed, table)).normal(size=(x.shape[1], CODE)).astype(np.float32)
                sides = (x @ planes > 0) @ (1 << np.arange(CODE, dtype=np.int64))
                yield pa.record_batch(
                    [batch.column("label"), pa.array(np.full(len(x), table, np.int32)), pa.array(sides), batch.column("id"), batch.column("unit")],
                    names=["label", "part", "code", "id", "unit"],
                )

    return code


def _best_of_groups(keep: int, keys: list[str], least: float, besides: int):
    """Within consecutive rows of equal ``keys``, at most ``GROUP``: each member's ``keep``
    best others, but only ``besides`` of them below ``least``.

    With a column ``fresh``, pairs of two members that both are not fresh are left out.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def groups(table: pa.Table, last: bool):
            table = table.combine_chunks()
            size = table.num_rows
            new = np.zeros(size, bool)
            new[:1] = True
            for key in keys:
                values = table.column(key).to_numpy()
                new[1:] |= values[1:] != values[:-1]
            heads = np.append(np.flatnonzero(new), size)
            return table, heads if last else heads[:-1]

        def found(table: pa.Table, heads: np.ndarray) -> pa.RecordBatch:
            ids = table.column("id").to_numpy()
            units = _matrix(table.column("unit").combine_chunks())
            fresh = table.column("fresh").to_numpy() if "fresh" in table.column_names else np.ones(len(ids), bool)
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for a, b in zip(heads[:-1], heads[1:], strict=True):
                for first in range(a, b, GROUP):
                    rows = slice(first, min(first + GROUP, b))
                    own, x, new = ids[rows], units[rows], fresh[rows]
                    if len(own) < 2 or not new.any():
                        continue
                    sims = x @ x.T
                    sims[~(new[:, None] | new[None, :])] = -2
                    sims[own[:, None] == own[None, :]] = -2
                    k = min(keep, len(own) - 1)
                    best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                    best = np.take_along_axis(best, np.argsort(-np.take_along_axis(sims, best, axis=1), axis=1), axis=1)
                    values = np.take_along_axis(sims, best, axis=1)
                    good = (values > -2) & ((values >= least) | (np.arange(k) < besides))
                    out.append((np.repeat(own, k)[good.ravel()], own[best][good], values[good].astype(float)))
            parts = [np.concatenate(p) for p in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            return pa.record_batch([pa.array(p) for p in parts], names=["id", "other", "sim"])

        for batch in batches:
            table = pa.table(batch) if not isinstance(batch, pa.Table) else batch
            held = table if held is None else pa.concat_tables([held, table])
            table, heads = groups(held, last=False)
            if len(heads) > 1:
                yield found(table, heads)
                held = table.slice(int(heads[-1]))
        if held is not None and held.num_rows:
            yield found(*groups(held, last=True))

    return compare


def _top(pairs: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best of each list, each other vector once."""
    once = pairs.groupBy("id", "other").agg(F.max("sim").alias("sim"), F.max("old").alias("old"))
    order = Window.partitionBy("id").orderBy(F.desc("sim"), "other")
    return once.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= keep).drop("_n")


def _compared(rows: DataFrame, keep: int, least: float, besides: int) -> DataFrame:
    """Entries from comparing rows of equal ``group``, in the order of ``deal``."""
    columns = [c for c in ("group", "id", "unit", "fresh") if c in rows.columns]
    return (
        rows.repartition("group").sortWithinPartitions("group", "deal").select(*columns)
        .mapInArrow(_best_of_groups(keep, ["group"], least, besides), _PAIR)
        .withColumn("old", F.lit(False))
    )


def _singles(units: DataFrame) -> DataFrame:
    return units.select("label", "id", F.col("unit").cast("array<float>").alias("unit"))


def _from_cells(units: DataFrame, size: int, seed: int, keep: int, least: float) -> DataFrame:
    """The first graph: in every cell each member's best others."""
    bits = min(CODE, max(0, math.ceil(math.log2(max(size, 1) / CELL))))
    found = _singles(units).mapInArrow(
        _codes(tables_for(bits, least), seed), "label string, part int, code bigint, id bigint, unit array<float>"
    )
    cell = F.xxhash64("label", "part", F.col("code").bitwiseAND((1 << bits) - 1))
    keyed = found.withColumn("cell", cell)
    crowd = keyed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP)
    # A crowded cell is cut by further bits, so that a cut holds about half a group.
    more = crowd.select("cell", F.least(F.ceil(F.log2(F.col("n") * 2 / GROUP)).cast("int"), F.lit(CODE - bits)).alias("more"))
    further = F.shiftright("code", bits).bitwiseAND(F.expr("shiftleft(1L, coalesce(more, 0)) - 1"))
    cut = keyed.join(more, "cell", "left").select(F.xxhash64("cell", further).alias("group"), "id", "unit", F.xxhash64("id", F.lit(seed)).alias("deal"))
    return _compared(cut, keep, least - SLACK, 2)


def _around(graph: DataFrame, units: DataFrame, seed: int, keep: int, least: float) -> DataFrame:
    """New entries from comparing the neighbours of each vector with one another."""
    edges = graph.select("id", "other", (~F.col("old")).alias("fresh"))
    sides = edges.union(edges.select(F.col("other"), F.col("id"), "fresh")).toDF("center", "member", "fresh")
    sides = sides.groupBy("center", "member").agg(F.max("fresh").alias("fresh"))
    degree = sides.groupBy("center").agg(F.count(F.lit(1)).alias("n"), F.max("fresh").alias("any")).where("any").drop("any")
    deal = F.xxhash64("member", F.lit(seed))
    dealt = sides.join(degree, "center").select(
        F.xxhash64("center", F.pmod(deal, F.ceil(F.col("n") * 2 / GROUP))).alias("group"), F.col("member").alias("id"), "fresh", deal.alias("deal")
    )
    return _compared(dealt.join(_singles(units).drop("label"), "id"), keep, least - SLACK, 2)


def neighbour_graph(units: DataFrame, least: float, seed: int, start: DataFrame | None = None) -> DataFrame:
    """``id, other, sim, old, saturated``: lists refined until none with room gains a link.

    A round in which lists are saturated gives them twice the room in the next."""
    size = units.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first().n or 0
    keep, near = LIST, least - SLACK
    found = _from_cells(units, size, seed, LIST_MOST, least)
    graph = stage(_top(found if start is None else found.union(start.select(*found.columns)), keep), "graph")
    for turn in range(ROUNDS):
        wider = min(2 * keep, LIST_MOST)
        known = graph.withColumn("old", F.lit(True))
        graph = stage(_top(_around(graph, units, seed + turn + 1, wider, least).union(known), wider), "graph")
        lists = graph.groupBy("id").agg(
            F.count(F.lit(1)).alias("n"), F.min("sim").alias("worst"), F.count_if((F.col("sim") >= near) & ~F.col("old")).alias("gained")
        )
        keep = wider
        if lists.where((F.col("gained") > 0) & ((F.col("n") < keep) | (F.col("worst") < near))).isEmpty():
            break
    worst = graph.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("worst"))
    full = worst.select("id", ((F.col("n") >= LIST) & (F.col("worst") >= near)).alias("saturated"))
    return graph.join(full, "id")


def _confirmed(pairs: DataFrame, units: DataFrame, least: float) -> DataFrame:
    """Pairs ``low, high`` whose cosine in double precision reaches ``least``."""
    one = pairs.join(units.select(F.col("id").alias("low"), F.col("unit").alias("u")), "low")
    both = one.join(units.select(F.col("id").alias("high"), F.col("unit").alias("w")), "high")
    dot = F.aggregate(F.zip_with("u", "w", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return both.where(dot >= least).select("low", "high")


class _Held:
    """The rows of a part, and what all that was asked of them has shown."""

    def __init__(self, batches: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(batches).combine_chunks()
        self.ids, self.copies = rows["id"].to_numpy(), rows["copies"].to_numpy()
        self.units = _matrix(rows["unit"].combine_chunks(), np.float64)
        self.places = dict(_by_label(rows))
        self.counts, self.parent = np.zeros(len(self.ids), np.int64), np.arange(len(self.ids))

    def ask(self, batch: pa.RecordBatch, least: float) -> pa.RecordBatch:
        """``id, other, n, asked`` for the batch: linked rows with their copies, and one of them."""
        ids, copies = batch.column("id").to_numpy(), batch.column("copies").to_numpy()
        units = _matrix(batch.column("unit"), np.float64)
        counts, one = np.zeros(len(ids), np.int64), np.full(len(ids), -1)
        for label, at in _by_label(batch):
            if label not in self.places:
                continue
            rows = self.places[label]
            for i, j in _linked(units[at], self.units[rows], least):
                i, j = at[i], rows[j]
                apart = ids[i] != self.ids[j]
                i, j = i[apart], j[apart]
                np.add.at(counts, i, self.copies[j])
                np.add.at(self.counts, j, copies[i])
                new = one[i] < 0
                one[i[new]] = j[new]
                _join(self.parent, one[i], j)
        some = np.flatnonzero(counts)
        return self._rows(ids[some], self.ids[one[some]], counts[some], True)

    def told(self) -> pa.RecordBatch:
        """The same for the rows of the part: how much of what was asked links with each."""
        low = np.flatnonzero((self.counts > 0) | (self.parent != np.arange(len(self.parent))))
        return self._rows(self.ids[low], self.ids[self.parent[low]], self.counts[low], False)

    @staticmethod
    def _rows(ids, others, counts, asked) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(ids, pa.int64()), pa.array(others, pa.int64()), pa.array(counts, pa.int64()), pa.array(np.full(len(ids), asked))],
            names=["id", "other", "n", "asked"],
        )


def met(units: DataFrame, asked: DataFrame, least: float) -> DataFrame:
    """``id, other, n, asked``: all of ``asked`` compared with all of ``units`` of their
    label. ``n`` adds up to the linked rows of an asked vector, and to the linked asked
    vectors of a row, copies counted; the pairs ``id, other`` join what the links join."""
    size = units.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("unit")).alias("components")).first()
    parts = max(math.ceil((size.components or 0) / PART_COMPONENTS), min(PARTS, math.ceil(size.n / PART_ROWS)), 1)
    columns = ["part", "is_asked", "id", "label", "copies", "unit"]
    laid = units.withColumns({"part": F.pmod(F.xxhash64("id", F.lit(5)), F.lit(parts)).cast("int"), "is_asked": F.lit(False)}).select(*columns)
    sent = asked.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), "is_asked": F.lit(True)}).select(*columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, held = None, [], None
        for batch in batches:
            part, question = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "is_asked"))
            edges = np.flatnonzero((np.diff(part) != 0) | (question[1:] != question[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if a == b:
                    continue
                if part[a] != number:
                    if held is not None:
                        yield held.told()
                    number, waiting, held = part[a], [], None
                if not question[a]:
                    waiting.append(batch.slice(a, b - a))
                elif waiting or held is not None:
                    if held is None:
                        held, waiting = _Held(waiting), []
                    yield held.ask(batch.slice(a, b - a), least)
        if held is not None:
            yield held.told()

    both = laid.union(sent).repartition("part").sortWithinPartitions("part", "is_asked")
    return both.mapInArrow(compare, "id bigint, other bigint, n bigint, asked boolean")


def representative_links(units: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """``id, listed`` with the linked vectors of each representative, copies counted, and
    ``low, high``, links enough to join what the links join."""
    audit = stage(met(units, units.where(F.col("id") % AUDITED == 0), least), "audit")
    true = stage(audit.where("asked").groupBy("id").agg(F.sum("n").alias("linked")), "audited")
    audited = units.where(F.col("id") % AUDITED == 0).select("id", "label").join(true, "id", "left")
    graph, lacking = None, None
    for number in range(PASSES):
        graph = stage(neighbour_graph(units, least, 17 + 100 * number, graph), "neighbours")
        near = graph.where(F.col("sim") >= least - SLACK)
        pairs = near.select(F.least("id", "other").alias("low"), F.greatest("id", "other").alias("high")).distinct()
        links = stage(_confirmed(pairs, units, least), "links")
        dense = graph.where("saturated").select("id").distinct()
        both = links.union(links.select("high", "low")).toDF("id", "other")
        listed = both.join(units.select(F.col("id").alias("other"), "copies"), "other").groupBy("id").agg(F.sum("copies").alias("listed"))
        seen = audited.join(dense, "id", "left_anti").join(listed, "id", "left").select(
            "label", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("listed", F.lit(0)).alias("listed")
        )
        seen = stage(seen, "seen")
        sums = seen.agg(F.sum("linked").alias("linked"), F.sum(F.least("linked", "listed")).alias("listed")).first()
        if sums.linked:
            logging.getLogger(__name__).info("neighbour graph %d: recall %.6f", number, sums.listed / sums.linked)
        lacking = seen.where("listed < linked").select("label").distinct()
        if lacking.isEmpty():
            break
    whole = units.join(lacking, "label", "left_semi").select("id")
    asked = stage(units.join(dense.union(whole).distinct(), "id", "left_semi"), "asked")
    blocks = stage(met(units, asked, least), "blocks")
    # Dense vectors and audited ones have their counts from blocks. Others add what blocks
    # told them of dense vectors to the links of their lists with vectors that are not.
    by_block = blocks.where("asked").groupBy("id").agg(F.sum("n").alias("listed")).unionByName(
        true.join(asked.select("id"), "id", "left_anti").withColumnRenamed("linked", "listed")
    )
    told = blocks.where("not asked").select("id", "n")
    plain = both.join(asked.select(F.col("id").alias("other")), "other", "left_anti")
    plain = plain.join(units.select(F.col("id").alias("other"), "copies"), "other").select("id", F.col("copies").alias("n"))
    known = asked.select("id").union(units.where(F.col("id") % AUDITED == 0).select("id")).distinct()
    rest = told.union(plain).groupBy("id").agg(F.sum("n").alias("listed")).join(known, "id", "left_anti")
    joining = links.union(audit.select("id", "other")).union(blocks.select("id", "other"))
    return by_block.unionByName(rest).withColumn("listed", F.col("listed").cast("bigint")), joining


def linked_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.93
) -> DataFrame:
    """``vec_id, n_links, component_id`` for every row of ``vectors``."""
    rows = stage(usable(vectors, vec_id, vector, label), "usable")
    units = stage(classes(rows), "units")
    listed, joining = representative_links(units, least)
    groups = stage(connected_components(joining, "low", "high"), "groups")
    counts = stage(listed, "counts")
    copies = rows.select("id", "label", "v").distinct().join(
        rows.groupBy("label", "v").agg(F.min("id").alias("rep"), F.countDistinct("id").alias("copies")), ["label", "v"]
    ).select("id", "rep", "copies")
    own = (
        copies.join(counts.select(F.col("id").alias("rep"), "listed"), "rep", "left")
        .join(groups.select(F.col("id").alias("rep"), "component"), "rep", "left")
        .groupBy("id").agg(
            F.sum(F.coalesce("listed", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
            F.min(F.coalesce("component", "rep")).alias("component_id"),
        )
    )
    all_ids = vectors.select(vectors[vec_id].cast("bigint").alias("vec_id"))
    return all_ids.join(own, all_ids["vec_id"] == own["id"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
