"""N-gram Jaccard join: rare-first prefix filtering over sets of word n-grams.

A document's set holds its distinct n-grams of ``size`` words (with fewer words the whole
sequence as one). Two sets link when 100 * intersection >= percent * union.

1. *Classes.* Documents with equal sets are one class, named by a 64-bit digest of the set;
   exact copies, however many, go on as one.
2. *Rare first.* N-grams are ordered by their frequency over all documents, rarest first,
   ties by hash. The frequency is a count in one of 2**20 cells by hash (a table of fixed
   size, so it may be broadcast); n-grams that share a cell count together, which can only
   change the order, and any common order gives exact results.
3. *Prefix filter.* Sets of n with a partner share an n-gram among their first
   n - ceil(percent * n / 100) + 1. Only these rows are exchanged by n-gram; a streamed pass over
   the sorted rows drops n-grams of one class. Copies within a task are sent once.
4. *Candidates.* Rows of one n-gram are joined under the length filter (sizes within the
   percentage), the positional filter (what stands behind the shared place must suffice) and, once per
   pair, the suffix filter (the sets, cut at 64 fixed pivots of the hash range, can overlap at most
   by the smaller count of each part).
5. *Verification* on the whole sets of both classes, once per pair of a round. Only the texts of
   candidates make sets again.

Groups of near copies may be a third of the table, so pairs are not all written out: the
first rounds pair every class with one leader of its n-gram, and the classes linked so far
become one label. The last step deals the classes of each label to blocks of bounded size and
compares a class with whole blocks of other labels, leaving out the commonest label of an
n-gram with itself; one link with a block is enough. Every pair that could link is thus verified or
already connected, so the components are exact. ``near_links`` returns all linked pairs of
classes instead, and is as large as they are.

Defined results: null and empty texts and texts of white space have an empty set and link
with nothing; a component's id is its smallest document id, nulls left out; rows with one id
but different texts are judged by their texts; repeated rows are one class and all returned;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch
from .words import U64, mix, runs, shingles

SIZE = 5
PERCENT = 80
LEADER_ROUNDS = 2
CELL_BITS = 20
CHUNK_BITS = 14
PARTS = 64
SLOT_BITS = 24
#: A block of classes with one label holds about so many classes and n-grams.
BLOCK_CLASSES = 64
BLOCK_GRAMS = 1 << 18


def _cells(sets: np.ndarray) -> np.ndarray:
    return (sets & U64((1 << CELL_BITS) - 1)).astype(np.int64)


def _digest(s: np.ndarray) -> int:
    return int(np.bitwise_xor(mix(s, 11).sum(dtype=U64), mix(U64([len(s)]), 12)[0]).astype(np.int64))


def _profiles(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Per document its class and set size; at the end of the task the cell counts."""
    counts, kind = np.zeros(1 << CELL_BITS, np.int64), None
    for batch in batches:
        kind, row = batch.schema.field(0).type, 0
        for run in runs(batch.column(1)):
            sets = list(shingles(run, size))
            n = np.array([len(s) for s in sets], np.int64)
            counts += np.bincount(_cells(np.concatenate(sets)), minlength=len(counts))
            parts = [np.bincount((s >> U64(58)).astype(np.int64), minlength=PARTS).astype(np.int32) for s in sets]
            names = [_digest(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(sets)), pa.array(n), pa.array(names, pa.int64()),
                 pa.array(parts, pa.list_(pa.int32())), pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())],
                names=["id", "n", "cls", "parts", "chunk", "counts"],
            )
            row += len(sets)
    if kind is not None:
        each = counts.reshape(-1, 1 << CHUNK_BITS)
        m = len(each)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(m, kind), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int32())),
             pa.array(range(m), pa.int32()), pa.array([c.tobytes() for c in each], pa.binary())],
            names=["id", "n", "cls", "parts", "chunk", "counts"],
        )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the counts of each chunk as they stream by."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts = np.frombuffer(raw.as_buffer(), np.int64)
            if chunk in total:
                total[chunk] += counts
            else:
                total[chunk] = counts.copy()
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([c.tobytes() for c in total.values()], pa.binary())],
            names=["chunk", "counts"],
        )


def cell_counts(profiles: DataFrame) -> np.ndarray:
    """The counts of all cells: 2**20 numbers, whatever the table's size."""
    rows = profiles.filter("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk")
    total = np.zeros(1 << CELL_BITS, np.int64)
    for row in rows.mapInArrow(_added, "chunk int, counts binary").collect():
        total[row["chunk"] << CHUNK_BITS : (row["chunk"] + 1) << CHUNK_BITS] += np.frombuffer(row["counts"], np.int64)
    return total


def prefix_length(n, percent: int):
    return n - -(-percent * n // 100) + 1


def _prefixes(batches: Iterator[pa.RecordBatch], size: int, percent: int, counts) -> Iterator[pa.RecordBatch]:
    """(n-gram, class, set size, place) of each prefix, once per class while it is remembered."""
    frequency, seen = counts.value, set()
    for batch in batches:
        for run in runs(batch.column(0)):
            grams, classes, sizes, places = [], [], [], []
            for s in shingles(run, size):
                n = len(s)
                if not n or (name := _digest(s)) in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(name)
                keep = prefix_length(n, percent)
                grams.append(s[np.lexsort((s, frequency[_cells(s)]))[:keep]])
                classes.append(np.full(keep, name, np.int64))
                sizes.append(np.full(keep, n, np.int32))
                places.append(np.arange(keep, dtype=np.int32))
            if grams:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(classes)),
                     pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places))],
                    names=["gram", "cls", "n", "pos"],
                )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (gram, cls): one row per (gram, cls) of grams with several
    classes. Holds back one row between batches."""
    held, held_twin = None, False
    for batch in batches:
        table = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks()
        gram, cls = table["gram"].to_numpy(), table["cls"].to_numpy()
        if not len(gram):
            continue
        fresh = np.ones(len(gram), bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (cls[1:] != cls[:-1])
        at = np.flatnonzero(fresh)
        twin = np.zeros(len(at), bool)  # the row before has the same gram
        twin[1:] = gram[at][1:] == gram[at][:-1]
        twin[0] = held is not None and held_twin
        keep = twin.copy()
        keep[:-1] |= twin[1:]
        held, held_twin = table.slice(int(at[-1]), 1).to_batches()[0], bool(twin[-1])
        yield from table.take(pa.array(at[:-1][keep[:-1]])).to_batches()
    if held is not None and held_twin:
        yield held


def _enough(percent: int) -> Column:
    """Length and positional filter on the rows x and y of one n-gram."""
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    room = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    return (100 * small >= percent * large) & ((100 + percent) * room >= percent * (F.col("x.n") + F.col("y.n")))


def _pairs(x: DataFrame, y: DataFrame, percent: int, differ: Column) -> DataFrame:
    joined = x.alias("x").join(y.alias("y"), (F.col("x.gram") == F.col("y.gram")) & differ & _enough(percent))
    return joined.select(
        F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")
    ).distinct()


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("cls"))
    return rows.join(labels, rows.cls == labels.node, "left").select(
        *rows.columns, F.coalesce("label", "cls").alias("label")
    )


def _commonest(rows: DataFrame) -> DataFrame:
    """Per n-gram that still has several labels: its commonest label, and one class of it as leader."""
    some = F.min(F.struct(F.xxhash64("cls").alias("o"), "cls", "n", "pos")).alias("row")
    by_label = rows.groupBy("gram", "label").agg(F.count("*").alias("c"), some)
    best = by_label.groupBy("gram").agg(F.max(F.struct("c", "row", "label")).alias("m"), F.count("*").alias("labels"))
    return best.filter("labels > 1").select(
        "gram", F.col("m.row.cls").alias("cls"), F.col("m.row.n").alias("n"), F.col("m.row.pos").alias("pos"),
        F.col("m.label").alias("label"),
    )


class Join:
    """One run over one table."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int):
        self.spark, self.size, self.percent = docs.sparkSession, size, percent
        self.scratch = Scratch(self.spark, "jaccard")
        self.docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        self.kind = self.docs.schema["id"].dataType.simpleString()
        schema = f"id {self.kind}, n long, cls long, parts array<int>, chunk int, counts binary"
        staged = self.scratch.put(self.docs.mapInArrow(lambda b: _profiles(b, size), schema), "profiles")
        self.profiles = staged.filter("chunk IS NULL").select("id", "n", "cls", "parts")
        self.classes = self.scratch.put(
            self.profiles.filter("cls IS NOT NULL").groupBy("cls").agg(
                F.min("id").alias("id"), F.min("n").alias("n"), F.first("parts").alias("parts")
            ), "classes",
        )
        counts = self.spark.sparkContext.broadcast(cell_counts(staged))
        prefixes = self.docs.select("text").mapInArrow(
            lambda b: _prefixes(b, size, percent, counts), "gram long, cls long, n int, pos int"
        )
        sorted_rows = prefixes.repartition("gram").sortWithinPartitions("gram", "cls")
        self.rows = self.scratch.put(sorted_rows.mapInArrow(_shared, prefixes.schema), "shared")

    def leader_pairs(self, labels: DataFrame | None) -> DataFrame:
        """Every class with the leader of each of its n-grams that has another label."""
        rows = _labelled(self.rows, labels)
        return _pairs(rows, _commonest(rows), self.percent, F.col("x.label") != F.col("y.label"))

    def all_candidates(self) -> DataFrame:
        return _pairs(self.rows, self.rows, self.percent, F.col("x.cls") < F.col("y.cls"))

    def sets(self, classes: DataFrame) -> DataFrame:
        """(cls, grams) of the classes in the column ``cls``, made again from one text of each."""
        size = self.size
        needed = classes.distinct().join(self.classes, "cls").select("cls", "id")
        slot = F.pmod(F.xxhash64("id"), F.lit(1 << SLOT_BITS)).cast("int")
        words = needed.groupBy(F.shiftright(slot, 6).alias("w")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, int(pmod(xxhash64(id), {1 << SLOT_BITS}) & 63))")).alias("bits")
        )
        bitmap = np.zeros(1 << SLOT_BITS - 6, np.int64)  # of fixed size; lets through too many, never too few
        for row in words.toLocalIterator():
            bitmap[row["w"]] = row["bits"]
        shared = self.spark.sparkContext.broadcast(bitmap)
        made = self.docs.select("id", "text", slot.alias("slot")).mapInArrow(
            lambda b: _sets(b, size, shared), f"id {self.kind}, cls long, grams array<long>"
        )
        wanted = made.alias("s").join(
            needed.alias("k"), (F.col("s.cls") == F.col("k.cls")) & F.col("s.id").eqNullSafe(F.col("k.id")), "left_semi"
        )
        return self.scratch.put(wanted.select("cls", "grams"), "sets")

    def _linking(self, overlap: Column, total: Column) -> Column:
        return 100 * overlap >= self.percent * (total - overlap)

    def _suffix_filter(self) -> Column:
        """On the classes x and y: their sets can overlap enough part by part."""
        most = F.aggregate(F.zip_with("x.parts", "y.parts", lambda p, q: F.least(p, q)), F.lit(0), lambda t, v: t + v)
        return (100 + self.percent) * most >= self.percent * (F.col("x.n") + F.col("y.n"))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link, with their overlap."""
        x, y = self.classes.alias("x"), self.classes.alias("y")
        both = pairs.join(x, F.col("a") == F.col("x.cls")).join(y, F.col("b") == F.col("y.cls"))
        left = self.scratch.put(both.filter(self._suffix_filter()).select("a", "b"), "suffix")
        sets = self.sets(left.select(F.col("a").alias("cls")).union(left.select("b")))
        wide = left.join(sets.select(F.col("cls").alias("a"), F.col("grams").alias("ga")), "a").join(
            sets.select(F.col("cls").alias("b"), F.col("grams").alias("gb")), "b"
        )
        counted = wide.select(
            "a", "b", F.size(F.array_intersect("ga", "gb")).alias("overlap"), (F.size("ga") + F.size("gb")).alias("total")
        )
        found = counted.filter(self._linking(F.col("overlap"), F.col("total")))
        links = self.scratch.put(found.select("a", "b", "overlap").distinct(), "links")
        self.scratch.drop(left, sets)
        return links

    def across(self, labels: DataFrame | None) -> DataFrame:
        """Links (a, b) that join different labels, one at least for all labels that any link joins.

        Classes of one label are dealt to blocks. A class meets the blocks of other labels with
        which it shares an n-gram; it is compared with every member of a block, and one link
        with it is enough.
        """
        every = _labelled(self.rows, labels)
        best = _commonest(every).select("gram", F.col("label").alias("top"))
        rows = self.scratch.put(every.join(best, "gram"), "mixed")  # n-grams that have several labels left
        members = rows.select("cls", "n", "label").distinct()
        parts = members.groupBy("label").agg(
            F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_GRAMS)).alias("of")
        )
        members = self.scratch.put(members.join(parts, "label").select(
            "cls", "n", "label", F.pmod(F.xxhash64("cls"), "of").alias("part")
        ), "members")
        blocks = rows.join(members.select("cls", "part"), "cls").groupBy("gram", "label", "part").agg(
            F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.max(F.col("n") - F.col("pos")).alias("room")
        )
        x, y, t = rows.filter("label <> top").alias("x"), blocks.alias("y"), self.percent
        room = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.room"))
        met = x.join(
            y, (F.col("x.gram") == F.col("y.gram"))
            & ((F.col("x.label") < F.col("y.label")) | (F.col("y.label") == F.col("x.top")))
            & (100 * F.col("y.n_max") >= t * F.col("x.n")) & (100 * F.col("x.n") >= t * F.col("y.n_min"))
            & ((100 + t) * room >= t * (F.col("x.n") + F.col("y.n_min"))),
        ).select("x.cls", "y.label", "y.part").distinct()
        single = members.groupBy("label", "part").agg(F.count("*").alias("m"), F.min("cls").alias("one"))
        c, o = self.classes.alias("x"), self.classes.alias("y")
        pairs = met.alias("p").join(single.alias("b"), ["label", "part"]).select(
            F.col("p.cls").alias("a"), "label", "part", F.when(F.col("m") == 1, F.col("one")).alias("one")
        )
        few = pairs.filter("one IS NOT NULL").join(c, F.col("a") == F.col("x.cls")).join(o, F.col("one") == F.col("y.cls")).filter(
            self._suffix_filter()
        ).select("a", "label", "part")
        pairs = self.scratch.put(few.unionByName(pairs.filter("one IS NULL").select("a", "label", "part")), "across")
        in_pairs = members.join(pairs.select("label", "part").distinct(), ["label", "part"])
        sets = self.sets(in_pairs.select("cls").union(pairs.select("a")))
        bodies = in_pairs.join(sets, "cls").groupBy("label", "part").agg(F.collect_list(F.struct("cls", "grams")).alias("body"))
        own = pairs.join(sets.select(F.col("cls").alias("a"), F.col("grams").alias("ga")), "a")
        wide = own.join(bodies, ["label", "part"])

        def links(m: Column) -> Column:
            return self._linking(F.size(F.array_intersect("ga", m["grams"])), F.size("ga") + F.size(m["grams"]))

        hits = F.transform(F.filter("body", links), lambda m: m["cls"])
        found = self.scratch.put(
            wide.select("a", F.array_min(hits).alias("b")).filter("b IS NOT NULL"), "links"
        )
        self.scratch.drop(rows, members, pairs, sets)
        return found

    def labels(self, leader_rounds: int = LEADER_ROUNDS) -> DataFrame | None:
        """(node, label) of all classes with a link."""
        labels = links = tested = None
        for _ in range(leader_rounds):
            pairs = self.leader_pairs(labels)
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = self.scratch.put(pairs, "pairs")
            if pairs.isEmpty():
                break
            found = self.verified(pairs).select("a", "b")
            tested = pairs if tested is None else tested.unionByName(pairs)
            links = found if links is None else links.unionByName(found)
            if not found.isEmpty():
                labels = components(links, self.scratch)
        found = self.across(labels)
        if found.isEmpty():
            return labels
        return components(found if links is None else links.unionByName(found), self.scratch)


def _sets(batches: Iterator[pa.RecordBatch], size: int, bitmap) -> Iterator[pa.RecordBatch]:
    bits = bitmap.value
    for batch in batches:
        slot = batch.column(2).to_numpy()
        wanted = (bits[slot >> 6].view(U64) >> (slot & 63).astype(U64)) & U64(1) != 0
        if not wanted.any():
            continue
        batch, row = batch.filter(pa.array(wanted)), 0
        for run in runs(batch.column(1)):
            sets = list(shingles(run, size))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(sets)),
                 pa.array([_digest(s) if len(s) else None for s in sets], pa.int64()),
                 pa.ListArray.from_arrays(
                     pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)),
                     pa.array(np.concatenate(sets).view(np.int64)))],
                names=["id", "cls", "grams"],
            )
            row += len(sets)


def near_components(
    docs: DataFrame, size: int = SIZE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
    leader_rounds: int = LEADER_ROUNDS,
) -> DataFrame:
    """Per row: id, n_shingles, component_id."""
    run = Join(docs, id_col, text_col, size, percent)
    labels = run.labels(leader_rounds)
    run.scratch.drop(run.rows)
    own = run.classes.select("cls", "id")
    if labels is not None:
        named = own.join(labels, own.cls == labels.node).select("cls", "label", "id")
        smallest = named.groupBy("label").agg(F.min("id").alias("least"))
        linked = named.join(smallest, "label").select("cls", "least")
        own = own.join(linked, "cls", "left").select("cls", F.coalesce("least", "id").alias("id"))
    own = own.select("cls", F.col("id").alias("component_id"))
    filled = run.profiles.filter("cls IS NOT NULL").join(own, "cls").select("id", "n", "component_id")
    alone = run.profiles.filter("cls IS NULL").select("id", "n", F.col("id").alias("component_id"))
    return filled.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def near_links(
    docs: DataFrame, size: int = SIZE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All linked pairs of classes: (a, b, overlap), a class named by the smallest id of its
    documents, a <= b. Its size is that of the answer, so on groups of many near copies use
    ``near_components``."""
    run = Join(docs, id_col, text_col, size, percent)
    links = run.verified(run.scratch.put(run.all_candidates(), "pairs"))
    x, y = run.classes.alias("x"), run.classes.alias("y")
    return links.join(x, F.col("a") == F.col("x.cls")).join(y, F.col("b") == F.col("y.cls")).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"), "overlap"
    )


def keep_first(
    docs: DataFrame, size: int = SIZE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Of each group the row with the smallest id, all columns as they are; a null id is larger than others.

    Rows are told apart by id and text, so different texts under one id, or without an id, are judged each
    for itself; of one id's texts in a group the one with the smaller hash stays, and of rows with equal
    id and text one, the smallest by its columns.
    """
    own = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("t"))
    groups = near_components(docs.select(own.alias("row"), F.col(text_col).alias("text")), size, percent, "row", "text")
    kept = groups.filter(F.col("row") == F.col("component_id")).groupBy("row").agg(F.count("*").alias("__rows"))
    kept = kept.select(F.col("row.id").alias("__id"), F.col("row.t").alias("__t"), "__rows")
    same = docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__t"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.join(kept, same).select(F.struct(*names).alias("__row"), "__id", "__t", "__rows")
    # only rows that stand several times are exchanged again
    once = rows.filter("__rows = 1").select("__row.*")
    least = rows.filter("__rows > 1").groupBy("__id", "__t").agg(F.min("__row").alias("__row"))
    return once.unionByName(least.select("__row.*"))
