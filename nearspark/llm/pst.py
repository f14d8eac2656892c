"""Language-model scores from a probabilistic suffix tree over words.

Symbols are the words of a text, lower-cased, and one end of text. A context of up to
``DEPTH`` words is a candidate state when the training texts hold it at least ``MIN_COUNT``
times (and it makes up at least ``MIN_SHARE`` of all training tokens; 0 asks for no share). A
candidate is retained when the distribution of its next symbols diverges from that of its
longest retained suffix by at least ``DIVERGENCE`` nats; symbols too rare behind it count as
one rest. The tree grows with the corpus, so it is kept as Spark tables.

Smoothing: of each next symbol's count ``DISCOUNT`` is taken off; what is left over goes to the
other symbols in proportion to the suffix state. The root is the add-0.5 unigram
distribution over all words of the corpus. A text's score sums, token by token, the log10
probability from the longest state that ends there.

How it is made:

1. Words are counted. Then, for n = 2, 3 and so on, one pass counts the n-grams whose first and whose
   last n - 1 words are frequent; no other n-gram can be. A bitmap tells which are, so the rare tail, which
   is nearly all n-grams, is never counted. An n-gram is named by these two parts, and a task
   sends its different ones as packed arrays to ``buckets`` by hash, which grow with the texts.
2. Depth by depth the candidates' divergence is summed by context, which starts before the
   exchange, and the chance of each frequent n-gram's last token is taken from the longest
   retained suffix of the rest: its own state's, else that of the n-gram less its first token.
3. As every suffix of a frequent n-gram is frequent, a text's score is the sum of one weight
   per n-gram in it: the log10 backoff of the state it is, and what its chance adds to that
   of its suffix, less the backoff of its context. The n-grams that each make up ``HOT_SHARE`` of all training
   tokens are broadcast with their weights and never enter an exchange, so none is a hot key; there are at
   most 1 / ``HOT_SHARE`` of each length in a corpus of any size. The others meet the weights by buckets of
   names, as packed arrays, and are added up by text. A bitmap keeps n-grams without a weight away from
   that exchange; it can let too many through, never too few.

Neither ``HOT_SHARE`` nor the size of bitmaps, piles and buckets changes a result.

Defined results: null and empty texts are one end of text; rows with a null id train;
repeated rows train and are scored one by one; without training texts every token has
the same probability 1; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import U64, Run, mix, runs

DEPTH = 3
MIN_SHARE = 0.0
MIN_COUNT = 8
DIVERGENCE = 0.02
DISCOUNT = 0.5
HOT_SHARE = 5e-6
#: Size of a bitmap of names; a name has two bits in it.
BITMAP_BITS = 27
SECOND = 34
#: N-grams that a task gathers before it joins equal ones and hands them on.
PILE = 1_000_000
#: Bytes of text for one bucket of n-grams, and the most buckets there may be.
BUCKET_BYTES = 4 << 20
#: The same for the n-grams that meet the weights: fewer buckets, so that a text's sums are in fewer of them.
MEETING_BYTES = 16 << 20
#: A text has sums in up to so many buckets (as a power of two) at every size; with more buckets at most one per n-gram.
MEETING_BITS = 6
MEETING_PILE = 200_000
MAX_BUCKET_BITS = 18
#: Bytes of text whose words a task holds at a time.
RUN = 1 << 20
SUMS = ["known", "logs", "gain"]
END = mix(np.array([0xE0F], U64), 77)[0]


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _tokens(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of a run with the ends put in, and where each text starts (and the last ends)."""
    return np.insert(run.hashes, run.first[1:], END), run.first + np.arange(len(run.first))


def _inside(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Place of each token in its text."""
    sizes = np.diff(starts)
    return np.arange(len(tokens)) - np.repeat(starts[:-1], sizes)


def joined(heads: np.ndarray, tails: np.ndarray, n: int) -> np.ndarray:
    """Name of the n-gram whose first and last n - 1 tokens have these names."""
    with np.errstate(over="ignore"):
        return mix(heads * U64(0x9FB21C651E98DF25) + tails * U64(0xD6E8FEB86659FD93), 50 + n)


def all_grams(tokens: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray]]:
    """(n, names of all n-grams) for n = 1 to depth + 1, text borders not regarded."""
    names = tokens
    for n in range(1, depth + 2):
        if n > 1:
            names = joined(names[:-1], names[1:], n)
        yield n, names


def _valid(place: np.ndarray, n: int) -> np.ndarray:
    """For each window of n tokens whether it lies in one text."""
    return place[n - 1 :] >= n - 1


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, count) of the words of each run."""
    for batch in batches:
        for run in runs(batch.column(0), size=RUN):
            words, counts = np.unique(_tokens(run)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], names=["gram", "count"])


def _packed(heads: np.ndarray, tails: np.ndarray, n: int, bits: int) -> pa.RecordBatch:
    """One row per bucket: its different n-grams as arrays of heads, tails and counts."""
    names, first, counts = np.unique(joined(heads, tails, n), return_index=True, return_counts=True)
    heads, tails, counts = heads[first], tails[first], counts.astype(np.uint32)
    bucket = (names >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(names), np.int64)
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(starts[1:], len(names))
    data = [heads[s:e].tobytes() + tails[s:e].tobytes() + counts[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), pa.array(data, pa.binary())], names=["bucket", "data"])


def _candidates(batches: Iterator[pa.RecordBatch], n: int, shared, bits: int) -> Iterator[pa.RecordBatch]:
    """Packed n-grams whose parts may be frequent."""
    frequent, piled, size = shared.value, [], 0

    def pack() -> pa.RecordBatch:
        heads, tails = (np.concatenate(c) for c in zip(*piled, strict=True))
        return _packed(heads, tails, n, bits)

    for batch in batches:
        for run in runs(batch.column(0), size=RUN):
            tokens, starts = _tokens(run)
            if len(tokens) < n:
                continue
            names = next(names for m, names in all_grams(tokens, n) if m == n - 1)
            known = _probed(frequent, names)
            at = np.flatnonzero(known[:-1] & known[1:] & _valid(_inside(tokens, starts), n))
            piled.append((names[at], names[at + 1]))
            size += len(at)
            if size >= PILE:
                yield pack()
                piled, size = [], 0
    if size:
        yield pack()


def _counting(n: int, least: int) -> Callable[[pa.Table], pa.Table]:
    return lambda rows: _counted(rows, n, least)


def _counted(rows: pa.Table, n: int, least: int) -> pa.Table:
    """(gram, head, tail, count) of the frequent n-grams of a bucket."""
    heads, tails, counts = [], [], []
    for data in rows["data"].to_pylist():
        m = len(data) // 20
        heads.append(np.frombuffer(data, U64, m))
        tails.append(np.frombuffer(data, U64, m, 8 * m))
        counts.append(np.frombuffer(data, np.uint32, m, 16 * m))
    heads, tails, counts = (np.concatenate(c) for c in (heads, tails, counts))
    names, first, back = np.unique(joined(heads, tails, n), return_index=True, return_inverse=True)
    total = np.bincount(back, counts, len(names)).astype(np.int64)
    keep = total >= least
    return pa.table({
        "gram": names[keep].view(np.int64), "head": heads[first][keep].view(np.int64),
        "tail": tails[first][keep].view(np.int64), "count": total[keep],
    })


def _bitmap(grams: DataFrame) -> np.ndarray:
    """The names in the column ``gram`` as a bitmap of fixed size."""
    size = (1 << BITMAP_BITS) - 1
    slots = F.array(F.col("gram").bitwiseAND(size), F.shiftright("gram", SECOND).bitwiseAND(size))
    words = grams.select(F.explode(slots).alias("slot")).groupBy(F.shiftright("slot", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(slot & 63))")).alias("bits")
    ).toArrow()
    bits = np.zeros(1 << BITMAP_BITS - 6, np.int64)
    bits[words["w"].to_numpy()] = words["bits"].to_numpy()
    return bits.view(U64)


class Tree:
    """``weights``: (gram, count, known, logs, gain) of all training words and frequent n-grams."""

    def __init__(self, total: int, vocabulary: int, depth: int):
        self.total, self.vocabulary, self.depth = total, vocabulary, depth
        self.denominator = total + 0.5 * (vocabulary + 1)
        self.weights: DataFrame | None = None


def _bucket_bits(texts: DataFrame, bytes_: int, least: int) -> int:
    volume = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    return min(MAX_BUCKET_BITS, max(least, (volume // bytes_).bit_length()))


def learn(train: DataFrame, depth: int = DEPTH, min_share: float = MIN_SHARE, min_count: int = MIN_COUNT,
          divergence: float = DIVERGENCE) -> Tree:
    """The tree of the texts in the column ``text`` of ``train``."""
    scratch = Scratch(train.sparkSession, "suffix-tree")
    words = scratch.put(train.mapInArrow(_word_counts, "gram long, count long").groupBy("gram").agg(F.sum("count").alias("count")), "words")
    size = words.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"), F.count("*").alias("words")).first()
    tree = Tree(size["total"], size["words"], depth)
    least = max(min_count, math.ceil(min_share * tree.total))
    bits = _bucket_bits(train, BUCKET_BYTES, 4)
    levels = {1: words.filter(F.col("count") >= least)}
    for n in range(2, depth + 2):
        frequent = train.sparkSession.sparkContext.broadcast(_bitmap(levels[n - 1]))
        packed = train.mapInArrow(lambda b, n=n, f=frequent: _candidates(b, n, f, bits), "bucket int, data binary")
        counted = packed.groupBy("bucket").applyInArrow(_counting(n, least), "gram long, head long, tail long, count long")
        levels[n] = scratch.put(counted, f"grams-{n}")
        frequent.destroy()

    def level(n: int) -> DataFrame:
        return levels[n]

    known = words.select("gram", "count", F.log10((F.col("count") + 0.5) / 0.5).alias("logs"))
    root = (F.col("count") + 0.5) / F.lit(tree.denominator)
    #: per frequent n-gram the chance of its last token, and the root's
    below = level(1).select("gram", root.alias("chance"), root.alias("root"))
    states, steps, made = [], [], []
    for n in range(1, depth + 1):
        tails = below.select(F.col("gram").alias("tail"), F.col("chance").alias("old"), "root")
        nexts = scratch.put(level(n + 1).join(tails, "tail").select("gram", "head", "count", "old", "root"), f"nexts-{n}")
        part = F.col("count") - F.lit(DISCOUNT)
        sums = nexts.groupBy("head").agg(
            F.sum(part).alias("mass"), F.sum("old").alias("old"),
            F.sum(part * (F.log(part) - F.log("old"))).alias("far"),
        )
        own = sums.join(level(n).select(F.col("gram").alias("head"), F.col("count").alias("size")), "head").select(
            "head", "size", F.greatest(1 - F.col("mass") / F.col("size"), F.lit(1e-12)).alias("rest"),
            F.greatest(1 - F.col("old"), F.lit(1e-12)).alias("old_rest"),
            ((F.col("far") - F.col("mass") * F.log("size")) / F.col("size")).alias("far"),
        )
        retained = scratch.put(
            own.filter(F.col("far") + F.col("rest") * F.log(F.col("rest") / F.col("old_rest")) >= divergence)
            .select("head", "size", F.log10(F.col("rest") / F.col("old_rest")).alias("backoff")),
            f"states-{n}",
        )
        chance = F.coalesce(part / F.col("size"), F.col("old"))
        below = scratch.put(nexts.join(retained, "head", "left").select(
            "gram", "count", chance.alias("chance"), "root",
            (F.log10(chance / F.col("old")) - F.coalesce("backoff", F.lit(0.0))).alias("gain"),
        ), f"chances-{n}")
        scratch.drop(nexts)
        made += [retained, below]
        states.append(retained.select(F.col("head").alias("gram"), F.col("backoff").alias("gain")))
        steps.append(below.select("gram", "count", "gain"))
    none, no = F.lit(None).cast("long").alias("count"), F.lit(0.0)
    parts = known.select("gram", "count", F.lit(1).alias("known"), "logs", no.alias("gain"))
    for s in states:
        parts = parts.unionByName(s.select("gram", none, F.lit(0).alias("known"), no.alias("logs"), "gain"))
    for s in steps:
        parts = parts.unionByName(s.select("gram", "count", F.lit(0).alias("known"), no.alias("logs"), "gain"))
    tree.weights = scratch.put(parts.groupBy("gram").agg(
        F.max("count").alias("count"), F.max("known").alias("known"), F.sum("logs").alias("logs"), F.sum("gain").alias("gain")
    ).filter("known > 0 OR gain <> 0"), "weights")
    scratch.drop(words, *(levels[n] for n in range(2, depth + 2)), *made)
    return tree


class Lookup:
    """Hot names in a sorted table, with their values."""

    def __init__(self, rows: pa.Table):
        names = rows["gram"].to_numpy().view(U64)
        order = np.argsort(names)
        self.names, self.gain = names[order], rows["gain"].to_numpy()[order]
        self.logs = rows["logs"].to_numpy()[order] if "logs" in rows.column_names else None

    def __call__(self, names: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the names at the places ``at``: the places of hot ones, theirs in the table, and the other places."""
        if not len(self.names):
            return at[:0], at[:0], at
        # equal and near names one after the other make the search in the table a walk
        at = at[np.argsort(names[at])]
        place = np.minimum(np.searchsorted(self.names, names[at]), len(self.names) - 1)
        hit = self.names[place] == names[at]
        return at[hit], place[hit], at[~hit]


class Hot:
    """What every task gets: the hot words and longer n-grams, and the bitmap of all that have a weight."""

    def __init__(self, words: Lookup, others: Lookup, bits: np.ndarray):
        self.words, self.others, self.bits = words, others, bits

    def find(self, n: int, names: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = self.words if n == 1 else self.others
        return table(names, np.flatnonzero(_valid(place, n) & _probed(self.bits, names)))


def _by_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts[:-1]) if len(starts) > 1 else np.zeros(0)


def _probed(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    def bit(at: np.ndarray) -> np.ndarray:
        return (bits[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1) != 0

    size = U64((1 << BITMAP_BITS) - 1)
    found = bit(h & size)
    at = np.flatnonzero(found)
    found[at] = bit(h[at] >> U64(SECOND) & size)
    return found


def _summaries(batches: Iterator[pa.RecordBatch], shared, depth: int) -> Iterator[pa.RecordBatch]:
    """From (text, ...): the other columns with n_tokens, and the sums of the hot n-grams."""
    hot = shared.value
    for batch in batches:
        row = 0
        for run in runs(batch.column(0), size=RUN):
            tokens, starts = _tokens(run)
            place, sums = _inside(tokens, starts), np.zeros((3, len(tokens)))
            for n, names in all_grams(tokens, depth):
                if not len(names):
                    break
                at, found, _ = hot.find(n, names, place)
                if n == 1:
                    sums[0][at] += 1
                    sums[1][at] += hot.words.logs[found]
                sums[2][at] += (hot.words if n == 1 else hot.others).gain[found]
            known, logs, gain = (_by_text(c, starts) for c in sums)
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(row, len(run)) for c in batch.columns[1:]), pa.array(np.diff(starts)),
                 pa.array(known.astype(np.int64)), pa.array(logs), pa.array(gain)],
                names=["id", "key", "held_out", "n_tokens", "known", "logs", "gain"],
            )
            row += len(run)


def _planes(values: np.ndarray) -> bytes:
    """The values byte by byte, first bytes first, so that bytes that hardly change lie side by side."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _unplaned(data: bytes, kind: type, rows: int, start: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8, rows * size, start).reshape(size, rows).T.copy().view(kind).ravel()


def _meeting(names: np.ndarray, texts: np.ndarray, keys: np.ndarray, bits: int) -> pa.RecordBatch:
    """One row per bucket: its different pairs of n-gram and text as arrays of names, numbers of keys and places, and the keys."""
    order = np.argsort(names)
    names, texts = names[order], texts[order]
    new = np.diff(names, prepend=~names[:1]) != 0
    pairs = np.sort((np.cumsum(new) - 1) * len(keys) + texts)
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    places = np.diff(first, append=len(pairs)).astype(np.uint32)
    names, texts = names[new][pairs[first] // len(keys)], pairs[first] % len(keys)
    bucket = (names >> U64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends, data = np.append(starts[1:], len(names)), []
    for s, e in zip(starts, ends, strict=True):
        own = np.zeros(len(keys), bool)
        own[texts[s:e]] = True
        number = (np.cumsum(own, dtype=np.uint32) - np.uint32(1))[texts[s:e]]
        data.append(_planes(names[s:e]) + _planes(number) + _planes(places[s:e]) + keys[own].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[starts].astype(np.int32)), pa.array((ends - starts).astype(np.int32)), pa.array(data, pa.binary())],
        names=["bucket", "rows", "data"],
    )


def _cold(batches: Iterator[pa.RecordBatch], shared, depth: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Packed n-grams, with their texts, that are not hot and may have a weight."""
    hot, piled, keys, size, count = shared.value, [], [], 0, 0

    def pack() -> pa.RecordBatch:
        names, texts = (np.concatenate(c) for c in zip(*piled, strict=True))
        return _meeting(names, texts, np.concatenate(keys), bits)

    for batch in batches:
        row, key = 0, batch.column(1).to_numpy()
        for run in runs(batch.column(0), size=RUN):
            tokens, starts = _tokens(run)
            place, texts = _inside(tokens, starts), np.repeat(np.arange(count, count + len(run)), np.diff(starts))
            keys.append(key[row : row + len(run)])
            for n, names in all_grams(tokens, depth):
                if not len(names):
                    break
                at = hot.find(n, names, place)[2]
                piled.append((names[at], texts[at]))
                size += len(at)
            row, count = row + len(run), count + len(run)
            if size >= MEETING_PILE:
                yield pack()
                piled, keys, size, count = [], [], 0, 0
    if size:
        yield pack()


def _added(weights: pa.Table, packs: pa.Table) -> pa.Table:
    """(key, known, logs, gain) of the texts in a bucket's packs: what the bucket's weights add."""
    names = weights["gram"].to_numpy().view(U64)
    order = np.argsort(names)
    names, values = names[order], [weights[c].to_numpy()[order] for c in SUMS]
    found = [[np.zeros(0, np.int64)], *([np.zeros(0, v.dtype)] for v in values)]
    for rows, data in zip(packs["rows"], packs["data"], strict=True):
        if not len(names):
            break
        rows, data = rows.as_py(), data.as_py()
        grams = _unplaned(data, U64, rows, 0)
        place = np.minimum(np.searchsorted(names, grams), len(names) - 1)
        hit = np.flatnonzero(names[place] == grams)
        text, places = (_unplaned(data, np.uint32, rows, start * rows)[hit] for start in (8, 12))
        keys = np.frombuffer(data, np.int64, offset=16 * rows)
        some = np.flatnonzero(np.bincount(text, minlength=len(keys)))
        found[0].append(keys[some])
        for c, v in zip(found[1:], values, strict=True):
            c.append(np.bincount(text, places * v[place[hit]], len(keys))[some].astype(v.dtype))
    return pa.table(dict(zip(["key", *SUMS], map(np.concatenate, found), strict=True)))


def _hot(tree: Tree) -> Hot:
    """The n-grams that each make up ``HOT_SHARE`` of all training tokens, with their weights, and the bitmap of all."""
    hot = tree.weights.filter(F.col("count") >= HOT_SHARE * tree.total)
    words = Lookup(hot.filter("known > 0").select("gram", "logs", "gain").toArrow())
    others = Lookup(hot.filter("known = 0").select("gram", "gain").toArrow())
    return Hot(words, others, _bitmap(tree.weights))


def score(
    docs: DataFrame, tree: Tree | None = None, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score. Rows that
    are not held out are learned from."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        text.alias("text"), F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("key"),
        held_out(F.col(id_col)).alias("held_out"),
    )
    if tree is None:
        tree = learn(rows.filter("NOT held_out").select("text"), **settings)
    depth, shared = tree.depth, docs.sparkSession.sparkContext.broadcast(_hot(tree))
    kind = rows.schema["id"].dataType.simpleString()
    whole = rows.select("text", "id", "key", "held_out").mapInArrow(
        lambda b: _summaries(b, shared, depth),
        f"id {kind}, key long, held_out boolean, n_tokens long, known long, logs double, gain double",
    )
    scratch = Scratch(docs.sparkSession, "suffix-scores")
    bits = _bucket_bits(rows, MEETING_BYTES, MEETING_BITS)
    weights = tree.weights.withColumn("bucket", F.shiftrightunsigned("gram", 64 - bits).cast("int"))
    packs = rows.select("text", "key").mapInArrow(lambda b: _cold(b, shared, depth, bits), "bucket int, rows int, data binary")
    added = weights.select("bucket", "gram", F.col("known").cast("long"), "logs", "gain").groupBy("bucket").cogroup(
        packs.groupBy("bucket")
    ).applyInArrow(_added, "key long, known long, logs double, gain double")
    sums = scratch.put(added.groupBy("key").agg(*(F.sum(c).alias(f"more_{c}") for c in SUMS)), "sums")
    # equal rows share a key: their sums are theirs together
    copies = rows.groupBy("key").agg(F.count("*").alias("m"))
    joined = whole.join(sums.join(copies, "key"), "key", "left")

    def with_more(name: str) -> Column:
        return F.col(name) + F.coalesce(F.col(f"more_{name}") / F.col("m"), F.lit(0.0))

    known = F.round(with_more("known")).cast("long")
    base = with_more("logs") + F.col("n_tokens") * F.lit(math.log10(0.5) - math.log10(tree.denominator))
    return joined.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", known.alias("n_known"),
        F.lit(tree.total).cast("long").alias("train_tokens"), base.alias("base_score"),
        (base + with_more("gain")).alias("score"),
    )
