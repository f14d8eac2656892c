"""Benchmark decontamination with spaced seeds.

Words are compared without case and ASCII punctuation. A seed is a fixed mask over
``SPAN`` neighbouring words that ignores some of them, so a hit survives substitutions at
the ignored places; the masks ignore different ones.

1. Benchmark items are hashed under every mask at every place. ``MASKS`` are chosen so that one
   of them fits into every pattern of 12 equal words among 12 to 16, wherever the others stand.
   Items below ``SHORT`` words, but of at least ``LEAST``, are also hashed under masks made for their
   length, which hit whichever fifth of the words differs; below ``EXACT`` words none may.
2. Texts are hashed in the same way. A bitmap of fixed size over the benchmark hashes
   keeps all but possible hits away from the exchange; it can let too many through, never too few.
3. Possible hits join the benchmark's hashes exactly. What stays are (text, item, diagonal).
4. Around each hit the whole overlap of text and item on that diagonal is compared word
   by word; a stretch is an overlap when it has at least ``MATCHES`` equal words, or all but a
   fifth of a shorter item (below ``EXACT`` words all of it), and at least ``IDENTITY`` of it is equal. Reported is the stretch of
   greatest matches minus mismatches if it is one, else of all that are one with most equal words.

Equal texts are verified once, under a digest of their words; a task sends the words of a
text once, however many copies it sees.

Defined results: null and empty texts and items match nothing; items below ``LEAST`` words
are too short to tell and are left out; rows with one id are reported under it once per
item, and ``clean`` judges each row by its own text; an empty table on either side gives no overlaps; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .words import U64, mix, runs

#: 1 is compared, 0 is ignored. Six words each; found by taking, again and again, the mask of at most 12
#: words that fits into most of the patterns that no mask fits into yet.
MASKS = ("11010111", "11100010011", "110010001011", "1101001011", "101000110011", "111111")
LEAST = 6
#: Items of fewer words are looked for as they are.
EXACT = 8
#: Items of fewer words have masks made for their length.
SHORT = 15
MATCHES = 12
IDENTITY = 0.75
BITMAP_BITS = 24


def _seed(hashes: np.ndarray, mask: str, salt: int) -> np.ndarray:
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    with np.errstate(over="ignore"):
        for k, factor in enumerate(mix(np.arange(len(mask), dtype=U64), salt) | U64(1)):
            if mask[k] == "1":
                total += hashes[k : k + n] * factor
    return mix(total, salt)


def differing(n: int) -> int:
    """How many words of an item of n words may differ."""
    return 0 if n < EXACT else n // 5


def _short_masks(n: int) -> list[tuple[str, int, int]]:
    """(mask, salt, its place in the item) for items of n words. Blocks of the item, two more than
    a fifth of its words, of which each mask ignores a fifth of the words' number: whichever
    fifth of the words differs or is cut off, some mask holds none of them."""
    less = differing(n)
    border = [n * k // (less + 2) for k in range(less + 3)]
    masks = []
    for k, out in enumerate(combinations(range(less + 2), less)):
        mask = "".join(("0" if b in out else "1") * (border[b + 1] - border[b]) for b in range(less + 2))
        masks.append((mask.strip("0"), 1000 + 100 * n + k, mask.index("1")))
    return masks


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, words, seeds, places) per item; items below ``SHORT`` words also have masks of their own."""
    for batch in batches:
        rows = []
        ids, row = batch.column(0), 0
        for run in runs(batch.column(1), "symbol"):
            for i in range(len(run)):
                words = run.hashes[run.first[i] : run.first[i + 1]]
                seeds, places = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
                for salt, mask in enumerate(MASKS, 31):
                    h = _seed(words, mask, salt)
                    seeds.append(h)
                    places.append(np.arange(len(h)))
                if LEAST <= len(words) < SHORT:
                    for mask, salt, place in _short_masks(len(words)):
                        seeds.append(_seed(words[place : place + len(mask)], mask, salt))
                        places.append(np.array([place]))
                rows.append((words.view(np.int64), np.concatenate(seeds).view(np.int64), np.concatenate(places)))
            row += len(run)
        yield pa.RecordBatch.from_arrays(
            [ids, *(pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in range(3))],
            names=["item", "words", "seeds", "places"],
        )


def _probes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = U64((1 << BITMAP_BITS) - 1)
    return h & size, (h >> U64(32)) & size


def _bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1) != 0


def _hits(batches: Iterator[pa.RecordBatch], bitmap, short: list[int]) -> Iterator[pa.RecordBatch]:
    """Per text with possible hits: id, digest, and once per text and task its words,
    seeds and places. ``short``: lengths of items below ``SHORT``."""
    bits, seen = bitmap.value, set()
    masks = [(m, s) for s, m in enumerate(MASKS, 31)] + [(m, s) for n in short for m, s, _ in _short_masks(n)]
    for batch in batches:
        row = 0
        for run in runs(batch.column(1), "symbol"):
            found_at, found = [], []
            for mask, salt in masks:
                h = _seed(run.hashes, mask, salt)
                if not len(h):
                    continue
                one, two = _probes(h)
                at = np.flatnonzero(_bit(bits, one))
                at = at[_bit(bits, two[at])]
                text = np.searchsorted(run.first, at, "right") - 1
                at = at[at + len(mask) <= run.first[text + 1]]
                found_at.append(at)
                found.append(h[at])
            if found and sum(map(len, found)):
                at, h = np.concatenate(found_at), np.concatenate(found)
                text = np.searchsorted(run.first, at, "right") - 1
                order = np.argsort(text, kind="stable")
                at, h, text = at[order], h[order], text[order]
                texts, begin = np.unique(text, return_index=True)
                end = np.append(begin[1:], len(text))
                ids, keys, words, seeds, places = [], [], [], [], []
                for t, b, e in zip(texts.tolist(), begin, end, strict=True):
                    own = run.hashes[run.first[t] : run.first[t + 1]]
                    with np.errstate(over="ignore"):
                        key = int((mix(own, 41) * (np.arange(len(own), dtype=U64) * U64(2) + U64(1))).sum(dtype=U64).view(np.int64))
                    ids.append(row + t)
                    keys.append(key)
                    fresh = key not in seen
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(key)
                    words.append(own.view(np.int64) if fresh else None)
                    seeds.append(h[b:e].view(np.int64) if fresh else None)
                    places.append((at[b:e] - run.first[t]) if fresh else None)
                long_list = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(ids)), pa.array(keys, pa.int64()), pa.array(words, long_list),
                     pa.array(seeds, long_list), pa.array(places, long_list)],
                    names=["id", "key", "words", "seeds", "places"],
                )
            row += len(run)


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, end and matches of the stretch with the greatest matches minus mismatches."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -1))])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.argmin(total[: end + 1]))
    return start, end, int(equal[start:end].sum())


def widest_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, end and matches of the stretch with most equal words of all whose share of
    equal words is at least ``IDENTITY``."""
    # in quarters, so that sums are exact: a stretch qualifies when its sum is not negative
    total = np.concatenate([[0], np.cumsum(np.where(equal, round(4 * (1 - IDENTITY)), -round(4 * IDENTITY)))])
    same = np.concatenate([[0], np.cumsum(equal)])
    starts = np.searchsorted(-np.minimum.accumulate(total), -total)  # the first not above each end
    end = int(np.argmax(same - same[starts]))
    at = np.flatnonzero(equal[starts[end] : end]) + starts[end]
    return (int(at[0]), int(at[-1]) + 1, len(at)) if len(at) else (0, 0, 0)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From key, item, from_word (of the text), from_item, and both runs of words."""
    for batch in batches:
        keep, starts, item_starts, sizes, matches = [], [], [], [], []
        for k, (doc_at, item_at, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)), strict=True)):
            x, y = batch.column(5)[k].values.to_numpy(), batch.column(6)[k].values.to_numpy()
            start, end, same = best_stretch(x == y)
            least = min(MATCHES, n - differing(n))
            if same < least or same < IDENTITY * (end - start):
                start, end, same = widest_stretch(x == y)
            if same >= least:
                keep.append(k)
                starts.append(doc_at + start)
                item_starts.append(item_at + start)
                sizes.append(end - start)
                matches.append(same)
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), *(pa.array(v, pa.int64()) for v in (starts, item_starts, sizes, matches))],
            names=["key", "item", "first_word", "item_word", "n_words", "n_equal"],
        )


def overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Per (document, item) that overlap: id, item, first_word and item_word (where the best
    overlap starts, words from 0), n_words and n_equal (its length and equal words)."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "decontaminate")
    source = benchmark.select(F.col(item_col).alias("item"), F.lower(F.col(item_text_col).cast("string")).alias("text"))
    kind = source.schema["item"].dataType.simpleString()
    items = scratch.put(
        source.mapInArrow(_items, f"item {kind}, words array<long>, seeds array<long>, places array<long>"), "items"
    )
    seeds = items.select("item", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select(
        "item", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place")
    )
    size = (1 << BITMAP_BITS) - 1
    slots = seeds.select(F.explode(F.array(
        F.col("seed").bitwiseAND(size), F.shiftright("seed", 32).bitwiseAND(size)
    )).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(slot & 63))")).alias("bits")
    )
    bits = np.zeros(1 << BITMAP_BITS - 6, np.int64)
    for row in words.toLocalIterator():
        bits[row["w"]] = row["bits"]
    bitmap = spark.sparkContext.broadcast(bits.view(U64))
    short = [r[0] for r in items.select(F.size("words").alias("n")).filter((F.col("n") >= LEAST) & (F.col("n") < SHORT)).distinct().collect()]

    texts = docs.select(F.col(id_col).alias("id"), F.lower(F.col(text_col).cast("string")).alias("text"))
    id_kind = texts.schema["id"].dataType.simpleString()
    hits = scratch.put(texts.mapInArrow(
        lambda b: _hits(b, bitmap, short),
        f"id {id_kind}, key long, words array<long>, seeds array<long>, places array<long>",
    ), "hits")

    once = hits.filter("words IS NOT NULL")
    places = once.select("key", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select(
        "key", F.col("s.seeds").alias("seed"), F.col("s.places").alias("at")
    )
    found = places.join(seeds, "seed").select("key", "item", (F.col("at") - F.col("place")).alias("diagonal")).distinct()
    bodies = once.groupBy("key").agg(F.first("words").alias("words"))
    own = items.select(F.col("item").alias("own"), F.col("words").alias("item_words"))
    both = found.join(own, F.col("item").eqNullSafe(F.col("own"))).join(bodies, "key")  # a null id is an id
    from_word = F.greatest("diagonal", F.lit(0))
    from_item = F.greatest(-F.col("diagonal"), F.lit(0))
    length = F.least(F.size("words") - from_word, F.size("item_words") - from_item).cast("int")
    cut = both.select(
        "key", "item", from_word.cast("long").alias("d"), from_item.cast("long").alias("i"),
        F.size("item_words").cast("long").alias("n"),
        F.slice("words", from_word.cast("int") + 1, length).alias("x"),
        F.slice("item_words", from_item.cast("int") + 1, length).alias("y"),
    )
    checked = cut.mapInArrow(
        _verified, f"key long, item {kind}, first_word long, item_word long, n_words long, n_equal long"
    )
    best = Window.partitionBy("key", "item").orderBy(F.desc("n_equal"), "n_words", "first_word", "item_word")
    one = checked.withColumn("r", F.row_number().over(best)).filter("r = 1").drop("r")
    named = hits.select("id", "key").distinct().join(one, "key")
    ranked = Window.partitionBy("id", "item").orderBy(F.desc("n_equal"), "n_words", "first_word", "item_word", "key")
    return named.withColumn("r", F.row_number().over(ranked)).filter("r = 1").select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "first_word", "item_word", "n_words", "n_equal"
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has no overlap, all columns as they are. Rows with one id, or none,
    are told apart by their texts."""
    row = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("t"))
    bad = overlaps(docs.select(row.alias("row"), F.col(text_col).alias("text")), benchmark, "row", "text")
    bad = bad.select(F.col("row.id").alias("__id"), F.col("row.t").alias("__t")).distinct()
    same = docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__t"))
    return docs.join(bad, same, "left_anti")
