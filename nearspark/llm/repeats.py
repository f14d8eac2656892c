"""Removal of repeated passages: seeds on winnowed anchors, extended both ways.

A passage is ``SIZE`` or more words. Of a passage that documents share, the document with the
smallest id keeps its words, the others lose theirs.

How it is made:

1. Winnowing: of the ``SIZE - SEED + 1`` runs of ``SEED`` words inside each window of ``SIZE`` words, the
   one with the least hash (the last of equal ones) is the window's anchor. Equal windows have equal
   anchors at equal places, whatever stands around them, and neighbouring windows mostly share
   theirs, so there is one anchor for about sixteen words.
2. Documents meet on their anchors. Anchors that only one document has end here.
3. An anchor is extended both ways as far as it is the anchor of its windows. If a smaller document has the
   same extension, all of it repeats. This settles whole groups of copies by one
   aggregation, without pairs of their members.
4. Where an anchor has several extensions (beside an edit, at the ends of a passage), matches
   stop somewhere within. There each of the anchor's windows is compared by itself, only for the
   smallest document of each extension: what another document with that extension shares, the
   smallest one shares too, so every window finds the smallest document that holds it.
5. What was found in steps 3 and 4 is united by document to maximal repeats, none of them shorter
   than ``SIZE``, and the document is written without them.

Step 3 and the rows of step 4 grow with the words, never with pairs. Aggregations start before
their exchange, joins have one side with a row per key and leave a hot key's other side to adaptive
execution, which splits it. Texts are exchanged only for documents with something to compare or to
remove; which these are is told by a bitmap of fixed size, which can let too many through, never too few.

Words and extensions are compared by 64-bit hashes, extensions and windows only behind equal anchors.

Defined results: a null text has no words. A row with a null id is compared with nothing and keeps its
words. Rows with one id are not smaller than each other, so they take nothing from each
other; equal rows come out alike, one each. A text that repeats itself keeps both places. Ids
are whole numbers; others raise an error. Texts below ``SIZE`` words and empty tables
pass as they are. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import whole
from .words import SPACES, U64, Ranges, Run, mix, rightmost_least, runs

SIZE = 50
SEED = 20
BITMAP_BITS = 26
#: Window hashes handed on at a time.
PILE = 1 << 18
#: Bytes of text whose words a task holds at a time.
RUN = 1 << 20
_WORD = re.compile(b"[^" + re.escape(SPACES) + b"]+")


def anchors(run: Run, size: int, seed: int) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, extension hash, first word, last word + 1) of each anchor of a run of texts; the
    extension are the words of all windows that have this anchor, by their place in the text."""
    n = len(run.hashes) - size + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none.astype(U64), none.astype(U64), none, none
    texts = np.repeat(np.arange(len(run)), np.diff(run.first))
    inside = np.flatnonzero(texts[:n] == texts[size - 1 :])
    ranges, at = Ranges(run.hashes), np.arange(len(run.hashes) - seed + 1)
    grams = ranges(at, at + seed)
    anchor = rightmost_least(grams, size - seed + 1)[inside]
    # windows with one anchor are neighbours; an anchor lies in one text
    new = np.flatnonzero(np.diff(anchor, prepend=-1))
    lo, hi = inside[new], inside[np.append(new[1:], len(inside)) - 1] + size if len(new) else inside
    anchor, text = anchor[new], texts[lo]
    with np.errstate(over="ignore"):
        extension = mix(ranges(lo, hi) + mix((anchor - lo).astype(U64), 9))
    start = run.first[text]
    return text, grams[anchor], extension, lo - start, hi - start


def _anchor_rows(batches: Iterator[pa.RecordBatch], size: int, seed: int) -> Iterator[pa.RecordBatch]:
    """From (doc, t, text): (doc, t, anchor, extension, lo, hi)."""
    for batch in batches:
        for run in runs(batch.column(2), fold=False, size=RUN):
            text, anchor, extension, lo, hi = anchors(run, size, seed)
            rows = pa.array(run.row + text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(anchor.view(np.int64)),
                 pa.array(extension.view(np.int64)), pa.array(lo), pa.array(hi)],
                names=["doc", "t", "anchor", "extension", "lo", "hi"],
            )


def _window_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """From (doc, t, text, spans of (anchor, lo, hi)): (doc, t, anchor, window, lo) of all windows in them."""
    for batch in batches:
        spans = batch.column(3)
        first, flat = spans.offsets.to_numpy(), spans.values
        anchor, low, high = (flat.field(name).to_numpy() for name in ("anchor", "lo", "hi"))
        for run in runs(batch.column(2), fold=False, size=RUN):
            ranges = Ranges(run.hashes)
            at = np.arange(first[run.row], first[run.row + len(run)])
            text = np.repeat(np.arange(len(run)), np.diff(first[run.row : run.row + len(run) + 1]))
            count = high[at] - low[at] - size + 1
            for part in np.array_split(np.arange(len(at)), 1 + int(count.sum()) // PILE):
                many = count[part]
                which = np.repeat(part, many)
                lo = low[at[which]] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
                place = run.first[text[which]] + lo
                rows = pa.array(run.row + text[which])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(anchor[at[which]]),
                     pa.array(ranges(place, place + size).view(np.int64)), pa.array(lo)],
                    names=["doc", "t", "anchor", "window", "lo"],
                )


class _Bitmap:
    """Hashes of ids in a bitmap of fixed size."""

    def __init__(self, ids: DataFrame, bits: int = BITMAP_BITS):
        slot = F.xxhash64("doc").bitwiseAND((1 << bits) - 1)
        words = ids.groupBy(F.shiftright(slot, 6).alias("w")).agg(
            F.bit_or(F.expr("shiftleft(1L, int(xxhash64(doc) & 63))")).alias("bits")
        ).toArrow()
        self.size = bits
        self.bits = np.zeros(1 << bits - 6, np.int64)
        self.bits[words["w"].to_numpy()] = words["bits"].to_numpy()

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.view(U64) & U64((1 << self.size) - 1)
        return (self.bits.view(U64)[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1) != 0


def _filtered(batches: Iterator[pa.RecordBatch], shared, wanted: bool) -> Iterator[pa.RecordBatch]:
    """Rows whose last column, the hash of the id, is in the bitmap (or is not); null ids are not."""
    for batch in batches:
        hashes = batch.column(batch.num_columns - 1)
        keep = shared.value(hashes.fill_null(0).to_numpy(zero_copy_only=False)) & hashes.is_valid().to_numpy(zero_copy_only=False)
        yield batch.filter(pa.array(keep if wanted else ~keep)).select(range(batch.num_columns - 1))


def _picked(rows: DataFrame, ids: DataFrame, wanted: bool = True, bitmap=None) -> DataFrame:
    """Rows (doc, t, text) whose id is, or surely is not, among ``ids``."""
    bitmap = bitmap or rows.sparkSession.sparkContext.broadcast(_Bitmap(ids))
    hashed = rows.withColumn("hash", F.when(F.col("doc").isNotNull(), F.xxhash64("doc")))
    return hashed.mapInArrow(lambda b: _filtered(b, bitmap, wanted), rows.schema)


def repeated_spans(rows: DataFrame, scratch: Scratch, size: int = SIZE, seed: int = SEED) -> DataFrame:
    """From (doc, t, text): (doc, t, spans), the places (lo, hi) in the text whose windows
    all start in a document with a smaller id too; they may overlap."""
    found = rows.filter("doc IS NOT NULL AND text <> ''").mapInArrow(
        lambda b: _anchor_rows(b, size, seed), "doc long, t long, anchor long, extension long, lo long, hi long"
    )
    found = scratch.put(found, "anchors")
    extensions = found.groupBy("anchor", "extension").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    shared = extensions.groupBy("anchor").agg(
        F.count("*").alias("kinds"), F.min("least").alias("low"), F.max("most").alias("high")
    ).filter("low < high").select("anchor", (F.col("kinds") > 1).alias("several"))
    shared = extensions.join(shared, "anchor").filter("several OR least < most").select("anchor", "extension", "least", "several")
    matched = scratch.put(
        found.join(shared, ["anchor", "extension"]).filter("doc > least OR several")
        .select("doc", "t", "anchor", "lo", "hi", (F.col("doc") > F.col("least")).alias("repeats")), "matched",
    )
    scratch.drop(found)
    partly = matched.filter("NOT repeats").groupBy("doc", "t").agg(F.collect_list(F.struct("anchor", "lo", "hi")).alias("spans"))
    texts = _picked(rows, matched.filter("NOT repeats").select("doc").distinct())
    windows = scratch.put(
        texts.join(partly, ["doc", "t"]).select("doc", "t", "text", "spans").mapInArrow(
            lambda b: _window_rows(b, size), "doc long, t long, anchor long, window long, lo long"
        ), "windows",
    )
    owners = windows.groupBy("anchor", "window").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most")
    later = windows.join(owners.drop("most"), ["anchor", "window"]).filter("doc > least")
    spans = matched.filter("repeats").select("doc", "t", "lo", "hi").unionByName(
        later.select("doc", "t", "lo", (F.col("lo") + size).alias("hi"))
    )
    spans = scratch.put(
        spans.groupBy("doc", "t").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "spans"
    )
    scratch.drop(matched, windows)
    return spans


def covered(spans: Iterable[tuple[int, int]] | np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a span."""
    edges = np.zeros(n + 1, np.int64)
    pairs = np.asarray(spans, np.int64).reshape(-1, 2)
    np.add.at(edges, pairs[:, 0], 1)
    np.add.at(edges, pairs[:, 1], -1)
    return np.cumsum(edges[:-1]) > 0


def _kept(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """From (doc, text[, spans]): (doc, n_words, n_removed, kept text or its hash)."""
    for batch in batches:
        n_words, n_removed, out = [], [], []
        for row, text in enumerate(batch.column(1).cast(pa.large_binary())):
            words = _WORD.findall(text.as_py())
            gone = 0
            if batch.num_columns > 2:
                spans = batch.column(2)[row].values
                cover = covered(np.stack([spans.field(name).to_numpy() for name in ("lo", "hi")], 1), len(words))
                gone = int(cover.sum())
                words = [words[k] for k in np.flatnonzero(~cover)]
            kept = b" ".join(words)
            n_words.append(gone + len(words))
            n_removed.append(gone)
            out.append(kept.decode() if texts else hashlib.sha256(kept).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(out, pa.string())],
            names=["doc", "n_words", "n_removed", "kept"],
        )


def remove_repeats(
    docs: DataFrame, size: int = SIZE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", texts: bool = True
) -> DataFrame:
    """Per row: id, n_words, n_removed and the words that stay, joined by blanks (``kept_text``),
    or with ``texts=False`` their hash (``kept_sha256``)."""
    if not 0 < seed <= size:
        raise ValueError(f"a seed of {seed} words in windows of {size}")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), whole(F.col(text_col)).alias("text")).select(
        "doc", F.xxhash64("text").alias("t"), "text"
    )
    scratch = Scratch(docs.sparkSession, "repeats")
    spans = repeated_spans(rows, scratch, size, seed)
    bitmap = rows.sparkSession.sparkContext.broadcast(_Bitmap(spans.select("doc")))
    out = "doc long, n_words long, n_removed long, kept string"
    untouched = _picked(rows, spans, False, bitmap).select("doc", "text").mapInArrow(lambda b: _kept(b, texts), out)
    touched = _picked(rows, spans, True, bitmap).join(spans, ["doc", "t"], "left").select(
        "doc", "text", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans")
    ).mapInArrow(lambda b: _kept(b, texts), out)
    result = scratch.put(untouched.unionByName(touched), "result")
    scratch.drop(spans)
    return result.select(
        F.col("doc").alias(id_col), "n_words", "n_removed", F.col("kept").alias("kept_text" if texts else "kept_sha256")
    )
