"""Fill-in-the-middle texts, put together by a secondary sort.

A text of n code points is cut after ``a`` and ``b`` of them (the smaller and the larger of two
numbers drawn from the id), which leaves prefix, middle and suffix. What is put out is, by form,

- ``plain``: the text as it is,
- ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle,
- ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.

How it is made:

1. Every row emits its marks and its parts, in pieces of at most ``UNIT`` code points, each
   keyed by the row and by the place in the output.
2. Repartitioning by row and sorting within partitions (``repartition`` with
   ``sortWithinPartitions``, which is ``repartitionAndSortWithinPartitions`` for data frames and
   spills on the JVM's side) brings the pieces of a row together in output order, and they
   stream into whatever reads them: ``digests`` feeds an incremental hash, ``pieces`` hands them
   on. No text is put together in memory, however long it is.
3. For the way back the output stream alone is read: its marks are found again, also across
   pieces, and what stands behind each is keyed by its place in the text. Sorting the same partitions
   by that, without another exchange, streams the text into the second hash.

A row's key is a 128-bit hash of id and text, with the number of the task that read the row, so
equal rows (a third of the table may be one) meet only as far as one task read them. Equal
pieces of equal rows lie side by side: one is used, and the first one's number of copies says how many
rows come out. A retried task makes the same keys whatever order its rows have.

Defined results: a null text is the empty one; an empty text is plain; a null id draws from
``1:`` alone; equal rows give equal rows, one each; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .text import whole

#: Code points of a piece, and of an Arrow batch of pieces.
UNIT = 16_384
BATCH = 4 << 20
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: The marks of the output, and the order of the parts behind them by form.
MARK = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
ORDER = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
#: Place of each part in the text.
PLACE = {"prefix": 0, "middle": 1, "suffix": 2}


def _draw(digest: Column, number: int) -> Column:
    """A group of eight hexadecimal digits as an unsigned integer."""
    return F.conv(F.substring(digest, 1 + 8 * number, 8), 16, 10).cast("long")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id, text, n, form, a, b``, the cuts null for plain texts."""
    seed = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id_col).alias("id"), whole(F.col(text_col)).alias("text"), seed.alias("seed"))
    n = F.length("text").cast("long")
    marked = F.lit(False)
    for mark in MARK.values():
        marked = marked | F.contains("text", F.lit(mark))
    form = (
        F.when((n == 0) | marked | (_draw(F.col("seed"), 2) % 100 >= 100 - PLAIN_PERCENT), "plain")
        .when(_draw(F.col("seed"), 3) % 100 < SPM_PERCENT, "spm").otherwise("psm")
    )
    one, two = (_draw(F.col("seed"), k) % (n + 1) for k in (0, 1))
    cut = F.col("form") != "plain"
    return rows.select("id", "text", n.alias("n"), form.alias("form"), one.alias("one"), two.alias("two")).select(
        "id", "text", "n", "form", F.when(cut, F.least("one", "two")).alias("a"), F.when(cut, F.greatest("one", "two")).alias("b")
    )


KEY = ("k1", "k2", "task")
_key, _place = itemgetter(0, 1, 2), itemgetter(3)


def _fields(id_kind: str) -> str:
    """Rows of the stream: the key, the place, the text of a piece, or else the head of a row."""
    return (
        f"k1 long, k2 long, task int, place long, piece string, "
        f"head struct<id {id_kind}, n long, form string, a long, b long, copies long, output string>"
    )


def _streamed(work: Callable[[Iterator[tuple]], Iterator[tuple]], schema: pa.Schema) -> Callable:
    """``work`` on the rows of a partition, as a function of its Arrow batches."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
            )

        for row in work(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            rows.append(row)
            size += 200 + sum(len(v) for v in row if isinstance(v, str))
            if size > BATCH:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()

    return stream


def _run(df: DataFrame, work: Callable, fields: str) -> DataFrame:
    return df.mapInArrow(_streamed(work, to_arrow_schema(StructType.fromDDL(fields))), fields)


def _cut(rows: Iterable[tuple]) -> Iterator[tuple]:
    """The pieces of each row (k1, k2, task, id, text, n, form, a, b); the head comes first."""
    for k1, k2, task, id_, text, n, form, a, b in rows:
        yield k1, k2, task, 0, None, (id_, n, form, a, b, None, None)
        place = 1
        if form == "plain":
            parts = [("", text)]
        else:
            span = {"prefix": (0, a), "middle": (a, b), "suffix": (b, len(text))}
            parts = [(MARK[name], text[slice(*span[name])]) for name in ORDER[form]]
        for mark, part in parts:
            for piece in (mark, *(part[at : at + UNIT] for at in range(0, len(part), UNIT))):
                if piece:
                    yield k1, k2, task, place, piece, None
                    place += 1


def _rows(pieces: Iterable[tuple]) -> Iterator[tuple[tuple, int, tuple, Iterator[str]]]:
    """(key, copies, head, texts behind it) per row of a stream that is sorted by key and place."""
    for key, own in groupby(pieces, _key):
        places = groupby(own, _place)
        heads = next(places)[1]
        head = tuple(next(heads)[5].values())
        yield key, 1 + sum(1 for _ in heads), head, (next(same)[4] for _, same in places)


def sorted_pieces(planned: DataFrame) -> DataFrame:
    """The pieces of all rows, those of a row together and in output order."""
    keyed = planned.select(
        F.xxhash64("id", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "id").alias("k2"), F.spark_partition_id().alias("task"),
        "id", "text", "n", "form", "a", "b",
    )
    pieces = _run(keyed, _cut, _fields(planned.schema["id"].dataType.simpleString()))
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "place")


def parse(pieces: Iterable[str], form: str) -> Iterator[tuple[str, str]]:
    """(part, text) from the output alone, in output order. The marks stand in it once each, but
    a piece may end inside one."""
    if form == "plain":
        yield from (("prefix", piece) for piece in pieces)
        return
    wanted, part, rest = list(ORDER[form]), None, ""
    for piece in pieces:
        rest += piece
        while wanted and (at := rest.find(MARK[wanted[0]])) >= 0:
            if at:
                yield part, rest[:at]
            part = wanted.pop(0)
            rest = rest[at + len(MARK[part]) :]
        keep = len(MARK["prefix"]) - 1 if wanted else 0
        if len(rest) > keep:
            yield part, rest[: len(rest) - keep]
            rest = rest[len(rest) - keep :]
    if rest:
        yield part, rest


def _assembled(pieces: Iterable[tuple]) -> Iterator[tuple]:
    """Hash of each output, and its parts keyed by their place in the text."""
    for key, copies, head, texts in _rows(pieces):
        output, seen = hashlib.sha256(), dict.fromkeys(PLACE, 0)

        def read(texts=texts, output=output):
            for text in texts:
                output.update(text.encode())
                yield text

        for part, text in parse(read(), head[2]):
            seen[part] += 1
            yield *key, (1 + PLACE[part] << 48) + seen[part], text, None
        yield *key, 0, None, (*head[:5], copies, output.hexdigest())


def _restored(pieces: Iterable[tuple]) -> Iterator[tuple]:
    for _, _, head, texts in _rows(pieces):
        text = hashlib.sha256()
        for piece in texts:
            text.update(piece.encode())
        id_, n, form, a, b, copies, output = head
        for _ in range(copies):
            yield id_, n, form, a, None if a is None else b - a, output, text.hexdigest()


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256; the last
    is of the text that was read back from the output."""
    planned = plan(docs, id_col, text_col)
    kind = planned.schema["id"].dataType.simpleString()
    again = _run(sorted_pieces(planned), _assembled, _fields(kind)).sortWithinPartitions(*KEY, "place")
    return _run(
        again, _restored,
        f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string",
    ).withColumnRenamed("id", id_col)


def _numbered(pieces: Iterable[tuple]) -> Iterator[tuple]:
    for key, copies, head, texts in _rows(pieces):
        name = f"{key[0] % 2**64:016x}{key[1] % 2**64:016x}{key[2]:x}"
        yield name, head[0], head[2], copies, 0, ""
        for place, text in enumerate(texts, 1):
            yield name, head[0], head[2], copies, place, text


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The outputs themselves: ``row_key, id, form, copies, place, piece``, in order within a
    partition. Joined by place the pieces of a row key are its output, which stands for
    ``copies`` equal rows; place 0 is empty, so that empty texts have a row too."""
    planned = plan(docs, id_col, text_col)
    kind = planned.schema["id"].dataType.simpleString()
    return _run(
        sorted_pieces(planned), _numbered, f"row_key string, id {kind}, form string, copies long, place long, piece string"
    ).withColumnRenamed("id", id_col)
