"""Sharding by histogram sort: equal bytes per shard over a sort key.

Rows are ordered by (key, place), place being the row's position in the written table, so that no
two rows tie even where one key holds a third of them. The key's range is cut into cells.
Each round counts exact bytes and rows of the cells across all partitions and refines only
the cells that must be: those in which a shard has to end and that hold more bytes than the
tolerance, and those with more rows than one task of the exchange should get. When no cell is left to
refine, shards end at cell borders, every cell has its shard and first slot, and the rows
are exchanged once, by cell, and numbered within it.

The driver holds cells, not rows: each round leaves at most one cell per row limit or splitter,
times ``FAN``. Only id, size and checksum are exchanged, never texts. Everything is
DataFrame functions.

Defined results: a null key sorts before all others; a null text has size 1; repeated rows
get slots of their own; an empty table gives no rows; a row larger than a shard's share fills
a shard alone, and later ones may then be empty; other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

SHARDS = 8
#: Shards end at most this part of an equal share from where they should.
TOLERANCE = 0.002
#: Rows a cell may keep, so a task of the exchange numbers few enough.
CELL_ROWS = 1 << 20
#: Cells a cell is cut into in one round, as a power of two.
FAN_BITS = 5
LOW = -(2**63)


class Cell(NamedTuple):
    """Rows whose key >> shift is ``a`` (``place`` None), or whose key is ``a`` and
    place >> shift is ``b``."""

    shift: int
    a: int
    b: int | None = None


def _cell(shift: int, on_place: bool) -> tuple[Column, Column]:
    if on_place:
        return F.col("key"), F.shiftright("place", shift)
    return F.shiftright("key", shift), F.lit(0).cast("long")


def _counted(rows: DataFrame, shift: int, on_place: bool) -> list:
    a, b = _cell(shift, on_place)
    return rows.groupBy(a.alias("a"), b.alias("b")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()


def _cells_table(spark, cells: list[tuple]) -> DataFrame:
    return spark.createDataFrame(cells, "ca long, cb long")


def histogram(rows: DataFrame, shards: int, tolerance: float, cell_rows: int) -> list[tuple]:
    """The final cells in sort order: (shift, on_place, a, b, bytes, rows)."""
    spark = rows.sparkSession
    lo, hi = rows.agg(F.min("key"), F.max("key")).first()
    if lo is None:
        return []
    shift = max(0, (hi - lo).bit_length() - FAN_BITS)
    level, on_place = (shift, False), False
    pending = _counted(rows, shift, False)
    total = sum(r["bytes"] for r in pending)
    slack = int(tolerance * total / shards)
    done: list[tuple] = []
    while pending:
        shift, on_place = level
        every = sorted(
            done + [(shift, on_place, r["a"], r["b"], r["bytes"], r["rows"]) for r in pending], key=_order
        )
        refine, done, below = [], [], 0
        for c in every:
            cut = any(below < total * s // shards < below + c[4] for s in range(1, shards))
            heavy = c[5] > cell_rows or (cut and c[4] > slack)
            fresh = (c[0], c[1]) == level
            (refine if heavy and fresh and c[5] > 1 else done).append(c)
            below += c[4]
        if not refine:
            break
        wanted = _cells_table(spark, [(c[2], c[3]) for c in refine])
        a, b = _cell(*level)
        inside = rows.join(F.broadcast(wanted), (a == F.col("ca")) & (b == F.col("cb")), "left_semi")
        if shift > 0:
            level = (max(0, shift - FAN_BITS), on_place)
        elif not on_place:
            level = (_place_shift(inside), True)
        else:
            done += refine
            break
        pending = _counted(inside, *level)
    return sorted(done, key=_order)


def _place_shift(rows: DataFrame) -> int:
    top = rows.agg(F.max("place")).first()[0]
    return max(0, top.bit_length() - FAN_BITS)


def _order(c: tuple) -> tuple[int, int]:
    """The smallest (key, place) that falls into the cell."""
    shift, on_place, a, b = c[:4]
    return (a, b << shift) if on_place else (a << shift, -1)


def assign(
    docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, cell_rows: int = CELL_ROWS,
    id_col: str = "doc_id", text_col: str = "text", key: Column | None = None,
) -> DataFrame:
    """Per row: id, size (UTF-8 bytes plus 1), text_crc32, shard, and slot, which counts the
    rows of a shard from 0 without gaps in sort order. The key is the id unless given."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "sharding")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    compact = scratch.put(docs.select(
        F.col(id_col).alias("id"),
        F.coalesce((F.col(id_col) if key is None else key).cast("long"), F.lit(LOW)).alias("key"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
    ), "rows")
    # files of a written table do not change, so (file, row) names a row on every later read
    files = [r[0] for r in compact.select(F.col("_metadata.file_name").alias("f")).distinct().orderBy("f").collect()]
    numbers = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "f string, i long")
    rows = compact.select("*", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("r")).join(
        F.broadcast(numbers), "f"
    ).select("id", "key", "size", "crc", (F.shiftleft("i", 40) + F.col("r")).alias("place"))

    cells = histogram(rows, shards, tolerance, cell_rows)
    total = sum(c[4] for c in cells)
    placed, below, shard, slot = [], 0, 0, 0
    for n, c in enumerate(cells):
        # a shard ends at the cell border nearest to its share of the bytes
        while shard < shards - 1 and 2 * (total * (shard + 1) // shards) < 2 * below + c[4]:
            shard, slot = shard + 1, 0
        placed.append((c[0], c[1], c[2], c[3], n, shard, slot))
        below += c[4]
        slot += c[5]
    columns = "id", "key", "size", "crc", "place"
    found = rows
    levels = sorted({(c[0], c[1]) for c in placed})
    for k, (shift, on_place) in enumerate(levels):
        table = spark.createDataFrame(
            [(c[2], c[3], (c[4], c[5], c[6])) for c in placed if (c[0], c[1]) == (shift, on_place)],
            f"a{k} long, b{k} long, hit{k} struct<cell:int,shard:int,first:long>",
        )
        a, b = _cell(shift, on_place)
        found = found.join(F.broadcast(table), (a == F.col(f"a{k}")) & (b == F.col(f"b{k}")), "left").drop(f"a{k}", f"b{k}")
    hit = F.coalesce(*(F.col(f"hit{k}") for k in range(len(levels)))) if levels else F.lit(None).cast("struct<cell:int,shard:int,first:long>")
    own = found.select(*columns, hit.alias("h")).select(*columns, "h.*")
    order = Window.partitionBy("cell").orderBy("key", "place")
    return own.withColumn("n", F.row_number().over(order)).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("first") + F.col("n") - 1).alias("slot"),
    )
