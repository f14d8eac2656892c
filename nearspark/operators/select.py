"""Projection, sort, limit, and the select that combines them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import column, data_type, output_columns, parse_output_columns
from .predicates import (
    NULL_CONDITIONS,
    RANGE_CONDITIONS,
    combine_columns,
    compare,
    condition_column,
    filter_rows,
)
from .sizing import BOUND_SLICE, MAX_BROADCAST_ROWS, bound_slice, small_row_count

DEFAULT_LIMIT = 50
#: Rows of a quantile bucket of a band join, and the most buckets there may be.
BUCKET_ROWS = 50_000
MAX_BUCKETS = 4096
#: Items of a key from which on their bounds are cut into cells of about so many.
CELL_ITEMS = 32
#: Rows of a table for each slice in which an item's limit is applied first.
SLICE_ROWS = 1_000_000


def project_columns(df: DataFrame, columns: str | Iterable[str] | None = None) -> DataFrame:
    """The named columns in the given order; all of them for an empty list."""
    return df.select(*output_columns(df, columns))


def sort_names(rules: Iterable) -> list[tuple[str, bool]]:
    """Sort rules as ``(column, descending)``; any direction but ``DESC`` is ascending."""
    found = []
    for rule in rules or ():
        if isinstance(rule, Mapping):
            rule = (rule["column"], rule.get("direction", "ASC"))
        name, direction = (rule, "ASC") if isinstance(rule, str) else rule
        found.append((name, direction == "DESC"))
    return found


def sort_order(df: DataFrame, rules: Iterable) -> list[Column]:
    """Sort keys with NULL as the largest value, for both directions."""
    return [
        column(df, n).desc_nulls_first() if descending else column(df, n).asc_nulls_last()
        for n, descending in sort_names(rules)
    ]


def sort_rows(df: DataFrame, rules: Iterable) -> DataFrame:
    keys = sort_order(df, rules)
    return df.orderBy(*keys) if keys else df


def check_limit(limit: int) -> int:
    if limit < 1:
        raise ValueError("limit must be at least 1")
    return limit


def limit_rows(df: DataFrame, limit: int = DEFAULT_LIMIT, return_all: bool = False) -> DataFrame:
    return df if return_all else df.limit(check_limit(limit))


def select_rows(
    df: DataFrame,
    columns: str | Iterable[str] | None = None,
    where: Iterable = (),
    combine: str = "AND",
    sort: Iterable = (),
    limit: int = DEFAULT_LIMIT,
    return_all: bool = False,
) -> DataFrame:
    """Filter, sort, limit and project; sort and filter may use columns not projected."""
    rows = limit_rows(sort_rows(filter_rows(df, where, combine), sort), limit, return_all)
    return project_columns(rows, columns)


def _item_value(df: DataFrame, items: DataFrame, name: str, condition: str, source: str) -> Column:
    """An item's parameter in a form comparable with the column ``name``."""
    value = F.col(f"p_{source}")
    target, given = data_type(df, name), data_type(items, source)
    if "LIKE" in condition:
        return value.cast("string")
    if isinstance(target, T.NumericType):
        if isinstance(given, T.NumericType):
            return value
        if condition in RANGE_CONDITIONS:
            return value.cast("double")
    return value.cast(target)


def _as_double(value: Column, dtype: T.DataType) -> Column | None:
    """An order-keeping double of a column, None for types that have none."""
    if isinstance(dtype, T.NumericType):
        return value.cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value).cast("double")
    return None


class _Band(NamedTuple):
    """Range conditions on one column, and the quantiles that cut the column into buckets.

    The bucket number grows with the value, so an interval of values is an interval of buckets.
    """

    name: str
    dtype: T.DataType
    splits: list[float]
    lows: list[Column]
    highs: list[Column]

    @classmethod
    def of(cls, df: DataFrame, items: DataFrame, clauses: list[tuple], combine: str, rows: int) -> _Band | None:
        """The band of the column with most range conditions; None if a row may match without them."""
        ranges: dict[str, list[tuple]] = {}
        for name, condition, source in clauses if combine != "OR" or len(clauses) == 1 else ():
            if condition in RANGE_CONDITIONS and _as_double(F.lit(None), data_type(df, name)) is not None:
                ranges.setdefault(name, []).append((condition, source))
        if not ranges:
            return None
        name = max(ranges, key=lambda n: len(ranges[n]))
        dtype, lows, highs = data_type(df, name), [], []
        for condition, source in ranges[name]:
            value = _item_value(df, items, name, condition, source)
            number = value.cast("double") if isinstance(dtype, T.NumericType) else _as_double(value, dtype)
            (lows if condition[0] == ">" else highs).append(number)
        count = min(MAX_BUCKETS, max(16, -(-rows // BUCKET_ROWS)))
        values = df.select(_as_double(column(df, name), dtype).alias("v"))
        inner = values.approxQuantile("v", [i / count for i in range(1, count)], 1 / (4 * count)) if rows else []
        inside = sorted({float(v) for v in inner if abs(v) != float("inf")}) or [0.0]
        return cls(name, dtype, [-float("inf"), *inside, float("inf")], lows, highs)

    def within(self, bound: Column, descending: bool) -> _Band:
        """The band of rows that sort up to a bound on its column."""
        number = _as_double(bound, self.dtype)
        return self._replace(lows=[*self.lows, number]) if descending else self._replace(highs=[*self.highs, number])

    def numbered(self, df: DataFrame, value: str, bucket: str) -> DataFrame:
        """``df`` with the bucket of its double column ``value``; NaN, the greatest, comes last."""
        cut = Bucketizer(splits=self.splits, inputCol=value, outputCol=bucket, handleInvalid="keep")
        return cut.transform(df).withColumn(bucket, F.col(bucket).cast("int")).drop(value)

    def join(self, df: DataFrame, params: DataFrame, on: Column, how: str = "inner") -> DataFrame:
        """Rows with the parameter rows they satisfy: both sides meet by bucket."""
        # greatest and least pass over NULL, which limits nothing
        open_low, open_high = F.lit(-float("inf")), F.lit(float("nan"))
        low, high = F.greatest(open_low, open_low, *self.lows), F.least(open_high, open_high, *self.highs)
        asked = self.numbered(params.withColumn("_v", low), "_v", "_from")
        asked = self.numbered(asked.withColumn("_v", high), "_v", "_to")
        every = F.explode(F.sequence("_from", "_to")).alias("_bucket")
        asked = asked.filter("_from <= _to").select(*params.columns, every)
        rows = df.withColumn("_v", _as_double(column(df, self.name), self.dtype))
        if how == "inner":
            rows = rows.filter(F.col("_v").isNotNull())
        rows = self.numbered(rows, "_v", "_cell")
        if small_row_count(asked) is not None:
            asked = F.broadcast(asked)
        return rows.join(asked, (F.col("_cell") == F.col("_bucket")) & on, how).drop("_cell", "_bucket")


def _match_items(
    df: DataFrame, params: DataFrame, on: Column, has_key: bool, unique: str | None, slices: int,
    band: _Band | None, how: str = "inner",
) -> DataFrame:
    """Rows of ``df`` joined with the parameter rows they satisfy, or those that satisfy none.

    An equality key gives an ordinary join, or one with a broadcast side where the parameter table was
    measured to be small. Otherwise a range condition gives a band join, in which rows and items meet by
    quantile buckets. What is left must compare every row with every parameter: small
    parameter tables are broadcast, larger ones meet the rows in a grid: each row goes to one slice and
    every block, each parameter row to one block and every slice, so each pair meets
    exactly once and no grid cell depends on how values are distributed.
    """
    if band is not None and not has_key:
        return band.join(df, params, on, how)
    rows = small_row_count(params)
    if rows is not None:
        return df.join(F.broadcast(params), on, how)
    if has_key or how != "inner" or unique is None:
        return df.join(params, on, how)
    blocks = max(1, params.count() // MAX_BROADCAST_ROWS)
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = df.withColumn("_slice", F.pmod(F.xxhash64(column(df, unique)), F.lit(slices)).cast("int"))
    left = left.withColumn("_block", spread(blocks))
    right = params.withColumn("_b", F.pmod(F.xxhash64(*params.columns), F.lit(blocks)).cast("int"))
    right = right.withColumn("_s", spread(slices))
    cell = (F.col("_slice") == F.col("_s")) & (F.col("_block") == F.col("_b"))
    return left.join(right, cell & on, "inner").drop("_slice", "_block", "_b", "_s")


def _not_after(keys: list[tuple[Column, bool]], bounds: list[Column]) -> Column:
    """Whether a row sorts at or before a bound; keys are ``(column, descending)``.

    NULL is the largest value, as in :func:`sort_order`.
    """
    result = F.lit(True)
    for (key, descending), bound in reversed(list(zip(keys, bounds))):
        if descending:
            before = F.coalesce(key > bound, key.isNull() & bound.isNotNull())
        else:
            before = F.coalesce(key < bound, key.isNotNull() & bound.isNull())
        result = before | (key.eqNullSafe(bound) & result)
    return result


def _first_rows(rows: DataFrame, group: list[str], keys: list[Column], limit: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*keys))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= limit)


def _item_conditions(
    df: DataFrame, items: DataFrame, clauses: list[tuple], combine: str
) -> tuple[list[str], Column, bool]:
    """Item columns the clauses use, the clauses over them, and whether an equality must hold."""
    names = list(dict.fromkeys(v for _, c, v in clauses if c not in NULL_CONDITIONS))
    parts = []
    for name, condition, source in clauses:
        if condition in NULL_CONDITIONS:
            parts.append(condition_column(df, (name, condition)))
        else:
            value = _item_value(df, items, name, condition, source)
            parts.append(compare(column(df, name), condition, value))
    has_key = combine != "OR" and any(c in ("=", "equal") for _, c, _ in clauses)
    return names, combine_columns(parts, combine) if parts else F.lit(True), has_key


def match_params(
    df: DataFrame, items: DataFrame, clauses: list[tuple], ordinal: str | None = None, how: str = "inner"
) -> DataFrame:
    """Rows of ``df`` joined with the least ``ordinal`` of each set of parameters that satisfies all
    clauses; with ``how="left_anti"`` the rows no item satisfies."""
    names, on, has_key = _item_conditions(df, items, clauses, "AND")
    renamed = [column(items, n).alias(f"p_{n}") for n in names]
    params = items.groupBy(*renamed).agg(F.min(ordinal).alias(ordinal)) if ordinal else items.select(*renamed).distinct()
    band = None if has_key else _Band.of(df, items, clauses, "AND", df.count())
    return _match_items(df, params, on, has_key, None, 1, band, how)


def match_first(df: DataFrame, items: DataFrame, clauses: list[tuple], ordinal: str) -> DataFrame:
    """Rows of ``df`` with items that satisfy all clauses, among them the one with the least ``ordinal``.

    Where equalities and ranges of one column decide and many items share a key, the column is cut into cells at
    quantiles of the items' bounds. An item covers whole cells between those of its bounds, and these are a few nodes
    of a binary tree over the cells, of which only the least ordinal counts. Rows are compared with
    the items that have a bound in their cell, and take the least of the nodes above it.
    """
    ranges = {n for n, c, _ in clauses if c in RANGE_CONDITIONS}
    equal = [(n, c, v) for n, c, v in clauses if c in ("=", "equal")]
    plain = all(c in RANGE_CONDITIONS or c in NULL_CONDITIONS or c in ("=", "equal") for _, c, _ in clauses)
    name = next(iter(ranges)) if len(ranges) == 1 and plain else None
    if name is None or _as_double(F.lit(None), data_type(df, name)) is None:
        return match_params(df, items, clauses, ordinal)
    names, on, _ = _item_conditions(df, items, clauses, "AND")
    params = items.groupBy(*[column(items, n).alias(f"p_{n}") for n in names]).agg(F.min(ordinal).alias(ordinal))
    params = params.filter(combine_columns([F.col(f"p_{n}").isNotNull() for n in names]))  # NULL matches nothing
    keys = list(dict.fromkeys(f"p_{v}" for _, _, v in equal))
    most = params.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if most <= CELL_ITEMS:
        return match_params(df, items, clauses, ordinal)
    band = _Band.of(df, items, [c for c in clauses if c[0] == name], "AND", 0)
    params = params.withColumn("_low", F.greatest(*[F.lit(-float("inf"))] * 2, *band.lows)).withColumn(
        "_high", F.least(*[F.lit(float("nan"))] * 2, *band.highs)
    )
    count = min(MAX_BUCKETS, max(2, most // CELL_ITEMS))
    ends = [f"_{end}" for end, given in (("low", band.lows), ("high", band.highs)) if given]
    bounds = params.select(F.explode(F.array(*ends)).alias("v"))
    inner = bounds.approxQuantile("v", [i / count for i in range(1, count)], 1 / (4 * count))
    inside = sorted({float(v) for v in inner if abs(v) != float("inf")}) or [0.0]
    band = band._replace(splits=[-float("inf"), *inside, float("inf")])
    cells = len(band.splits)  # the last one is that of NaN
    params = band.numbered(band.numbered(params, "_low", "_from"), "_high", "_to")
    # without a bound on a side the first or the last cell is covered too
    first = F.col("_from") + 1 if band.lows else F.lit(0)
    end = F.col("_to") if band.highs else F.lit(cells)
    levels, nodes = cells.bit_length() + 1, []
    for level in range(levels):
        left, right = F.ceil(first / (1 << level)), F.floor(end / (1 << level))
        some = left < right
        nodes += [
            F.when(some & (left % 2 == 1), left + (level << 20)), F.when(some & (right % 2 == 1), right - 1 + (level << 20)),
        ]
    covers = params.select(*keys, ordinal, F.explode(F.array_compact(F.array(*nodes))).alias("_node"))
    covers = covers.groupBy(*keys, "_node").agg(F.min(ordinal).alias(ordinal))

    valid = combine_columns([condition_column(df, (n, c)) for n, c, _ in clauses if c in NULL_CONDITIONS] or [F.lit(True)])
    rows = df.filter(valid).withColumn("_v", _as_double(column(df, name), data_type(df, name))).filter("_v IS NOT NULL")
    rows = band.numbered(rows, "_v", "_cell")
    own = list(dict.fromkeys(n for n, _, _ in equal))
    above = F.explode(F.array(*[F.shiftright("_cell", level) + (level << 20) for level in range(levels)])).alias("_above")
    spots = rows.select(*[column(df, n).alias(f"k_{i}") for i, n in enumerate(own)], "_cell").distinct()
    known = {n: F.col(f"k_{i}") for i, n in enumerate(own)}
    met = [F.col("_above") == F.col("_node")]
    met += [compare(known[n], c, _item_value(df, items, n, c, v)) for n, c, v in equal]
    spots = spots.select(*spots.columns, above).join(covers, combine_columns(met))
    spots = spots.groupBy(*[f"k_{i}" for i in range(len(own))], F.col("_cell").alias("_spot")).agg(F.min(ordinal).alias(ordinal))
    here = combine_columns([F.col("_cell") == F.col("_spot"), *[column(df, n) == known[n] for n in own]])
    shown = [*[column(df, c) for c in df.columns], ordinal]
    found = rows.join(spots, here).select(*shown)

    ends = [F.col(at) for at, given in (("_from", band.lows), ("_to", band.highs)) if given]
    partial = params.select(*[f"p_{n}" for n in names], ordinal, F.explode(F.array_distinct(F.array(*ends))).alias("_end"))
    if small_row_count(partial) is not None:
        partial = F.broadcast(partial)
    return found.unionByName(rows.join(partial, (F.col("_cell") == F.col("_end")) & on).select(*shown))


def select_per_item(
    df: DataFrame,
    items: DataFrame,
    where: Iterable[tuple[str, str, str]],
    sort: Iterable,
    unique: str,
    columns: str | Iterable[str] | None = None,
    combine: str = "AND",
    limit: int = DEFAULT_LIMIT,
    return_all: bool = False,
    ordinal: str = "item_ordinal",
    salts: int | None = None,
    first_slice: int | None = None,
) -> DataFrame:
    """The select of every item of ``items`` in one job.

    ``where`` holds ``(column, condition, item column)``: the value of each
    condition comes from the item. Each item has its own limit, ties fall to the
    smaller ``unique`` value. Output rows carry the item's ``ordinal``.

    Items with equal parameters are answered once. To avoid sorting everything an
    item matches, one in ``first_slice`` rows is searched first (by default unless the
    table is small and an equality condition narrows it down): the last row of an
    item's result there bounds its result over the whole table, and only rows up to
    that bound go on. The limit is then applied in two steps, within ``salts`` slices of a parameter
    row (by default one for every ``SLICE_ROWS`` rows of the table) and over all of them. Both cut
    locally before their shuffle, so an item matching a third of the table moves few rows. Slices
    follow from a hash of ``unique``, so a retried task repeats them.
    """
    clauses = [tuple(c) for c in where]
    names, on, has_key = _item_conditions(df, items, clauses, combine)
    if not names:
        raise ValueError("no condition takes its value from an item; use select_rows")
    group = [f"p_{n}" for n in names]
    params = items.select(*[column(items, n).alias(f"p_{n}") for n in names]).distinct()
    size = df.count() if salts is None or not has_key else 0
    slices = salts or max(1, -(-size // SLICE_ROWS))
    band = None if has_key else _Band.of(df, items, clauses, combine, size)

    if return_all:
        matched = _match_items(df, params, on, has_key, unique, slices, band)
    else:
        check_limit(limit)
        rules = sort_names(sort) + [(unique, False)]
        keys = sort_order(df, [(n, "DESC" if d else "ASC") for n, d in rules])
        hashed = F.xxhash64(column(df, unique))
        # without a key every row meets every item, so bounds pay off at any size
        every = first_slice or (bound_slice(df) if has_key else BOUND_SLICE)
        if every:
            few = df.filter(F.pmod(hashed, F.lit(every)) == 0)
            found = _match_items(few, params, on, has_key, unique, slices, band)
            last = _first_rows(found, group, keys, limit).filter(F.col("_rank") == limit)
            bounds = [f"b_{i}" for i in range(len(rules))]
            last = last.select(
                *[F.col(g).alias(f"l_{g}") for g in group], F.lit(True).alias("b_known"),
                *[column(df, n).alias(b) for (n, _), b in zip(rules, bounds)],
            )
            same = combine_columns([F.col(g).eqNullSafe(F.col(f"l_{g}")) for g in group])
            params = params.join(last, same, "left").select(*group, "b_known", *bounds)
            inside = _not_after(
                [(column(df, n), d) for n, d in rules], [F.col(b) for b in bounds]
            )
            on = on & (F.col("b_known").isNull() | inside)
            if band is not None and band.name == rules[0][0]:
                band = band.within(F.col("b_0"), rules[0][1])
        matched = _match_items(df, params, on, has_key, unique, slices, band)
        matched = matched.withColumn("_slice", F.pmod(hashed, F.lit(slices)))
        matched = _first_rows(matched, [*group, "_slice"], keys, limit).drop("_rank")
        matched = _first_rows(matched, group, keys, limit)
    tagged = items.select(
        column(items, ordinal).alias(ordinal), *[column(items, n).alias(f"i_{n}") for n in names]
    )
    mine = combine_columns([F.col(f"i_{n}").eqNullSafe(F.col(f"p_{n}")) for n in names])
    wanted = parse_output_columns(columns)
    if not wanted or "*" in wanted:
        wanted = df.columns
    return tagged.join(matched, mine).select(F.col(ordinal), *[column(df, n) for n in wanted])


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count"))
