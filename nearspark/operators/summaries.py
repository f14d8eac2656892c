"""Aggregates for each item without its pairs with the rows.

``SELECT count(*), sum(x), ... FROM t WHERE k = $1 AND v > $2`` for every item would pair an item with all rows it
counts. Here rows are summed up by key and value first and then run through in the order of ``v``, once for all items of
a key; where a key has many of them, in cells of ``v`` whose totals are added up by themselves.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .select import MAX_BUCKETS, _as_double, _Band

#: Values of a key from which on they are cut into cells of about so many.
CELL_VALUES = 200_000

# A quoted text or identifier, a parameter, and what stands for text in brackets.
QUOTED, PARAMETER, END, INSIDE = "\ue000", "\ue001", "\ue002", "\ue003"

_NAME = rf"[\w.{QUOTED}{END}]+"
_STATEMENT = re.compile(
    rf"\s*SELECT\b(?P<shown>.+?)\bFROM\s+(?P<relation>{_NAME}(?:\s+(?:AS\s+)?[\w{QUOTED}{END}]+)?)\s*"
    r"(?:\bWHERE\b(?P<where>.+))?", re.IGNORECASE | re.DOTALL)
_AGGREGATE = re.compile(rf"(?<![\w.{END}])(count|sum|min|max)\s*\(\s*(\*|{_NAME})\s*\)", re.IGNORECASE)
_OTHER = re.compile(
    r"\b(distinct|all|any|some|over|filter|within|group|having|order|sort|cluster|distribute|limit|offset|union|"
    r"intersect|except|minus|join|lateral|window|exists|with|qualify|tablesample|pivot|unpivot)\b", re.IGNORECASE)
_LOOSE = re.compile(r"\b(or|xor|between|case)\b", re.IGNORECASE)
_WORDS = re.compile(r"\b(not|is|i?like|rlike|regexp|in|similar|escape)\b", re.IGNORECASE)
_FLIPPED = {"=": "=", "==": "=", "<": ">", "<=": ">=", ">": "<", ">=": "<="}
_MERGED = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


class Summary(NamedTuple):
    """The parts of such a statement: what it shows (``{n}`` for the ``n``-th aggregate), the relation, conditions without
    parameters, ``(expression, n)`` of the equalities, ``(expression, operator, n)`` of the range, and the aggregates."""

    shown: str
    relation: str
    fixed: list[str]
    equal: list[tuple[str, int]]
    bound: tuple[str, str, int] | None
    aggregates: list[tuple[str, str]]

    @classmethod
    def of(cls, sql: str, token: re.Pattern) -> Summary | None:
        """The parts of ``sql``; None for any other statement."""
        quoted: list[str] = []

        def one(match: re.Match) -> str:
            if match["number"] is not None:
                return f" {match['limit'] or ''}{PARAMETER}{match['number']}{END} "
            if match[0][:2] in ("--", "/*"):
                return " "
            quoted.append(match[0].replace("\\", "\\\\") if match[0][0] == "'" else match[0])
            return f"{QUOTED}{len(quoted) - 1}{END}"

        def plain(text: str) -> str:
            return re.sub(rf"{QUOTED}(\d+){END}", lambda m: quoted[int(m[1])], text).strip()

        if any(c in sql for c in (QUOTED, PARAMETER, END, INSIDE)):
            return None
        text = token.sub(one, sql)
        flat = _flat(text)
        match = None if flat is None or _OTHER.search(text) else _STATEMENT.fullmatch(flat)
        if match is None or any(len(re.findall(rf"\b{w}\b", text, re.IGNORECASE)) != 1 for w in ("select", "from")):
            return None
        part = lambda name: text[match.start(name) : match.end(name)] if match[name] else ""
        aggregates: list[tuple[str, str]] = []

        def numbered(found: re.Match) -> str:
            aggregates.append((found[1].lower(), plain(found[2])))
            return f"{{{len(aggregates) - 1}}}"

        shown = _AGGREGATE.sub(numbered, part("shown").replace("{", "{{").replace("}", "}}"))
        fixed, equal, bounds = [], [], []
        for condition in _conjuncts(part("where")) or ():
            if PARAMETER not in condition:
                fixed.append(plain(condition))
                continue
            found = _compared(condition)
            if found is None:
                return None
            left, operator, number = found
            if operator == "=":
                equal.append((plain(left), number))
            else:
                bounds.append((plain(left), operator, number))
        if not aggregates or PARAMETER in shown or len(bounds) > 1 or not (equal or bounds) or _LOOSE.search(
            _flat(part("where"))
        ):
            return None
        shown = re.sub(
            rf"{QUOTED}(\d+){END}", lambda m: quoted[int(m[1])].replace("{", "{{").replace("}", "}}"), shown
        )
        return cls(shown, plain(part("relation")), fixed, equal, bounds[0] if bounds else None, aggregates)


def _flat(text: str) -> str | None:
    """``text`` with everything in brackets blotted out; None if they do not match."""
    depth, shown = 0, []
    for c in text:
        depth -= c in ")]"
        if depth < 0:
            return None
        shown.append(INSIDE if depth or c in "()[]" else c)
        depth += c in "(["
    return None if depth else "".join(shown)


def _conjuncts(where: str) -> list[str]:
    ends = [m.span() for m in re.finditer(r"\bAND\b", _flat(where), re.IGNORECASE)]
    starts = [0, *[end for _, end in ends]]
    return [where[a:b] for a, b in zip(starts, [*[start for start, _ in ends], len(where)])] if where.strip() else []


def _compared(condition: str) -> tuple[str, str, int] | None:
    """``(expression, operator, n)`` of an expression compared with ``$n``."""
    flat = _flat(condition)
    runs = list(re.finditer(r"[=<>!]+", flat))
    if len(runs) != 1 or runs[0][0] not in _FLIPPED or _WORDS.search(flat):
        return None
    sides = condition[: runs[0].start()].strip(), condition[runs[0].end() :].strip()
    for expression, other, operator in ((*sides, runs[0][0]), (*sides[::-1], _FLIPPED[runs[0][0]])):
        number = re.fullmatch(rf"{PARAMETER}(\d+){END}", other)
        if number and PARAMETER not in expression:
            return expression, "=" if operator == "==" else operator, int(number[1])
    return None


def _common(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type in which SQL compares the two, where that is plain."""
    if a == b and (a == T.StringType() or isinstance(a, (
        T.IntegralType, T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.BooleanType,
    ))):
        return a
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    numbers = (T.IntegralType, T.FloatType, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers) and T.DoubleType() in (a, b):
        return T.DoubleType()
    return None


def _summed(function: str, value: T.DataType) -> bool:
    """Whether the aggregate of parts is that of the whole, without an overflow on the way."""
    return function != "sum" or isinstance(
        value, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)
    )


def summarize(parts: Summary, given: DataFrame, ordinal: str, name: str) -> DataFrame | None:
    """The statement's rows for every item of ``given`` (``ordinal, p1, p2, ...``); None where types do not allow it.

    ``name`` is that of a view, which only stands for the time of the call.
    """
    spark = given.sparkSession
    compared = [*parts.equal, *([parts.bound[::2]] if parts.bound else [])]
    keys = [f"_k{i}" for i in range(len(parts.equal))]
    names = [*keys, *(["_v"] if parts.bound else [])]
    args = [a if a != "*" else "1" for _, a in parts.aggregates]
    columns = [*[f"{e} AS {n}" for (e, _), n in zip(compared, names)], *[f"{a} AS _x{i}" for i, a in enumerate(args)]]
    where = f" WHERE {' AND '.join(f'({c})' for c in parts.fixed)}" if parts.fixed else ""
    rows = spark.sql(f"SELECT {', '.join(columns)} FROM {parts.relation}{where}")

    types = {f.name: f.dataType for f in [*rows.schema, *given.schema]}
    shared = [_common(types[n], types[f"p{p}"]) for (_, p), n in zip(compared, names)]
    if None in shared or not all(_summed(f, types[f"_x{i}"]) for i, (f, _) in enumerate(parts.aggregates)):
        return None
    known = " AND ".join(f"{n} IS NOT NULL" for n in names)
    rows = rows.select(
        *[F.col(n).cast(t).alias(n) for n, t in zip(names, shared)], *[f"_x{i}" for i in range(len(args))]
    ).filter(known)
    asked = given.select(ordinal, *[F.col(f"p{p}").cast(t).alias(n) for (_, p), n, t in zip(compared, names, shared)])

    functions = [f for f, _ in parts.aggregates]
    found = rows.groupBy(*names).agg(*[getattr(F, f)(f"_x{i}").alias(f"_a{i}") for i, f in enumerate(functions)])
    if parts.bound:
        found = _run_through(found, asked.select(*names).filter(known).distinct(), keys, functions, parts.bound[1])
    values = [f"_a{i}" for i in range(len(functions))]
    found = asked.join(found, names, "left").select(ordinal, *[
        (F.coalesce(v, F.lit(0).cast("long")) if f == "count" else F.col(v)).alias(f"{name}{v}")
        for f, v in zip(functions, values)
    ])
    found.createOrReplaceTempView(name)
    try:
        return spark.sql(f"SELECT {ordinal}, {parts.shown.format(*[name + v for v in values])} FROM {name}")
    finally:
        spark.catalog.dropTempView(name)


def _run_through(found: DataFrame, asked: DataFrame, keys: list[str], functions: list[str], operator: str) -> DataFrame:
    """For each of ``asked`` (``keys`` and ``_v``) the aggregates of the rows of its key on its side of ``_v``."""
    values = [f"_a{i}" for i in range(len(functions))]
    order = (lambda c: F.col(c).desc()) if operator[0] == ">" else (lambda c: F.col(c).asc())
    none = [F.lit(None).cast(found.schema[v].dataType).alias(v) for v in values]
    both = found.withColumn("_row", F.lit(True)).unionByName(asked.select("*", *none, F.lit(False).alias("_row")))
    merged = [_MERGED[f](v) for f, v in zip(functions, values)]

    number = _as_double(F.col("_v"), both.schema["_v"].dataType)
    most = both.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0 if number is not None else 0
    cut = most > CELL_VALUES
    if cut:
        both = both.withColumn("_cell", number + F.lit(0.0))
        every = both.count() if keys else most
        count = min(MAX_BUCKETS, -(-every // CELL_VALUES) + 1)
        inner = both.approxQuantile("_cell", [i / count for i in range(1, count)], 1 / (4 * count))
        inside = sorted({float(v) for v in inner if abs(v) != float("inf")}) or [0.0]
        band = _Band("_v", both.schema["_v"].dataType, [-float("inf"), *inside, float("inf")], [], [])
        both = band.numbered(both.withColumnRenamed("_cell", "_number"), "_number", "_cell")
    group = [*keys, *(["_cell"] if cut else [])]
    # of equal values those come first that do not see the others
    tie = F.col("_row").desc() if operator[1:] else F.col("_row").asc()
    seen = Window.partitionBy(*group).orderBy(order("_v"), tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answers = both.select(*group, "_v", "_row", *[m.over(seen).alias(v) for m, v in zip(merged, values)])
    answers = answers.filter("NOT _row").drop("_row")
    if not cut:
        return answers
    before = Window.partitionBy(*keys).orderBy(order("_cell")).rowsBetween(Window.unboundedPreceding, -1)
    totals = both.groupBy(*group).agg(*[m.alias(v) for m, v in zip(merged, values)])
    totals = totals.select(*group, *[m.over(before).alias(f"_b{v}") for m, v in zip(merged, values)])
    return answers.join(totals, group).select(*keys, "_v", *[_both(f, v).alias(v) for f, v in zip(functions, values)])


def _both(function: str, value: str) -> Column:
    """An aggregate of a cell's part and of the cells before it."""
    here, before = F.col(value), F.col(f"_b{value}")
    if function in ("min", "max"):
        return (F.least if function == "min" else F.greatest)(here, before)
    return F.coalesce(here + before, here, before)
