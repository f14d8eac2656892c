"""SQL text over registered tables, with ``$1``-style parameters."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import column, quote_ident
from .edits import ORDINAL
from .predicates import metadata_map
from .summaries import Summary, summarize

# Quoted text, identifiers and comments are passed over; only a bare $n is a parameter.
_TOKEN = re.compile(
    r"""'(?:[^']|'')*' | "(?:[^"]|"")*" | `(?:[^`]|``)*` | --[^\n]* | /\*.*?\*/
      | (?P<limit>\b(?:LIMIT|OFFSET)\s+)?\$(?P<number>\d+)""",
    re.VERBOSE | re.DOTALL | re.IGNORECASE,
)

# Quoting as in standard SQL: "x" is an identifier.
_DIALECT = {
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.ansi.enabled": "true",
}


def parse_parameters(raw: Any) -> list[Any]:
    """Parameter field to values: a list, a JSON array, or comma-separated text."""
    if raw is None or raw == "":
        return []
    if isinstance(raw, (list, tuple)):
        return list(raw)
    if not isinstance(raw, str):
        return [raw]
    text = raw.strip()
    if text.startswith("["):
        try:
            parsed = json.loads(text)
            if isinstance(parsed, list):
                return parsed
        except ValueError:
            pass
    return [part.strip() for part in text.split(",") if part.strip()]


def _rewritten(sql: str, name: Callable[[int, str], str]) -> str:
    """``sql`` with every bare ``$n`` replaced by ``name(n, prefix)``, where the prefix is a LIMIT or OFFSET.

    Backslashes in quoted text are doubled, as they have no special meaning there.
    """
    def one(match: re.Match) -> str:
        if match["number"] is None:
            return match[0].replace("\\", "\\\\") if match[0][0] == "'" else match[0]
        return name(int(match["number"]), match["limit"] or "")

    return _TOKEN.sub(one, sql)


def bind(sql: str, values: Sequence[Any]) -> tuple[str, dict[str, Any]]:
    """``$n`` to named parameters; a count after LIMIT or OFFSET becomes an integer."""
    args: dict[str, Any] = {}

    def name(number: int, prefix: str) -> str:
        if not 1 <= number <= len(values):
            raise ValueError(f"there is no parameter ${number}")
        value = values[number - 1]
        if prefix and isinstance(value, str) and value.isdigit():
            args[f"n{number}"] = int(value)
            return f"{prefix}:n{number}"
        args[f"p{number}"] = value
        return f"{prefix}:p{number}"

    return _rewritten(sql, name), args


# The views that were registered here and left behind: they are not the caller's own.
_LEFT: dict[tuple[str, str], DataFrame] = {}


def _own_view(spark: SparkSession, view: str) -> DataFrame | None:
    """The caller's temporary view of this name, if there is one."""
    if not any(t.isTemporary and t.name.lower() == view.lower() for t in spark.catalog.listTables()):
        return None
    found, left = spark.table(quote_ident(view)), _LEFT.get((_session_id(spark), view.lower()))
    return None if left is not None and found.sameSemantics(left) else found


def _session_id(spark: SparkSession) -> str:
    return f"{spark.sparkContext.applicationId} {id(spark)}"


@contextmanager
def _session(spark: SparkSession, views: Mapping[str, DataFrame]) -> Iterator[None]:
    """The dialect's settings for the time of one analysis, and ``views`` registered; the caller's
    settings are put back, and so are the caller's own temporary views of these names."""
    before = {key: spark.conf.get(key, None) for key in _DIALECT}
    kept = {v: own for v in views if (own := _own_view(spark, v)) is not None}
    try:
        for view, df in views.items():
            df.createOrReplaceTempView(view)
        for key, value in _DIALECT.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        for view in views:
            if view in kept:
                kept[view].createOrReplaceTempView(view)
            elif view[:7] != "_items_":
                _LEFT[_session_id(spark), view.lower()] = spark.table(quote_ident(view))


def execute_sql(
    spark: SparkSession,
    sql: str,
    parameters: Any = None,
    views: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run SQL once; ``views`` can be read under their names.

    A command without a result gives one ``(success = true)`` row; a query without
    rows gives an empty result with its columns.
    """
    text, args = bind(sql, parse_parameters(parameters))
    with _session(spark, views or {}):
        result = spark.sql(text, args=args) if args else spark.sql(text)
    if not result.columns:
        return spark.sql("SELECT true AS success")
    return result


def execute_sql_each(
    spark: SparkSession,
    sql: str,
    items: DataFrame,
    parameters: Sequence[str],
    views: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run a query for every item: ``$n`` is the item's value in the ``n``-th column named by ``parameters``.

    Each result row carries the ordinal of its item; an item whose query finds nothing has no row. The query
    becomes a lateral join, so Spark plans one join on what it compares with the parameters, not a
    run per item; aggregates of the rows with equal keys on one side of a value come without any pairs
    (:mod:`.summaries`). A count after LIMIT or OFFSET cannot change from item to item and raises an error.
    """
    def name(number: int, prefix: str) -> str:
        if not 1 <= number <= len(parameters):
            raise ValueError(f"there is no parameter ${number}")
        if prefix:
            raise ValueError(f"{prefix.strip().upper()} cannot take its number from an item")
        return f"_item.p{number}"

    text = sql.strip().rstrip(";")
    given = items.select(
        column(items, ORDINAL).alias(ORDINAL), *[column(items, c).alias(f"p{n}") for n, c in enumerate(parameters, 1)]
    )
    mark, given_views = uuid.uuid4().hex, dict(views or {})
    each, constant = f"_items_{mark}", f"_constant_{mark}"

    def run(inner: str) -> DataFrame:
        return spark.sql(f"SELECT _item.{ORDINAL}, _found.* FROM {each} AS _item, LATERAL ({inner}) AS _found")

    plain = _rewritten(text, name)
    # no column of a view may show by itself
    named = given_views and not re.search(r"\*|\bnatural\b", re.sub(r"\(\s*\*\s*\)", "", plain), re.IGNORECASE)
    try:
        with _session(spark, {**given_views, each: given}):
            found = run(plain)
            summed = _summed(found, Summary.of(text, _TOKEN), given, f"_answers_{mark}")
            if summed is not None:
                return summed
            if not named:
                return found
            # A bare parameter is taken for the column it equals; below an aggregate the other parameters then meet
            # all rows. Next to a constant of the views it stays with the others, and the join is one on its key.
            beside = _rewritten(text, lambda n, prefix: f"if({constant}, {name(n, prefix)}, {name(n, prefix)})")
            try:
                for view, df in given_views.items():
                    df.withColumn(constant, F.lit(True)).createOrReplaceTempView(view)
                better = run(beside).toDF(*found.columns)
                better._jdf.queryExecution().optimizedPlan()  # lateral joins are taken apart here, or refused
                return better
            except (PySparkException, Py4JJavaError):
                return found
            finally:
                for view, df in given_views.items():
                    df.createOrReplaceTempView(view)
    finally:
        spark.catalog.dropTempView(each)


def _summed(found: DataFrame, parts: Summary | None, given: DataFrame, name: str) -> DataFrame | None:
    """What the lateral join ``found`` gives, by :func:`summarize` where that is possible."""
    if parts is None or not found._jdf.queryExecution().analyzed().deterministic():
        return None
    try:
        summed = summarize(parts, given, ORDINAL, name)
    except (PySparkException, Py4JJavaError):
        return None
    if summed is None or [f.dataType for f in summed.schema] != [f.dataType for f in found.schema]:
        return None
    return summed.toDF(*found.columns)


def with_metadata_map(df: DataFrame, metadata: str = "metadata") -> DataFrame:
    """``df`` plus ``metadata_map``, so SQL can say ``metadata_map['lang'] IN (...)``."""
    return df.withColumn("metadata_map", metadata_map(metadata))
