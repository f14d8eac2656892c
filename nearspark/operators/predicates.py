"""Row conditions and metadata filters."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.literals import typed_literal, value_text
from ..functions.names import column, data_type

RANGE_CONDITIONS = (">", "<", ">=", "<=")
NULL_CONDITIONS = ("IS NULL", "IS NOT NULL")
#: Most side columns for metadata keys, and the share of rows that must have a key.
MAX_SIDE_COLUMNS = 8
SIDE_SHARE = 0.01


class Condition(NamedTuple):
    """``column condition value``; the value is ignored for the two NULL conditions."""

    column: str
    condition: str
    value: Any = None


# The names of the conditions.
_BUILD = {
    "=": lambda c, v: c == v,
    "equal": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "LIKE": lambda c, v: F.like(c, v),
    "NOT LIKE": lambda c, v: ~F.like(c, v),
    ">": lambda c, v: c > v,
    "<": lambda c, v: c < v,
    ">=": lambda c, v: c >= v,
    "<=": lambda c, v: c <= v,
    "IS NULL": lambda c, v: c.isNull(),
    "IS NOT NULL": lambda c, v: c.isNotNull(),
}


def as_condition(clause: Condition | Mapping[str, Any] | tuple) -> Condition:
    if isinstance(clause, Mapping):
        return Condition(clause["column"], clause["condition"], clause.get("value"))
    return Condition(*clause)


def compare(left: Column, condition: str, right: Any) -> Column:
    """One comparison; only the known conditions are allowed."""
    if condition not in _BUILD:
        raise ValueError(f"Unsupported condition: {condition}")
    return _BUILD[condition](left, right)


def condition_column(df: DataFrame, clause: Condition | Mapping[str, Any] | tuple) -> Column:
    """A clause as a boolean column over ``df``, NULL where the compared column is NULL."""
    name, condition, value = as_condition(clause)
    left = column(df, name)
    if condition in NULL_CONDITIONS:
        return compare(left, condition, None)
    if "LIKE" in condition:
        return compare(left, condition, F.lit(value_text(value)))
    literal = typed_literal(value, data_type(df, name), condition in RANGE_CONDITIONS)
    return compare(left, condition, literal)


def combine_columns(parts: list[Column], combine: str = "AND") -> Column:
    """One combiner for the whole list; anything but ``OR`` is AND."""
    return reduce((lambda a, b: a | b) if combine == "OR" else (lambda a, b: a & b), parts)


def where_column(df: DataFrame, clauses: Iterable, combine: str = "AND") -> Column | None:
    """All clauses as one column, or None when there are none."""
    parts = [condition_column(df, c) for c in clauses or ()]
    return combine_columns(parts, combine) if parts else None


def filter_rows(df: DataFrame, clauses: Iterable, combine: str = "AND") -> DataFrame:
    """Keep the rows for which the clauses are TRUE."""
    where = where_column(df, clauses, combine)
    return df if where is None else df.filter(where)


def metadata_map(metadata: str = "metadata") -> Column:
    """JSON metadata as a text map; NULL unless it is a JSON object."""
    return F.from_json(F.col(metadata), "map<string,string>")


def metadata_value(entries: Column, key: str) -> Column:
    """Text of a key in a metadata map; of a repeated key the last one counts."""
    same = F.filter(F.map_entries(entries), lambda e: e["key"] == key)
    return F.try_element_at(same, F.lit(-1))["value"]


def side_column(key: str, metadata: str = "metadata") -> str:
    """Name of the column that holds the texts of one metadata key."""
    return f"{metadata}${key}"


def common_keys(df: DataFrame, limit: int = MAX_SIDE_COLUMNS, metadata: str = "metadata") -> list[str]:
    """The commonest metadata keys, of those that at least ``SIDE_SHARE`` of the rows have."""
    # a row names each key once; names that are rare in every task do not grow the result
    keys = df.select(F.explode(F.array_distinct(F.map_keys(metadata_map(metadata)))).alias("key"))
    rows = df.count()
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= SIDE_SHARE * rows)
    return [r["key"] for r in counts.orderBy(F.desc("n"), "key").limit(limit).collect()]


def shred_metadata(
    df: DataFrame, keys: Iterable[str] | None = None, metadata: str = "metadata"
) -> DataFrame:
    """``df`` with a text column for each of the ``keys``, by default the commonest ones.

    Filters on these keys then compare plain columns, which reaches the files' statistics and
    Bloom filters; other keys are still looked up in the JSON.
    """
    keys = list(common_keys(df, metadata=metadata) if keys is None else keys)
    entries = metadata_map(metadata)
    return df.select("*", *[metadata_value(entries, k).alias(side_column(k, metadata)) for k in keys])


def bloom_options(df: DataFrame, metadata: str = "metadata") -> dict[str, str]:
    """Options for a Parquet writer, which keeps a Bloom filter of each side column."""
    return {
        f"parquet.bloom.filter.enabled#{c}": "true" for c in df.columns if c.startswith(side_column("", metadata))
    }


def metadata_column(
    filters: Mapping[str, Any], metadata: str = "metadata", columns: Iterable[str] = ()
) -> Column:
    """Every key of ``filters`` equals the text of its value in a JSON object.

    A key with a side column among ``columns`` is compared there: it has a text only in an object.
    """
    entries, known, parts = metadata_map(metadata), set(columns), []
    for key, value in filters.items():
        side = side_column(key, metadata)
        if side in known:
            parts.append(F.col(f"`{side}`") == value_text(value))
        else:
            parts.append(entries.isNotNull() & (metadata_value(entries, key) == value_text(value)))
    return combine_columns(parts)


def metadata_filter(
    df: DataFrame, filters: Mapping[str, Any] | None, metadata: str = "metadata"
) -> DataFrame:
    """Keep rows whose metadata matches; an empty filter keeps every row."""
    return df.filter(metadata_column(filters, metadata, df.columns)) if filters else df


def parse_metadata_filter(text: str | None) -> dict[str, Any] | None:
    """Filter text to a mapping; empty text is no filter."""
    if not text:
        return None
    message = 'Invalid metadata filter format. Expected a JSON object, e.g. {"key": "value"}'  # fixed value
    try:
        parsed = json.loads(text)
    except ValueError:
        raise ValueError(message) from None
    if not isinstance(parsed, dict):
        raise ValueError(message)
    return parsed
