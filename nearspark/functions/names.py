"""Identifiers and output column lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote_ident(name: str) -> str:
    """Back-tick a single identifier, so that dots and blanks in it are literal."""
    if name is None or str(name) == "":
        raise ValueError("Identifier cannot be empty")
    return "`" + str(name).replace("`", "``") + "`"


def quote_table(name: str, schema: str | None = None) -> str:
    """``schema.table`` with both parts quoted; a dot in ``name`` separates the parts."""
    if schema is not None:
        return f"{quote_ident(schema)}.{quote_ident(name)}"
    return ".".join(quote_ident(part.strip()) for part in name.split("."))


def column(df: DataFrame, name: str) -> Column:
    """The column of exactly this (case-sensitive) name."""
    quoted = quote_ident(name)
    if name not in df.columns:
        raise ValueError(f'column "{name}" does not exist')
    return F.col(quoted)


def data_type(df: DataFrame, name: str):
    """Type of the column of exactly this name."""
    column(df, name)
    return df.schema[name].dataType


def parse_output_columns(value: str | Iterable[str] | None) -> list[str]:
    """Comma text or list to names, trimmed, without empty entries."""
    if value is None or value == "":
        return []
    parts = value.split(",") if isinstance(value, str) else [str(v) for v in value]
    return [p.strip() for p in parts if p.strip()]


def output_columns(df: DataFrame, value: str | Iterable[str] | None) -> list[Column]:
    """Projection for an output column list; none at all or a ``*`` means every column."""
    names = parse_output_columns(value)
    if not names or "*" in names:
        names = df.columns
    return [column(df, n) for n in names]
