"""Size checks that come before a broadcast or a driver-side parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 50_000
MAX_BROADCAST_BYTES = 64 << 20
BOUND_SLICE = 1000
MANY_BYTES = 32 << 30


def _field_bytes(field: T.StructField) -> Column:
    value = F.col("`" + field.name.replace("`", "``") + "`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(field.dataType, T.ArrayType) and isinstance(
        field.dataType.elementType, T.NumericType
    ):
        return F.coalesce(F.size(value), F.lit(0)) * 8
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
    return F.lit(16)


def small_row_count(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> int | None:
    """Rows of ``df`` if both its rows and its bytes are within the bounds, else None.

    Fetches one number per row for at most ``max_rows + 1`` rows, partition by
    partition until there are enough, so a large table is not read through.
    """
    size = sum((_field_bytes(f) for f in df.schema), F.lit(0))
    sizes = df.select(size.cast("long").alias("bytes")).take(max_rows + 1)
    if len(sizes) > max_rows or sum(r.bytes for r in sizes) > max_bytes:
        return None
    return len(sizes)


def has_rows(df: DataFrame, count: int) -> bool:
    """Whether ``df`` has at least ``count`` rows; stops reading once it does."""
    return len(df.select(F.lit(1)).take(count)) >= count


def bound_slice(df: DataFrame) -> int | None:
    """How thin a slice to search first for bounds; None where the extra job costs more.

    A first look pays off when many tasks would otherwise each hand on their own best
    rows, so it goes by the size that the optimizer takes ``df`` to have, without listing files.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return BOUND_SLICE if size > MANY_BYTES else None
