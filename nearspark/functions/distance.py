"""The four vector distances, as column expressions and as Arrow kernels.

All of them grow with dissimilarity, so ascending order ranks best first. Stored
vectors are float32, arithmetic is in double.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("l2", "cosine", "inner_product", "manhattan")
DEFAULT_METRIC = "cosine"


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"Unsupported distance strategy: {metric}")
    return metric


def vector_literal(vector: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in vector])


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _pairs(a: Column, b: Column, fn) -> Column:
    return F.zip_with(a, b, lambda x, y: fn(x.cast("double"), y.cast("double")))


def distance(metric: str, a: Column, b: Column) -> Column:
    """Distance of two vector columns without leaving the JVM.

    A zero vector has no cosine distance: the result is NaN. Vectors of different
    length raise an error, since pairing them would yield a silent NULL.
    """
    check_metric(metric)
    if metric == "l2":
        value = F.sqrt(_sum(_pairs(a, b, lambda x, y: (x - y) * (x - y))))
    elif metric == "manhattan":
        value = _sum(_pairs(a, b, lambda x, y: F.abs(x - y)))
    elif metric == "inner_product":
        value = F.lit(0.0) - _sum(_pairs(a, b, lambda x, y: x * y))
    else:
        squares = lambda v: _sum(_pairs(v, v, lambda x, y: x * y))
        norm = F.sqrt(squares(a)) * F.sqrt(squares(b))
        raw = F.lit(1.0) - _sum(_pairs(a, b, lambda x, y: x * y)) / norm
        value = F.when(norm == 0, F.lit(float("nan"))).otherwise(
            F.least(F.greatest(raw, F.lit(0.0)), F.lit(2.0))
        )
    message = F.concat(
        F.lit("different vector dimensions "), F.size(a).cast("string"),
        F.lit(" and "), F.size(b).cast("string"),
    )
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(
        F.size(a) != F.size(b), F.raise_error(message).cast("double")
    ).otherwise(value)


def matrix(vectors: pa.Array, dims: int | None = None) -> np.ndarray:
    """A list column without NULLs as a rows x dims float64 matrix."""
    rows = len(vectors)
    lengths = pa.compute.list_value_length(vectors)
    found = pa.compute.unique(lengths).to_pylist()
    dims = dims if dims is not None else (found[0] if found else 0)
    for length in found:
        if length != dims:
            raise ValueError(f"different vector dimensions {length} and {dims}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, dims).astype(np.float64)


def paired(metric: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise distance of two matrices (or of a matrix and one vector)."""
    if metric == "l2":
        return np.sqrt(np.square(a - b).sum(axis=-1))
    if metric == "manhattan":
        return np.abs(a - b).sum(axis=-1)
    dot = (a * b).sum(axis=-1)
    if metric == "inner_product":
        return 0.0 - dot
    norm = np.sqrt(np.square(a).sum(axis=-1)) * np.sqrt(np.square(b).sum(axis=-1))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(norm == 0, np.nan, np.clip(1.0 - dot / norm, 0.0, 2.0))


def manhattan(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Queries x rows distances in the precision of the vectors, in blocks that stay in the cache."""
    result = np.zeros((len(queries), len(rows)), rows.dtype)
    # few rows meet more queries at once, as a call takes as long as thousands of numbers
    across, many = np.ascontiguousarray(rows.T), max(8, 131_072 // (max(1, len(rows)) * rows.dtype.itemsize))
    wide = max(1, 131_072 // (many * rows.dtype.itemsize))
    for top in range(0, len(queries), many):
        for left in range(0, len(rows), wide):
            total = np.zeros_like(result[top : top + many, left : left + wide])
            gap = np.empty_like(total)
            for value, line in zip(queries[top : top + many].T, across[:, left : left + wide]):
                np.subtract(value[:, None], line, out=gap)
                np.abs(gap, out=gap)
                total += gap
            result[top : top + many, left : left + wide] = total
    return result


class Steps:
    """Vectors in whole steps of a grid, which bound Manhattan distances from below.

    The grid lies around the vectors it is made for; others may lie beside it. A distance is at least that of the
    steps less what either vector is away from its own.
    """

    #: Greatest step; four of them fit into a byte.
    LAST = 63

    def __init__(self, vectors: np.ndarray):
        some = vectors[:: max(1, len(vectors) // 1000)]
        self.middle = np.median(some, axis=0)
        size = 2.0 * float(np.quantile(np.abs(some - self.middle), 0.999)) / self.LAST if some.size else 0.0
        self.size = size if size > 0 else 1.0

    def cut(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The steps of each vector, and how many it is away from them in all."""
        at = (vectors - self.middle) / self.size + self.LAST / 2
        whole = np.clip(np.rint(at), 0, self.LAST)
        return whole.astype(np.int8), np.abs(at - whole).sum(axis=1)

    def within(self, queries: np.ndarray, across: np.ndarray, away: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Queries x rows: whether steps less what the row is ``away`` are within the query's ``limit``, rounded in its
        favour. ``across`` has the rows' steps by dimension."""
        dims, count = across.shape
        dtype = np.int16 if dims * self.LAST < 16_000 else np.int32
        most = np.iinfo(dtype).max - dims * self.LAST - 1
        least = -np.ceil(np.minimum(away, most)).astype(dtype)
        limit = np.clip(np.floor(limit), np.iinfo(dtype).min, np.iinfo(dtype).max).astype(dtype)[:, None]
        near = np.empty((len(queries), count), bool)
        many = max(1, 131_072 // max(count, 1))
        for top in range(0, len(queries), many):
            asked = queries[top : top + many]
            total = np.repeat(least[None, :], len(asked), axis=0)
            part, gap = np.empty(total.shape, np.int8), np.empty(total.shape, np.int8)
            for start in range(0, dims, 4):
                np.abs(np.subtract(asked[:, start, None], across[start], out=part), out=part)
                for d in range(start + 1, min(start + 4, dims)):
                    np.abs(np.subtract(asked[:, d, None], across[d], out=gap), out=gap)
                    np.add(part.view(np.uint8), gap.view(np.uint8), out=part.view(np.uint8))
                np.add(total, part.view(np.uint8), out=total)
            np.less_equal(total, limit[top : top + many], out=near[top : top + many])
        near[:, away > most] = True
        return near


def all_pairs(metric: str, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Queries x rows distances by matrix product: fast, exact to rounding noise."""
    if metric == "manhattan":
        return manhattan(queries, rows)
    dot = queries @ rows.T
    if metric == "inner_product":
        return -dot
    qq, xx = np.square(queries).sum(axis=1), np.square(rows).sum(axis=1)
    if metric == "l2":
        return np.sqrt(np.maximum(qq[:, None] + xx[None, :] - 2.0 * dot, 0.0))
    norm = np.sqrt(qq)[:, None] * np.sqrt(xx)[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(norm == 0, np.nan, 1.0 - dot / norm)


def arrow_distance(metric: str, query: Sequence[float], vectors: Column) -> Column:
    """Distance to one fixed query vector, computed on Arrow batches."""
    check_metric(metric)
    point = np.asarray(query, dtype=np.float64)

    @F.arrow_udf("double")
    def score(batch: pa.Array) -> pa.Array:
        valid = pa.compute.is_valid(batch).to_numpy(zero_copy_only=False)
        result = np.full(len(batch), np.nan)
        if valid.any():
            rows = matrix(batch.drop_null() if not valid.all() else batch, len(point))
            result[valid] = paired(metric, rows, point)
        return pa.array(result, mask=~valid)

    return score(vectors)


def vector_text(vector: Column) -> Column:
    """``[1.5,2.3,1e-7]``; a whole number is written without its ``.0``."""
    parts = F.transform(vector, lambda x: F.regexp_replace(x.cast("string"), r"\.0(?=E|$)", ""))
    return F.concat(F.lit("["), F.lower(F.array_join(parts, ",")), F.lit("]"))


def parse_vector(text: Column) -> Column:
    return F.from_json(text, "array<float>")


def check_dims(vector: Column, dims: int) -> Column:
    """The vector itself, or an error if its length is not ``dims``."""
    message = F.concat(
        F.lit("vector has "), F.size(vector).cast("string"),
        F.lit(f" dimensions, expected {dims}"),
    )
    return F.when(F.size(vector) != dims, F.raise_error(message).cast("array<float>")).otherwise(
        vector
    )
