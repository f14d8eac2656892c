"""Exact similarity search for one query vector, and the retrieval forms around it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distance import DEFAULT_METRIC, arrow_distance, distance, vector_literal
from .predicates import metadata_filter

DEFAULT_K = 10


def with_distance(
    df: DataFrame,
    query: Sequence[float],
    metric: str = DEFAULT_METRIC,
    embedding: str = "embedding",
    engine: str = "arrow",
    decimals: int | None = None,
) -> DataFrame:
    """``df`` plus a ``distance`` column.

    The Arrow engine ships only the embedding column to Python and computes whole
    batches; ``jvm`` is the plain column expression, handy where no Python worker
    should start.
    """
    vector = F.col(embedding)
    if engine == "jvm":
        value = distance(metric, vector.cast("array<double>"), vector_literal(query))
    else:
        value = arrow_distance(metric, query, vector)
    if decimals is not None:
        value = F.round(value, decimals)
    return df.withColumn("distance", value)


def nearest_first(id_col: str = "id") -> list[Column]:
    return [F.col("distance").asc_nulls_last(), F.col(id_col).asc()]


def similarity_search(
    df: DataFrame,
    query: Sequence[float],
    k: int = DEFAULT_K,
    metric: str = DEFAULT_METRIC,
    filters: Mapping[str, Any] | None = None,
    columns: Sequence[str] = ("id", "content", "metadata"),
    id_col: str = "id",
    embedding: str = "embedding",
    engine: str = "arrow",
    decimals: int | None = None,
) -> DataFrame:
    """The ``k`` nearest rows as ``columns`` plus ``distance``, nearest first.

    The filter comes before the ranking. Sort plus limit runs as one
    take-ordered step: every task keeps ``k`` rows, and nothing else is shuffled.
    """
    scored = with_distance(
        metadata_filter(df, filters), query, metric, embedding, engine, decimals
    )
    rows = scored.select(*columns, "distance") if id_col in columns else scored
    return rows.orderBy(*nearest_first(id_col)).limit(k).select(*columns, "distance")


def fetch(
    results: DataFrame, rows: DataFrame, columns: Sequence[str] = ("content",), id_col: str = "id"
) -> DataFrame:
    """The at most ``k`` rows of a search result with further ``columns`` of ``rows``, nearest first.

    A search that ranks narrow rows and fetches the texts of its hits never moves any other text.
    """
    wide = rows.select(id_col, *columns).join(F.broadcast(results), id_col)
    return wide.orderBy(*nearest_first(id_col))


def with_rank(results: DataFrame, id_col: str = "id") -> DataFrame:
    """Number the at most ``k`` rows of a search result from 1."""
    return results.withColumn("rank", F.row_number().over(Window.orderBy(*nearest_first(id_col))))


def metadata_or_empty(metadata: Column) -> Column:
    """The metadata as results show it: an absent one and the JSON null are both ``{}``."""
    return F.when(F.trim(metadata) == "null", "{}").otherwise(F.coalesce(metadata, F.lit("{}")))


def get_many(
    df: DataFrame,
    prompt: str,
    embedder,
    k: int = DEFAULT_K,
    filters: Mapping[str, Any] | None = None,
    metric: str = DEFAULT_METRIC,
    **options,
) -> DataFrame:
    """Search by text: ``(pageContent, metadata, score)``; the score is the distance."""
    results = similarity_search(df, embedder.embed_query(prompt), k, metric, filters, **options)
    return results.select(
        F.col("content").alias("pageContent"),
        metadata_or_empty(F.col("metadata")).alias("metadata"),
        F.col("distance").alias("score"),
    )


def retrieve_documents(
    results: DataFrame, rerank: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Ranked documents without a score, optionally passed through ``rerank``.

    ``rerank`` gets ``(id, content, metadata, distance, rank)`` and returns the same
    columns with new ranks; by default the ranks stay.
    """
    ranked = with_rank(results)
    if rerank is not None:
        ranked = rerank(ranked)
    return ranked.select("rank", "content", metadata_or_empty(F.col("metadata")).alias("metadata"))


def retrieve_context(documents: DataFrame) -> DataFrame:
    """One row: the contents of the ranked documents, joined by a blank line."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "content")))
    return documents.agg(
        F.array_join(F.transform(ordered, lambda d: d["content"]), "\n\n").alias("context")
    )
