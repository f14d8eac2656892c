"""A vector table with an embedding model: ingest, search, retrieval."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.distance import DEFAULT_METRIC, check_metric
from .operators import ann, ingest, search
from .operators.predicates import parse_metadata_filter
from .sources import catalog
from .sources.staging import unstage


class VectorStore:
    """One vector table (``schema.table``, schema ``public`` by default).

    Search modes expect the table to exist; the first insert creates it, with the
    given length or that of the first vector.
    """

    def __init__(
        self,
        spark: SparkSession,
        embedder,
        table: str,
        metric: str = DEFAULT_METRIC,
        dims: int | None = None,
        schema: str = catalog.DEFAULT_SCHEMA,
    ):
        self.spark, self.embedder, self.dims = spark, embedder, dims
        self.name = table if "." in table else f"{schema}.{table}"
        self.metric = check_metric(metric)
        self._opened: tuple[str, ann.IvfIndex | ann.LshIndex] | None = None

    # -------------------------------------------------------------- ingest

    def add_vectors(self, docs: DataFrame, order: Sequence[str] = ()) -> int:
        """Append ``(content, embedding, metadata)`` rows; returns how many there were.

        Ids are assigned on a staged copy, which is then appended in one job. A bad
        vector fails that job, and the table stays as it was.
        """
        dims = catalog.ensure_vector_table(self.spark, self.name, self.dims, docs)
        return self._append(docs, order, dims, lambda numbered: numbered)

    def add_documents(self, docs: DataFrame, order: Sequence[str] = ()) -> int:
        """Embed ``(content, metadata)`` rows and append them; the model runs in the append."""
        dims = self.dims
        if not dims and not catalog.table_exists(self.spark, self.name):
            first = docs.select("content").first()
            dims = len(self.embedder.embed_query(first.content)) if first else None
        dims = catalog.ensure_vector_table(self.spark, self.name, dims)
        return self._append(
            docs, order, dims, lambda numbered: ingest.embed_documents(numbered, self.embedder)
        )

    def _append(self, docs: DataFrame, order: Sequence[str], dims: int, complete) -> int:
        last = int(catalog.get_property(self.spark, self.name, catalog.LAST_ID) or 0)
        numbered = ingest.assign_ids(docs, last + 1, order)
        count = numbered.count()
        if count:
            # the range is taken before the rows are there: a crash leaves a gap, never a repeat
            catalog.set_property(self.spark, self.name, catalog.LAST_ID, str(last + count))
            rows = ingest.prepare_vectors(complete(numbered), dims)
            try:
                catalog.append(self.spark, self.name, rows.withColumn("created_at", F.current_timestamp()))
            except Exception:
                # the job committed nothing, so its ids are free again
                catalog.set_property(self.spark, self.name, catalog.LAST_ID, str(last))
                raise
        unstage(numbered)
        return count

    def insert(self, items: DataFrame, order: Sequence[str] = ()) -> DataFrame:
        """Insert mode: any items in, one summary row out."""
        count = self.add_documents(ingest.documents_from_items(items), order)
        return self.spark.createDataFrame(
            [(True, count, self.name)], "success boolean, insertedCount long, tableName string"
        )

    # -------------------------------------------------------------- search

    def rows(self) -> DataFrame:
        return catalog.read_table(self.spark, self.name)

    def create_index(self, index_type: str, **options) -> None:
        """Build an approximate index over the present rows for this store's metric.

        It belongs to the table: any store of it uses the index, and rows that were inserted
        since are searched besides. Changing rows otherwise (edits, truncation) removes it.
        """
        if index_type != "ivfflat":
            options.setdefault("dims", int(catalog.get_property(
                self.spark, self.name, catalog.DIMS
            )))
        last = catalog.get_property(self.spark, self.name, catalog.LAST_ID) or "0"
        options.setdefault("path", f"{catalog.home(self.spark, self.name)}/{catalog.INDEXES}/{uuid.uuid4().hex}")
        rows = self.rows().filter(F.col("id") <= int(last))
        index = ann.create_index(rows, index_type, self.metric, **options)
        catalog.set_property(self.spark, self.name, catalog.INDEXED_ID, last)
        catalog.set_property(self.spark, self.name, catalog.INDEX, index.path)

    def index(self) -> ann.IvfIndex | ann.LshIndex | None:
        """The table's index, if it has one for this store's metric."""
        path = catalog.get_property(self.spark, self.name, catalog.INDEX)
        if path is None:
            return None
        if self._opened is None or self._opened[0] != path:
            self._opened = path, ann.load_index(self.spark, path)
        return self._opened[1] if self._opened[1].metric == self.metric else None

    def similarity_search_vector(
        self, query: Sequence[float], k: int = search.DEFAULT_K,
        filters: Mapping[str, Any] | str | None = None, probes: int | None = None,
        share: float | None = None,
    ) -> DataFrame:
        """``(id, content, metadata, distance)`` of the nearest rows.

        Uses the table's index if there is one. How far it looks is its own choice, unless
        ``probes`` cells or a ``share`` of the rows is asked for.
        """
        if filters is None or isinstance(filters, str):
            filters = parse_metadata_filter(filters)
        index, rows = self.index(), self.rows()
        if index is None:
            return search.similarity_search(rows, query, k, self.metric, filters)
        if isinstance(index, ann.IvfIndex):
            found = index.search(query, k, probes, filters, self.metric)
        else:
            found = index.search(query, k, filters, self.metric, share=share)
        newer = rows.filter(F.col("id") > int(catalog.get_property(self.spark, self.name, catalog.INDEXED_ID)))
        both = found.unionByName(search.similarity_search(newer, query, k, self.metric, filters))
        return both.orderBy(*search.nearest_first()).limit(k)

    def similarity_search(self, prompt: str, k: int = search.DEFAULT_K, filters=None) -> DataFrame:
        return self.similarity_search_vector(self.embedder.embed_query(prompt), k, filters)

    def get_many(self, prompt: str, k: int = search.DEFAULT_K, filters=None) -> DataFrame:
        """Load mode: ``(pageContent, metadata, score)``."""
        found = self.similarity_search(prompt, k, filters)
        return found.select(
            F.col("content").alias("pageContent"),
            search.metadata_or_empty(F.col("metadata")).alias("metadata"),
            F.col("distance").alias("score"),
        )

    def retrieve(
        self, prompt: str, k: int = search.DEFAULT_K, filters=None,
        rerank: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """Retrieve mode: ranked documents."""
        return search.retrieve_documents(self.similarity_search(prompt, k, filters), rerank)

    def as_tool(self, k: int = search.DEFAULT_K, filters=None) -> Callable[[str], str]:
        """Tool mode: a function from a question to the joined contents."""
        return lambda prompt: search.retrieve_context(
            self.retrieve(prompt, k, filters)
        ).first()["context"]

    def drop(self) -> None:
        catalog.drop_table(self.spark, self.name)
