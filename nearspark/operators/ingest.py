"""Documents to vector rows: content, chunks, embeddings, ids, batch insert."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.distance import check_dims
from ..functions.literals import JS_LINE_END, JS_SPACE
from ..functions.names import column
from ..sources.staging import stage, unstage

# Item fields that may hold the text, in order of preference.
CONTENT_FIELDS = ("content", "text", "pageContent")
CHUNK_SOURCE = "markdown_by_header"

_HEADING = f"(?=#)(?<=[{JS_LINE_END}])"


def vector_schema(dims: int) -> T.StructType:
    """Columns of a vector table; the length is kept as metadata of the vector field."""
    return T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("content", T.StringType(), False),
        T.StructField("embedding", T.ArrayType(T.FloatType(), False), False, {"dims": dims}),
        T.StructField("metadata", T.StringType(), True),
        T.StructField("created_at", T.TimestampType(), True),
    ])


def extract_page_content(items: DataFrame) -> Column:
    """First non-empty text field of an item, else the whole item as JSON."""
    fields = [
        F.nullif(F.col(name).cast("string"), F.lit(""))
        for name in CONTENT_FIELDS if name in items.columns
    ]
    whole = F.to_json(
        F.struct(*[column(items, c) for c in items.columns]), {"ignoreNullFields": "false"}
    )
    return F.coalesce(*fields, whole)


def extract_metadata(items: DataFrame) -> Column:
    """The item's metadata as JSON text, ``{}`` when there is none."""
    if "metadata" not in items.columns:
        return F.lit("{}")
    value = F.col("metadata")
    if not isinstance(items.schema["metadata"].dataType, T.StringType):
        value = F.to_json(value)
    return F.coalesce(value, F.lit("{}"))


def null_metadata(metadata: Column) -> Column:
    """Missing metadata of directly inserted vectors is stored as JSON null."""
    return F.coalesce(metadata, F.lit("null"))


def trim_space(text: Column) -> Column:
    """Strip all white space including line ends, not just blanks."""
    return F.btrim(text, F.lit(JS_SPACE))


def chunk_markdown(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per heading section: the columns of ``docs`` but ``text``, plus
    ``chunk`` (position from 0), ``content`` (title, line break, body) and ``metadata``.

    A section starts at every line beginning with ``#``. Blank sections drop out.
    """
    others = [column(docs, c) for c in docs.columns if c != text]
    pieces = F.filter(F.split(column(docs, text), _HEADING), lambda p: trim_space(p) != "")
    sections = docs.select(*others, F.posexplode(pieces).alias("chunk", "_piece"))
    sections = sections.withColumn("_piece", trim_space(F.col("_piece")))
    first = F.substring_index("_piece", "\n", 1)
    rest = F.expr("substring(_piece, length(substring_index(_piece, '\n', 1)) + 2)")
    title = F.regexp_replace(first, f"^#+[{JS_SPACE}]*", "")
    metadata = F.struct(title.alias("title"), F.lit(CHUNK_SOURCE).alias("source"))
    return sections.select(
        *[F.col(f"`{c}`") for c in docs.columns if c != text],
        "chunk",
        F.concat(title, F.lit("\n"), trim_space(rest)).alias("content"),
        F.to_json(metadata).alias("metadata"),
    )


def embed_text(text: Column, embedder) -> Column:
    """Vectors of a text column, whole Arrow batches per call of the model."""

    @F.arrow_udf("array<float>")
    def embed(batch: pa.Array) -> pa.Array:
        vectors = np.asarray(embedder.embed_documents(batch.to_pylist()), dtype=np.float32)
        dims = vectors.shape[1] if vectors.ndim == 2 else 0
        offsets = np.arange(0, vectors.size + 1, max(1, dims), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))

    return embed(F.coalesce(text, F.lit("")))


def assign_ids(
    rows: DataFrame, start: int = 1, order: Sequence[str] = (), id_col: str = "id"
) -> DataFrame:
    """Dense ids from ``start``, in the order of the ``order`` columns.

    The rows are written once, range-sorted, and numbered by file and position in
    the file, so neither a global window nor a re-run of a task is involved. Without
    ``order`` nothing is shuffled and the numbering follows the written files.
    """
    rows = rows.drop(id_col)
    staged = stage(rows.orderBy(*order) if order else rows, "ids")
    numbered = staged.withColumn("_file", F.col("_metadata.file_name")).withColumn(
        "_row", F.col("_metadata.row_index")
    )
    sizes = numbered.groupBy("_file").agg(F.count(F.lit(1)).alias("_size"))
    # a task may write several files: the task's number comes first, then its file counter
    task = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long")
    counter = F.regexp_extract("_file", r"-c(\d+)", 1).cast("long")
    # one row per written file, so both the window and the broadcast are bounded by that
    before = Window.orderBy(task, counter, "_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_file", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    identity = (F.col("_offset") + F.col("_row") + F.lit(start)).cast("long")
    result = numbered.join(F.broadcast(offsets), "_file").select(identity.alias(id_col), *rows.columns)
    result._staged = staged._staged  # for ``unstage``, once the ids have been used
    return result


def prepare_vectors(docs: DataFrame, dims: int) -> DataFrame:
    """Content, checked embedding and metadata of a batch, in vector-table form."""
    embedding = F.col("embedding").cast("array<float>")
    missing = F.raise_error(F.lit("null value violates not-null constraint"))
    metadata = F.col("metadata") if "metadata" in docs.columns else F.lit(None).cast("string")
    return docs.select(
        *[c for c in docs.columns if c not in ("content", "embedding", "metadata")],
        F.coalesce("content", missing.cast("string")).alias("content"),
        F.coalesce(check_dims(embedding, dims), missing.cast("array<float>")).alias("embedding"),
        null_metadata(metadata).alias("metadata"),
    )


def append_numbered(table: DataFrame, numbered: DataFrame, dims: int) -> DataFrame:
    """The table plus rows that have their ids already; a bad vector fails all of them."""
    added = prepare_vectors(numbered, dims)
    if "created_at" in table.columns:
        added = added.withColumn("created_at", F.current_timestamp())
    return table.unionByName(added.select(*table.columns))


def insert_documents(
    table: DataFrame, docs: DataFrame, dims: int, order: Sequence[str] = (), last_id: int = 0
) -> DataFrame:
    """The table after appending a batch of ``(content, embedding, metadata)``.

    Ids go on from ``last_id``. A vector of another length fails the whole batch.
    """
    return append_numbered(table, assign_ids(docs, last_id + 1, order), dims)


def documents_from_items(items: DataFrame) -> DataFrame:
    """Items to ``(content, metadata)``, keeping the other columns."""
    return items.select(
        *[column(items, c) for c in items.columns if c not in (*CONTENT_FIELDS, "metadata")],
        extract_page_content(items).alias("content"),
        extract_metadata(items).alias("metadata"),
    )


def embed_documents(docs: DataFrame, embedder) -> DataFrame:
    """``docs`` plus the ``embedding`` of their ``content``."""
    return docs.withColumn("embedding", embed_text(F.col("content"), embedder))


def add_documents(
    table: DataFrame, docs: DataFrame, embedder, dims: int, order: Sequence[str] = (),
    last_id: int = 0,
) -> DataFrame:
    """Embed the contents, then insert.

    Ids are given before the model runs: a sort reads its input twice, and the model
    should see each text once.
    """
    numbered = assign_ids(docs, last_id + 1, order)
    return append_numbered(table, embed_documents(numbered, embedder), dims)


def ingest_markdown(
    table: DataFrame, docs: DataFrame, embedder, dims: int, key: str, text: str = "text",
    last_id: int = 0,
) -> DataFrame:
    """Documents to chunks to vectors to table rows, in document and chunk order."""
    # staged, as the sort behind the ids would otherwise cut the documents twice
    chunks = stage(chunk_markdown(docs.select(key, text), text), "chunks")
    rows = add_documents(table, chunks, embedder, dims, (key, "chunk"), last_id)
    unstage(chunks)  # the numbered copy has been written
    return rows
