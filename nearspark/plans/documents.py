"""Ingestion: content and metadata of items, chunks, embeddings, ids, inserts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.embedder import HashingEmbedder
from ..operators.ingest import (
    add_documents, assign_ids, chunk_markdown, documents_from_items, embed_text,
    extract_metadata, extract_page_content, ingest_markdown, insert_documents, prepare_vectors,
)
from ..operators.search import get_many
from ..sources.staging import stage
from ..store import VectorStore
from .registry import Tables, query
from .vectors import DIMS, RAG_SQL, rag_docs

EMBEDDER = HashingEmbedder(DIMS)
PROMPT = "Than heoron eratsh the Therin of the an"


def vectors_sql(source: str, key: str, text: str, name: str = "vec") -> str:
    """CTEs that embed ``source``: ``<name>(key, s, v)`` with one row per used slot."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""{name}_slots AS (
        SELECT {key}, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % {DIMS} AS s,
               count(*) AS c
        FROM (SELECT {key}, unnest(string_split_regex(
                  translate({text}, '{upper}', '{upper.lower()}'),
                  '[ \\t\\n\\v\\f\\r]+')) AS token FROM {source})
        WHERE token <> '' GROUP BY ALL),
    {name}_norm AS (SELECT {key}, sqrt(sum(c * c)) AS n FROM {name}_slots GROUP BY ALL),
    {name} AS (SELECT {key}, s, CAST(CAST(c / n AS FLOAT) AS DOUBLE) AS v
               FROM {name}_slots JOIN {name}_norm USING ({key}))"""


CHECKS_SQL = "round(sum(v), 5) AS total, round(sum(v * s), 4) AS weighted, count(*) AS used"


def checks() -> list:
    """Figures that pin a vector down, free of array formatting."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    add = lambda total, x: total + x
    return [
        F.round(F.aggregate(vector, F.lit(0.0), add), 5).alias("total"),
        F.round(
            F.aggregate(F.transform(vector, lambda x, i: x * i), F.lit(0.0), add), 4
        ).alias("weighted"),
        F.size(F.filter(vector, lambda x: x != 0)).cast("long").alias("used"),
    ]


# Items with any of the three text fields; every fourth source lacks all of them.
_ITEMS_SQL = """items AS (
    SELECT doc_id, CASE lang WHEN 'en' THEN text WHEN 'de' THEN '' END AS content,
           CASE WHEN lang = 'de' THEN text END AS text,
           CASE WHEN lang = 'fr' THEN text END AS "pageContent"
    FROM documents)"""


def _items(t: Tables) -> DataFrame:
    lang, text = F.col("lang"), F.col("text")
    return t.documents.select(
        "doc_id",
        F.when(lang == "en", text).when(lang == "de", F.lit("")).alias("content"),
        F.when(lang == "de", text).alias("text"),
        F.when(lang == "fr", text).alias("pageContent"),
    )


@query("extract_page_content", f"""
    WITH {_ITEMS_SQL}
    SELECT doc_id, coalesce(nullif(content, ''), nullif(text, ''), nullif("pageContent", ''),
        '{{"doc_id":' || doc_id || ',"content":null,"text":null,"pageContent":null}}') AS page
    FROM items""")
def _(t: Tables) -> DataFrame:
    items = _items(t)
    return items.select("doc_id", extract_page_content(items).alias("page"))


@query("extract_metadata", """
    SELECT doc_id, CASE WHEN lang = 'es' THEN '{}' ELSE
        CAST(to_json({'lang': lang, 'source': source}) AS VARCHAR) END AS meta
    FROM documents""")
def _(t: Tables) -> DataFrame:
    items = t.documents.select(
        "doc_id", F.when(F.col("lang") != "es", F.struct("lang", "source")).alias("metadata")
    )
    return items.select("doc_id", extract_metadata(items).alias("meta"))


@query("null_metadata", f"""
    WITH {RAG_SQL} SELECT id, content, coalesce(metadata, 'null') AS metadata FROM rag_docs""")
def _(t: Tables) -> DataFrame:
    return prepare_vectors(rag_docs(t), DIMS).select("id", "content", "metadata")


# Documents have no headings of their own: lines starting with A to F become some.
HEADED_SQL = r"""headed AS (
    SELECT doc_id, regexp_replace(text, '(?m)^([A-F])', '# \1', 'g') AS text FROM documents)"""
_WS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160) || chr(12288)"
CHUNKS_SQL = f"""{HEADED_SQL}, pieces AS (
        SELECT doc_id, list_filter(string_split(
            regexp_replace(text, '(?m)^#', chr(1) || '#', 'g'), chr(1)),
            lambda p: trim(p, {_WS}) <> '') AS parts FROM headed),
    sections AS (
        SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS chunk,
               trim(unnest(parts), {_WS}) AS piece FROM pieces),
    titled AS (
        SELECT *, regexp_replace(string_split(piece, chr(10))[1], '^#+[ \\t\\n\\f\\r]*', '') AS title
        FROM sections),
    chunks AS (
        SELECT doc_id, chunk, title || chr(10) || trim(array_to_string(
                   string_split(piece, chr(10))[2:], chr(10)), {_WS}) AS content,
               CAST(to_json({{'title': title, 'source': 'markdown_by_header'}}) AS VARCHAR)
               AS metadata
        FROM titled)"""


def headed(t: Tables) -> DataFrame:
    text = F.regexp_replace("text", "(?md)^([A-F])", "# $1")
    return t.documents.select("doc_id", text.alias("text"))


@query("chunk_markdown", f"WITH {CHUNKS_SQL} SELECT doc_id, chunk, content, metadata FROM chunks")
def _(t: Tables) -> DataFrame:
    return chunk_markdown(headed(t))


@query("embed_text", f"""
    WITH {vectors_sql('documents', 'doc_id', 'text')}
    SELECT doc_id, {CHECKS_SQL} FROM vec GROUP BY doc_id""")
def _(t: Tables) -> DataFrame:
    embedded = t.documents.select(
        "doc_id", embed_text(F.col("text"), EMBEDDER).alias("embedding")
    )
    return embedded.select("doc_id", *checks())


@query("get_many", f"""
    WITH prompt AS (SELECT 1 AS one, '{PROMPT}' AS text),
    {vectors_sql('documents', 'doc_id', 'text')},
    {vectors_sql('prompt', 'one', 'text', 'asked')},
    dots AS (SELECT doc_id, sum(vec.v * asked.v) AS dot FROM vec JOIN asked USING (s)
             GROUP BY doc_id),
    lengths AS (SELECT doc_id, sqrt(sum(v * v)) AS n FROM vec GROUP BY doc_id),
    scores AS (
        SELECT doc_id, round(least(greatest(1 - coalesce(dot, 0)
                   / (n * (SELECT sqrt(sum(v * v)) FROM asked)), 0.0), 2.0), 6) + 0.0 AS score
        FROM lengths LEFT JOIN dots USING (doc_id))
    SELECT text AS "pageContent",
           CAST(to_json({{'lang': lang, 'source': source}}) AS VARCHAR) AS metadata, score
    FROM scores JOIN documents USING (doc_id) ORDER BY score, doc_id LIMIT 10""")
def _(t: Tables) -> DataFrame:
    # ingested once; the search reads the stored vectors
    table = stage(t.documents.select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"),
        F.to_json(F.struct("lang", "source")).alias("metadata"),
        embed_text(F.col("text"), EMBEDDER).alias("embedding"),
    ), "vectors")
    found = get_many(table, PROMPT, EMBEDDER, decimals=6)
    return found.withColumn("score", F.col("score") + 0.0)


@query("assign_ids", """
    SELECT 100 + row_number() OVER (ORDER BY lang, doc_id) AS id, doc_id, lang, n_chars
    FROM documents""")
def _(t: Tables) -> DataFrame:
    return assign_ids(t.documents.select("doc_id", "lang", "n_chars"), 101, ("lang", "doc_id"))


# A batch of vectors to add behind the rag_docs table.
_BATCH_SQL = """
    SELECT 1000000 + row_number() OVER (ORDER BY label, vec_id) AS id,
           'label ' || label AS content, embedding, 'null' AS metadata
    FROM embeddings"""
_SHOWN_SQL = ("id, content, metadata, round(list_sum(CAST(embedding AS DOUBLE[])), 5) + 0.0 "
              "AS total, len(embedding) AS dims")


def _batch(t: Tables) -> DataFrame:
    return t.embeddings.select(
        "label", "vec_id", F.concat(F.lit("label "), F.col("label")).alias("content"), "embedding"
    )


def _inserted(t: Tables) -> DataFrame:
    table = rag_docs(t).select("id", "content", "embedding", "metadata")
    return insert_documents(table, _batch(t), DIMS, ("label", "vec_id"), 1_000_000)


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id", "content", "metadata", (checks()[0] + 0.0).alias("total"),
        F.size("embedding").cast("long").alias("dims"),
    )


@query("insert_documents", f"""
    WITH {RAG_SQL} SELECT {_SHOWN_SQL} FROM (
        SELECT id, content, embedding, metadata FROM rag_docs UNION ALL {_BATCH_SQL})""")
def _(t: Tables) -> DataFrame:
    return _shown(_inserted(t))


def _store(t: Tables) -> VectorStore:
    """A store over a table of its own, made by its first insert."""
    return VectorStore(t.spark, EMBEDDER, f"query_{uuid.uuid4().hex}", dims=DIMS)


@query("add_vectors", f"""
    SELECT {_SHOWN_SQL} FROM ({_BATCH_SQL.replace('1000000 + ', '')})""")
def _(t: Tables) -> DataFrame:
    store = _store(t)
    store.add_vectors(_batch(t).withColumn("metadata", F.lit(None).cast("string")), ("label", "vec_id"))
    rows = stage(_shown(store.rows()), "rows")
    store.drop()
    return rows


@query("ingest_report", """
    SELECT true AS success, count(*) AS "insertedCount", true AS "stored" FROM documents""")
def _(t: Tables) -> DataFrame:
    store = _store(t)
    report = store.insert(t.documents.select("text", F.struct("lang").alias("metadata")))
    stored = stage(store.rows().agg(F.count(F.lit(1)).alias("n")), "rows")
    store.drop()
    return report.crossJoin(F.broadcast(stored)).select(  # one row each
        "success", "insertedCount", (F.col("n") == F.col("insertedCount")).alias("stored")
    )


@query("add_documents", f"""
    WITH {vectors_sql('documents', 'doc_id', 'text')},
    numbered AS (
        SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS id, text AS content,
               CAST(to_json({{'lang': lang}}) AS VARCHAR) AS metadata FROM documents)
    SELECT id, content, metadata, {CHECKS_SQL} FROM numbered JOIN vec USING (doc_id)
    GROUP BY ALL""")
def _(t: Tables) -> DataFrame:
    items = t.documents.select("doc_id", "text", F.struct("lang").alias("metadata"))
    docs = documents_from_items(items)
    added = add_documents(_empty(t), docs, EMBEDDER, DIMS, ("doc_id",))
    return added.select("id", "content", "metadata", *checks())


def _empty(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(
        [], "id long, content string, embedding array<float>, metadata string"
    )


@query("ingest_markdown", f"""
    WITH {CHUNKS_SQL},
    numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id, chunk) AS id FROM chunks),
    {vectors_sql('numbered', 'id', 'content')}
    SELECT id, content, metadata, {CHECKS_SQL} FROM numbered LEFT JOIN vec USING (id)
    GROUP BY ALL""")
def _(t: Tables) -> DataFrame:
    rows = ingest_markdown(_empty(t), headed(t), EMBEDDER, DIMS, "doc_id")
    return rows.select("id", "content", "metadata", *checks())
