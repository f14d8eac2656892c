"""Distances, exact and approximate search, retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distance import METRICS, check_dims, distance, parse_vector, vector_literal, vector_text
from ..operators.ann import IvfIndex, LshIndex, recall
from ..operators.knn import knn_join
from ..operators.predicates import bloom_options, metadata_filter, shred_metadata
from ..operators.search import (
    fetch, retrieve_context, retrieve_documents, similarity_search,
)
from ..sources.staging import new_path
from .registry import Tables, query

DECIMALS = 6
DIMS = 64
LISTS = 16

# Embeddings with their documents; label 3 has no metadata, label 7 a JSON null.
RAG_SQL = """rag_docs AS (
    SELECT vec_id AS id, text AS content, embedding, label,
           CASE WHEN label = 3 THEN NULL WHEN label = 7 THEN 'null'
                ELSE CAST(to_json({'lang': lang, 'source': source, 'label': label}) AS VARCHAR)
           END AS metadata
    FROM embeddings JOIN documents ON vec_id = doc_id)"""

# Embeddings of different length, so that the metrics rank differently.
SCALED_SQL = """scaled AS (
    SELECT vec_id AS id, label,
           CAST(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (1 + label)) AS FLOAT[])
           AS embedding
    FROM embeddings)"""
QUERY_SQL = "q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0)"

_A, _B = "CAST(e.embedding AS DOUBLE[])", "q.v"
DISTANCE_SQL = {
    "l2": f"list_distance({_A}, {_B})",
    "cosine": f"greatest(list_cosine_distance({_A}, {_B}), 0.0)",
    "inner_product": f"list_negative_inner_product({_A}, {_B})",
    "manhattan": f"list_sum(list_transform(list_zip({_A}, {_B}), lambda x: abs(x[1] - x[2])))",
}


def rag_docs(t: Tables) -> DataFrame:
    metadata = F.to_json(F.struct("lang", "source", "label"))
    return t.embeddings.join(t.documents, F.col("vec_id") == F.col("doc_id")).select(
        F.col("vec_id").alias("id"), F.col("text").alias("content"), "embedding", "label",
        F.when(F.col("label") == 3, F.lit(None).cast("string"))
        .when(F.col("label") == 7, F.lit("null")).otherwise(metadata).alias("metadata"),
    )


def rag_vectors(t: Tables) -> DataFrame:
    """``rag_docs`` without the texts: what a search ranks."""
    return rag_docs(t).drop("content")


def rag_texts(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").alias("id"), F.col("text").alias("content"))


def rag_search(t: Tables, metric: str = "cosine", filters: dict | None = None) -> DataFrame:
    """Ten nearest of ``rag_docs``; only their texts are read into a join."""
    found = similarity_search(
        rag_vectors(t), query_vector(t), 10, metric, filters, ("id", "metadata"), decimals=DECIMALS
    )
    return fetch(found, rag_texts(t)).select("id", "content", "metadata", "distance")


def scaled(t: Tables) -> DataFrame:
    factor = F.col("label") + 1
    vector = F.transform("embedding", lambda x: (x.cast("double") * factor).cast("float"))
    return t.embeddings.select(F.col("vec_id").alias("id"), "label", vector.alias("embedding"))


def query_vector(t: Tables) -> list[float]:
    """The search parameter: the vector with id 0."""
    return list(t.embeddings.filter("vec_id = 0").select("embedding").first()[0])


def rounded(metric: str) -> str:
    return f"round({DISTANCE_SQL[metric]}, {DECIMALS}) + 0.0"


def _distance(metric: str) -> None:
    @query(f"dist_{metric}", f"""
        WITH {QUERY_SQL}, {SCALED_SQL}
        SELECT id, {rounded(metric)} AS distance FROM scaled e, q""")
    def _(t: Tables) -> DataFrame:
        vector = F.col("embedding").cast("array<double>")
        value = distance(metric, vector, vector_literal(query_vector(t)))
        return scaled(t).select("id", (F.round(value, DECIMALS) + 0.0).alias("distance"))

    @query(f"similarity_search_{metric}", f"""
        WITH {QUERY_SQL}, {SCALED_SQL}
        SELECT id, label, {rounded(metric)} AS distance FROM scaled e, q
        ORDER BY distance NULLS LAST, id LIMIT 10""")
    def _(t: Tables) -> DataFrame:
        found = similarity_search(
            scaled(t), query_vector(t), 10, metric, columns=("id", "label"), decimals=DECIMALS
        )
        return found.withColumn("distance", F.col("distance") + 0.0)

    @query(f"knn_join_{metric}" if metric != "cosine" else "knn_join", f"""
        WITH {SCALED_SQL}, pairs AS (
            SELECT q.id AS query_id, e.id, {rounded(metric)} AS distance
            FROM scaled e, (SELECT id, CAST(embedding AS DOUBLE[]) AS v FROM scaled) q)
        SELECT query_id, id, distance, CAST(rank AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank
            FROM pairs)
        WHERE rank <= 10""")
    def _(t: Tables) -> DataFrame:
        rows = scaled(t)
        found = knn_join(rows, rows, 10, metric, decimals=DECIMALS)
        return found.withColumn("distance", F.col("distance") + 0.0)


for _metric in METRICS:
    _distance(_metric)


@query("knn_join_pivots", f"""
    WITH {SCALED_SQL}, pairs AS (
        SELECT q.id AS query_id, e.id, {rounded('l2')} AS distance
        FROM scaled e, (SELECT id, CAST(embedding AS DOUBLE[]) AS v FROM scaled) q)
    SELECT query_id, id, distance, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank
        FROM pairs)
    WHERE rank <= 10""")
def _(t: Tables) -> DataFrame:
    """The way of query sets that are too large to broadcast."""
    rows = scaled(t)
    found = knn_join(rows, rows, 10, "l2", decimals=DECIMALS, max_query_rows=0)
    return found.withColumn("distance", F.col("distance") + 0.0)


@query("similarity_search", f"""
    WITH {QUERY_SQL}, {RAG_SQL}
    SELECT id, content, metadata, {rounded('cosine')} AS distance FROM rag_docs e, q
    ORDER BY distance NULLS LAST, id LIMIT 10""")
def _(t: Tables) -> DataFrame:
    return rag_search(t).withColumn("distance", F.col("distance") + 0.0)


@query("similarity_search_filtered", f"""
    WITH {QUERY_SQL}, {RAG_SQL}
    SELECT id, content, metadata, {rounded('l2')} AS distance FROM rag_docs e, q
    WHERE json_type(metadata) = 'OBJECT'
      AND metadata ->> 'lang' = 'en' AND metadata ->> 'label' = '4'
    ORDER BY distance NULLS LAST, id LIMIT 10""")
def _(t: Tables) -> DataFrame:
    return rag_search(t, "l2", {"lang": "en", "label": 4}).withColumn("distance", F.col("distance") + 0.0)


@query("metadata_filter", f"""
    WITH {RAG_SQL} SELECT id, content, metadata FROM rag_docs
    WHERE json_type(metadata) = 'OBJECT' AND metadata ->> 'lang' = 'fr'""")
def _(t: Tables) -> DataFrame:
    return metadata_filter(rag_docs(t), {"lang": "fr"}).select("id", "content", "metadata")


@query("metadata_filter_shredded", f"""
    WITH {RAG_SQL} SELECT id, content, metadata FROM rag_docs
    WHERE json_type(metadata) = 'OBJECT' AND metadata ->> 'lang' = 'fr' AND metadata ->> 'label' = '4'""")
def _(t: Tables) -> DataFrame:
    """The filter on stored side columns, which reaches the files."""
    rows = shred_metadata(rag_docs(t))
    path = new_path(t.spark, "shredded")
    rows.write.options(**bloom_options(rows)).parquet(path)
    stored = t.spark.read.schema(rows.schema).parquet(path)
    return metadata_filter(stored, {"lang": "fr", "label": 4}).select("id", "content", "metadata")


@query("metadata_filter_empty", f"WITH {RAG_SQL} SELECT id, metadata FROM rag_docs")
def _(t: Tables) -> DataFrame:
    return metadata_filter(rag_docs(t), {}).select("id", "metadata")


_TOP_SQL = f"""
    WITH {QUERY_SQL}, {RAG_SQL}, hits AS (
        SELECT id, content, metadata, {rounded('cosine')} AS distance FROM rag_docs e, q
        ORDER BY distance NULLS LAST, id LIMIT 10),
    docs AS (SELECT *, row_number() OVER (ORDER BY distance, id) AS rank FROM hits)"""


def _top(t: Tables) -> DataFrame:
    return rag_search(t)


@query("retrieve_documents", f"""{_TOP_SQL}
    SELECT CAST(rank AS INTEGER) AS rank, content, coalesce(nullif(metadata, 'null'), '{{}}') AS metadata FROM docs""")
def _(t: Tables) -> DataFrame:
    return retrieve_documents(_top(t))


@query("retrieve_context", f"""{_TOP_SQL}
    SELECT string_agg(content, chr(10) || chr(10) ORDER BY rank) AS context FROM docs""")
def _(t: Tables) -> DataFrame:
    return retrieve_context(retrieve_documents(_top(t)))


def shortest_first(ranked: DataFrame) -> DataFrame:
    """A sample re-ranker for the at most ``k`` rows of a result."""
    order = Window.orderBy(F.length("content"), "id")
    return ranked.withColumn("rank", F.row_number().over(order))


@query("rerank", f"""{_TOP_SQL}
    SELECT CAST(row_number() OVER (ORDER BY length(content), id) AS INTEGER) AS rank, content,
           coalesce(nullif(metadata, 'null'), '{{}}') AS metadata FROM docs""")
def _(t: Tables) -> DataFrame:
    return retrieve_documents(_top(t), shortest_first)


@query("check_dims", """
    SELECT vec_id, len(embedding) AS dims, round(list_sum(CAST(embedding AS DOUBLE[])), 5) + 0.0 AS total
    FROM embeddings""")
def _(t: Tables) -> DataFrame:
    checked = t.embeddings.select("vec_id", check_dims(F.col("embedding"), DIMS).alias("v"))
    total = F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double")), 5) + 0.0
    return checked.select("vec_id", F.size("v").cast("long").alias("dims"), total.alias("total"))


@query("vector_text", """
    SELECT vec_id, '[' || label || ',' || label || '.5,-' || (label + 1) || ']' AS short,
           true AS same, 64::BIGINT AS parts
    FROM embeddings""")
def _(t: Tables) -> DataFrame:
    number = F.col("label").cast("float")
    text = vector_text(F.col("embedding"))
    return t.embeddings.select(
        "vec_id",
        vector_text(F.array(number, number + F.lit(0.5), -number - F.lit(1.0))).alias("short"),
        (parse_vector(text) == F.col("embedding")).alias("same"),
        F.size(F.split(text, ",")).cast("long").alias("parts"),
    )


def plain_vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("id"), "label", "embedding")


@query("ann_ivf")
def _(t: Tables) -> DataFrame:
    index = IvfIndex.build(plain_vectors(t))
    return index.search(query_vector(t), 10, columns=("id", "label"), decimals=DECIMALS)


@query("ann_ivf_all_probes", f"""
    WITH {QUERY_SQL}, {SCALED_SQL}
    SELECT id, label, {rounded('l2')} AS distance FROM scaled e, q
    ORDER BY distance NULLS LAST, id LIMIT 10""")
def _(t: Tables) -> DataFrame:
    index = IvfIndex.build(scaled(t), LISTS, "l2")
    found = index.search(query_vector(t), 10, LISTS, columns=("id", "label"), decimals=DECIMALS)
    return found.withColumn("distance", F.col("distance") + 0.0)


@query("ann_lsh")
def _(t: Tables) -> DataFrame:
    index = LshIndex.build(plain_vectors(t), DIMS)
    return index.search(query_vector(t), 10, columns=("id", "label"), decimals=DECIMALS)


def _top1(t: Tables, index) -> DataFrame:
    rows = plain_vectors(t)
    return index.knn_join(rows, 1, decimals=DECIMALS).select("query_id", "id")


_TOP1_SQL = f"""
    WITH pairs AS (
        SELECT a.vec_id AS query_id, b.vec_id AS id, round(greatest(list_cosine_distance(
            CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 0.0), {DECIMALS}) AS d
        FROM embeddings a, embeddings b)
    SELECT query_id, id FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS rank FROM pairs)
    WHERE rank = 1"""


@query("ann_top1_check", _TOP1_SQL)
def _(t: Tables) -> DataFrame:
    return _top1(t, IvfIndex.build(plain_vectors(t), LISTS))


@query("ann_top1_check_lsh", _TOP1_SQL)
def _(t: Tables) -> DataFrame:
    return _top1(t, LshIndex.build(plain_vectors(t), DIMS))


@query("ann_ivf_batch", f"""
    WITH {SCALED_SQL}, pairs AS (
        SELECT q.id AS query_id, e.id, {rounded('l2')} AS distance
        FROM scaled e, (SELECT id, CAST(embedding AS DOUBLE[]) AS v FROM scaled WHERE id % 100 = 0) q)
    SELECT query_id, id, distance, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs)
    WHERE rank <= 10""")
def _(t: Tables) -> DataFrame:
    rows = scaled(t)
    index = IvfIndex.build(rows, LISTS, "l2")
    found = index.knn_join(rows.filter("id % 100 = 0"), 10, LISTS, decimals=DECIMALS)
    return found.withColumn("distance", F.col("distance") + 0.0)


@query("ann_lsh_exact", f"""
    WITH {QUERY_SQL}, {SCALED_SQL}
    SELECT id, label, {rounded('l2')} AS distance FROM scaled e, q
    ORDER BY distance NULLS LAST, id LIMIT 10""")
def _(t: Tables) -> DataFrame:
    index = LshIndex.build(scaled(t), DIMS, "l2")
    found = index.search(query_vector(t), 10, columns=("id", "label"), decimals=DECIMALS, exact=True)
    return found.withColumn("distance", F.col("distance") + 0.0)


@query("ann_recall")
def _(t: Tables) -> DataFrame:
    """Recall of batch searches with the width that was measured when the index was built."""
    rows = plain_vectors(t)
    asked = rows.filter("id % 100 = 0")
    exact = knn_join(asked, rows, 10, decimals=DECIMALS)
    return recall(exact, IvfIndex.build(rows).knn_join(asked, 10, decimals=DECIMALS))
