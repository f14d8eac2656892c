import json
import re

import numpy as np
import pytest
from row_helpers import tuples
from pyspark.sql import functions as F

from nearspark.functions.embedder import HashingEmbedder
from nearspark.operators.ingest import (
    assign_ids, chunk_markdown, documents_from_items, embed_text, ingest_markdown,
    insert_documents, prepare_vectors,
)
from nearspark.sources.tables import describe_table, read_items, read_markdown


def chunks(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [(r.chunk, r.content, json.loads(r.metadata)) for r in
            chunk_markdown(df).orderBy("chunk").collect()]


def test_chunk_fixture(spark):
    found = chunks(spark, "intro\n# A\nbody\n## B\n\nx\n#tag")
    assert [(c.split("\n", 1)[0], c.split("\n", 1)[1]) for _, c, _ in found] == [
        ("intro", ""), ("A", "body"), ("B", "x"), ("tag", ""),
    ]
    assert [m for _, _, m in found] == [
        {"title": t, "source": "markdown_by_header"} for t in ("intro", "A", "B", "tag")
    ]


@pytest.mark.parametrize("text, contents", [
    ("", []),
    (" \n\t\n", []),
    ("#", ["\n"]),
    ("  # not at line start", ["not at line start\n"]),
    ("a\r\n# b\r\nc\r\n", ["a\n", "b\r\nc"]),
    ("a\r#b", ["a\n", "b\n"]),
    ("a\u2028# b", ["a\n", "b\n"]),
    ("a\u0085# b", ["a\u0085# b\n"]),
    ("\u00a0\n#\u3000T \n\ufeffx\n\n y \n", ["T \nx\n\n y"]),
    ("```\n# code\n```", ["```\n", "code\n```"]),
    ("####   deep\n\n\nbody # no\n", ["deep\nbody # no"]),
])
def test_chunk_edges(spark, text, contents):
    assert [c for _, c, _ in chunks(spark, text)] == contents


def test_null_text_has_no_chunks(spark):
    assert chunks(spark, None) == []


def test_items(spark):
    schema = "content string, text string, pageContent string, n int, metadata struct<source:string>"
    rows = [
        ("a", "b", "c", 1, ("s",)), ("", "b", "c", 2, None), (None, None, "c", 3, (None,)),
        (None, "", None, 4, None),
    ]
    found = tuples(documents_from_items(spark.createDataFrame(rows, schema)).orderBy("n"))
    assert [r[1] for r in found[:3]] == ["a", "b", "c"]
    assert json.loads(found[3][1]) == {
        "content": None, "text": "", "pageContent": None, "n": 4, "metadata": None,
    }
    assert [r[2] for r in found] == ['{"source":"s"}', "{}", "{}", "{}"]


def test_items_without_known_fields(spark):
    df = spark.createDataFrame([(1, "x")], "n int, body string")
    assert tuples(documents_from_items(df)) == [(1, "x", '{"n":1,"body":"x"}', "{}")]


def test_embedder():
    model = HashingEmbedder(16)
    one = model.embed_documents(["Hello hello\tWORLD", "", "  world  "])
    assert one.shape == (3, 16) and one.dtype == np.float32
    assert np.linalg.norm(one[0]) == pytest.approx(1) and not one[1].any()
    assert model.embed_query("hello hello world") == one[0].tolist()
    assert sorted(one[0][one[0] > 0].tolist()) == pytest.approx([0.2**0.5, 0.8**0.5])


def test_embed_column_handles_null_and_batches(spark):
    model = HashingEmbedder(8)
    df = spark.range(2000).select(
        "id", F.when(F.col("id") != 5, F.concat(F.lit("t"), F.col("id"))).alias("text")
    )
    found = df.select("id", embed_text(F.col("text"), model).alias("v")).collect()
    assert all(r.v == model.embed_query(f"t{r.id}" if r.id != 5 else "") for r in found)


def test_assign_ids_is_dense_and_ordered(spark):
    df = spark.range(10_000).select((F.lit(9_999) - F.col("id")).alias("ord")).repartition(7)
    found = assign_ids(df, 5, ("ord",))
    assert found.filter(F.col("id") != F.col("ord") + 5).count() == 0
    loose = assign_ids(df, 1).agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()
    assert tuple(loose) == (1, 10_000, 10_000)
    assert assign_ids(df.filter("ord < 0"), 1, ("ord",)).count() == 0


def test_assign_ids_keeps_one_reading_of_the_rows(spark):
    """Random values are written once, so counting and numbering see the same rows."""
    df = spark.range(1000).select("id", F.rand().alias("r")).withColumnRenamed("id", "n")
    found = assign_ids(df, 1, ("r",)).orderBy("id").collect()
    assert [r.r for r in found] == sorted(r.r for r in found)


def test_insert_documents(spark, vectors):
    batch = spark.createDataFrame(
        [(2, "second", [1.0, 2.0, 3.0], None), (1, "first", [3.0, 2.0, 1.0], "{}")],
        "n int, content string, embedding array<double>, metadata string",
    )
    table = insert_documents(vectors, batch, 3, ("n",), 4)
    assert [(r.id, r.content, r.metadata) for r in table.orderBy("id").collect()][4:] == [
        (5, "first", "{}"), (6, "second", "null"),
    ]
    with pytest.raises(Exception, match="vector has 3 dimensions, expected 4"):
        prepare_vectors(batch, 4).collect()
    with pytest.raises(Exception, match="not-null"):
        prepare_vectors(batch.withColumn("content", F.lit(None).cast("string")), 3).collect()


def test_the_model_runs_once_per_text(spark):
    df = spark.createDataFrame([(1, "# a\nb")], "doc_id long, text string")
    empty = spark.createDataFrame(
        [], "id long, content string, embedding array<float>, metadata string"
    )
    chunked = chunk_markdown(df).withColumn(
        "embedding", embed_text(F.col("content"), HashingEmbedder(8))
    )
    plan = prepare_vectors(chunked, 8)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython \[embed", plan)) == 1
    assert plan.count("embed(") == 1 or plan.count("ArrowEvalPython") == 1
    rows = ingest_markdown(empty, df, HashingEmbedder(8), 8, "doc_id").collect()
    assert [(r.id, r.content) for r in rows] == [(1, "a\nb")]


def test_readers(spark, tmp_path):
    (tmp_path / "md" / "sub").mkdir(parents=True)
    (tmp_path / "md" / "a.md").write_text("# A\nx\n")
    (tmp_path / "md" / "sub" / "b.md").write_text("two\n\nparagraphs")
    found = {r.path.rsplit("/", 1)[1]: r.text for r in read_markdown(spark, str(tmp_path / "md")).collect()}
    assert found == {"a.md": "# A\nx\n", "b.md": "two\n\nparagraphs"}
    (tmp_path / "items.json").write_text('{"content":"c","metadata":{"source":"s"}}\n{"text":"t"}\n')
    items = read_items(spark, str(tmp_path / "items.json"),
                       "content string, text string, metadata map<string,string>")
    docs = documents_from_items(items).orderBy("content")
    assert tuples(docs) == [("c", '{"source":"s"}'), ("t", "{}")]


def test_describe(vectors):
    assert tuples(describe_table(vectors))[:2] == [
        (1, "id", "bigint", "YES"), (2, "content", "string", "YES"),
    ]


def test_ids_stay_unique_when_a_task_writes_many_files(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    try:
        rows = spark.range(100).withColumnRenamed("id", "n").repartition(3)
        assert sorted(r.id for r in assign_ids(rows).collect()) == list(range(1, 101))
        ordered = assign_ids(rows, 5, ("n",)).collect()
        assert all(r.id == r.n + 5 for r in ordered)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_markdown_files_lie_in_folders(spark, tmp_path, monkeypatch):
    """Tasks that write the files grow with the documents; equal documents stay apart."""
    import nearspark.plans.tables as module
    from nearspark.plans.registry import QUERIES

    rows = [(n, f"text\n\n# {n} ") for n in range(60)] + [(3, "twice"), (3, "twice")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(module, "FOLDER_FILES", 2)
    monkeypatch.setattr(module, "new_path", lambda spark, label: str(tmp_path / label))
    found = QUERIES["read_markdown"](spark, str(tmp_path))
    assert sorted((r.doc_id, r.text, r.n) for r in found.collect()) == sorted((n, f"{t}\n", len(t) + 1) for n, t in rows)
    folders = list((tmp_path / "markdown").glob("folder=*"))
    assert len(folders) > 8 and sum(len(list(f.glob("part-*.txt"))) for f in folders) == len(rows)


def test_markdown_is_read_as_spark_reads_it(spark, tmp_path, monkeypatch):
    """Names, hidden, empty and compressed files, bytes that are no text; folders are listed in the tasks."""
    import gzip

    import nearspark.sources.tables as module

    for name, content in {
        "a b%20ü#.md": b"# A\r\n\n", "sub/deep/er/x.md": b"x\xff\xfe", "sub/_hidden.md": b"no", "_gone/x.md": b"no", "k=1/.x.md": b"no",
        "_k=2/y.md": b"yes", "empty.md": b"", "z.md.gz": gzip.compress(b"packed"), "sub/z.md._COPYING_": b"no", "k=1/z.md": b"\n" * 3,
        **{f"many/{n}.md": b"%d" % n for n in range(50)},
    }.items():
        (tmp_path / "md" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "md" / name).write_bytes(content)
    rows = lambda df: sorted((r.path, bytes(r.text)) for r in df.select("path", F.col("text").cast("binary").alias("text")).collect())
    path = str(tmp_path / "md")
    with monkeypatch.context() as patched:
        patched.setattr(module, "local_path", lambda spark, path: None)
        expected = rows(read_markdown(spark, path))
    assert len(expected) == 55
    for batch, listed in ((1000, 1000), (3, 2)):
        monkeypatch.setattr(module, "BATCH_FILES", batch)
        monkeypatch.setattr(module, "LISTED_FILES", listed)
        found = read_markdown(spark, path)
        assert "MapInArrow" in found._jdf.queryExecution().optimizedPlan().toString()
        assert rows(found) == expected == rows(read_markdown(spark, f"file://{path}"))
    assert rows(read_markdown(spark, f"{path}/k=*")) == [r for r in expected if "/k=1/" in r[0]]
    assert rows(read_markdown(spark, f"{path}/sub/deep/er/x.md")) == [r for r in expected if "/deep/" in r[0]]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_markdown(spark, f"{path}/none")


def test_markdown_is_written_without_checksum_files(spark, tmp_path):
    from nearspark.sources.tables import write_markdown

    rows = spark.range(40).select((F.col("id") % 7).alias("folder"), F.concat(F.lit("é\n"), "id").alias("value"))
    write_markdown(rows, str(tmp_path / "md"), 4)
    files = [f for f in (tmp_path / "md").rglob("*") if f.is_file()]
    assert sorted(f.read_text() for f in files) == sorted(f"é\n{n}\n" for n in range(40))
    assert {f.parent.name for f in files} == {f"folder={n}" for n in range(7)} == {f.name for f in (tmp_path / "md").iterdir()}
    with pytest.raises(FileExistsError):
        write_markdown(rows, str(tmp_path / "md"), 4)
    write_markdown(rows.limit(0), str(tmp_path / "none"), 1)
    assert read_markdown(spark, str(tmp_path / "none")).collect() == []
