"""Catalog tables, the vector store, the table editor, and the stream upsert."""

import json

import pytest
from row_helpers import tuples
from pyspark.sql import functions as F

from nearspark.functions.embedder import HashingEmbedder
from nearspark.operators.edits import ORDINAL
from nearspark.sources import catalog
from nearspark.sources.ledger import LedgerTable
from nearspark.sources.staging import stage, staging_root
from nearspark.store import VectorStore
from nearspark.streaming.upsert import KeyedTable, stream_upsert
from nearspark.table import ItemError, TableEditor


def docs(spark, rows):
    return spark.createDataFrame(rows, "n int, content string, embedding array<float>, metadata string")


BATCH = [
    (1, "Hello world", [0.1, 0.2, 0.3], '{"source":"test","category":"greeting"}'),
    (2, "Foo bar", [0.4, 0.5, 0.6], '{"source":"test","category":"misc"}'),
    (3, "Vector search", [0.7, 0.8, 0.9], '{"source":"demo","category":"tech"}'),
]


def test_staging_uses_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert staging_root(spark) == root
    assert root in stage(spark.range(3)).inputFiles()[0]


def test_vector_table_lifecycle(spark):
    store = VectorStore(spark, HashingEmbedder(3), "itest_docs")
    store.drop()
    assert not catalog.table_exists(spark, "itest_docs")
    with pytest.raises(ValueError, match="does not exist"):
        store.rows()
    assert store.add_vectors(docs(spark, BATCH), ("n",)) == 3
    assert store.add_vectors(docs(spark, [(1, "No metadata doc", [0.15, 0.25, 0.35], None)])) == 1
    assert store.add_vectors(docs(spark, [])) == 0
    rows = store.rows().orderBy("id").collect()
    assert [(r.id, r.content) for r in rows] == [
        (1, "Hello world"), (2, "Foo bar"), (3, "Vector search"), (4, "No metadata doc"),
    ]
    assert rows[3].metadata == "null" and all(r.created_at is not None for r in rows)

    top = store.similarity_search_vector([0.1, 0.2, 0.3], 5).collect()
    assert [r.id for r in top] == [1, 4, 2, 3]
    found = store.similarity_search_vector([0.5] * 3, 10, '{"source":"test"}')
    assert sorted(r.id for r in found.collect()) == [1, 2]
    for kind in ("hnsw", "ivfflat"):
        store.create_index(kind, **({"lists": 2} if kind == "ivfflat" else {}))
        assert store.similarity_search_vector([0.1, 0.2, 0.3], 3).first().content == "Hello world"
    with pytest.raises(ValueError, match="Unsupported index type"):
        store.create_index("btree")

    with pytest.raises(Exception, match="vector has 2 dimensions, expected 3"):
        store.add_vectors(docs(spark, [*BATCH, (4, "bad", [1.0, 2.0], None)]), ("n",))
    assert store.rows().count() == 4

    catalog.truncate(spark, "itest_docs")
    store.add_vectors(docs(spark, BATCH), ("n",))
    assert sorted(r.id for r in store.rows().collect()) == [5, 6, 7]
    catalog.truncate(spark, "itest_docs", restart_identity=True)
    store.add_vectors(docs(spark, BATCH), ("n",))
    assert sorted(r.id for r in store.rows().collect()) == [1, 2, 3]
    store.drop()
    store.drop()
    assert not catalog.table_exists(spark, "public.itest_docs")


def test_index_belongs_to_the_table(spark):
    """Another store uses it, sees rows inserted since, and edits remove it."""
    store, other = (VectorStore(spark, HashingEmbedder(3), "itest_index", metric="l2") for _ in range(2))
    store.drop()
    store.add_vectors(docs(spark, BATCH), ("n",))
    for kind in ("hnsw", "ivfflat"):
        store.create_index(kind)
        assert other.index().path == store.index().path and other.index().total == store.rows().count()
        other.add_vectors(docs(spark, [(1, "newer", [0.1, 0.2, 0.31], None)]))
        for s in (store, other):
            found = s.similarity_search_vector([0.1, 0.2, 0.31], 10).collect()
            assert found[0].content == "newer" and len(found) == s.rows().count()
        assert VectorStore(spark, HashingEmbedder(3), "itest_index").index() is None  # built for another metric
    path = store.index().path
    catalog.edit(spark, "itest_index", lambda rows: rows.filter("content <> 'newer'"))
    assert store.index() is None and path.startswith(catalog.home(spark, "itest_index"))
    assert [r.id for r in store.similarity_search_vector([0.1, 0.2, 0.3], 1).collect()] == [1]
    store.drop()


def test_create_twice(spark):
    catalog.drop_table(spark, "twice")
    catalog.create_vector_table(spark, "twice", 3)
    catalog.create_vector_table(spark, "twice", 3, if_not_exists=True)
    with pytest.raises(ValueError, match="already exists"):
        catalog.create_vector_table(spark, "twice", 3)
    field = spark.table("public.twice").schema["embedding"]
    assert field.metadata.get("dims") == 3
    catalog.drop_table(spark, "twice")


def test_dimensions_unknown(spark):
    store = VectorStore(spark, HashingEmbedder(3), "no_dims")
    with pytest.raises(ValueError, match="Vector dimensions unknown"):
        store.add_vectors(docs(spark, []))


def test_store_modes(spark):
    store = VectorStore(spark, HashingEmbedder(32), "mode_docs", "cosine", 32)
    store.drop()
    items = spark.createDataFrame(
        [("apples are red", "a"), ("bananas are yellow", "b"), ("spark runs queries", None)],
        "text string, source string",
    ).select("text", F.struct("source").alias("metadata"))
    assert tuples(store.insert(items)) == [(True, 3, "public.mode_docs")]
    row = store.get_many("spark queries", 1).first()
    assert row.pageContent == "spark runs queries" and json.loads(row.metadata) == {}
    ranked = store.retrieve("bananas yellow", 2).orderBy("rank").collect()
    assert ranked[0].content == "bananas are yellow"
    assert store.as_tool(1)("red apples") == "apples are red"
    store.drop()


@pytest.fixture
def editor(spark):
    catalog.drop_table(spark, "qa_users")
    schema = spark.createDataFrame([], "id long, name string, age int").schema
    catalog.create_table(spark, "qa_users", schema)
    yield TableEditor(spark, "qa_users", unique="name", not_null=["name"])
    catalog.drop_table(spark, "qa_users")


def items(spark, rows, schema):
    return spark.createDataFrame(rows, f"{ORDINAL} long, {schema}")


def test_editor_steps(spark, editor):
    two = items(spark, [(0, 1, "alice", 30), (1, 2, "bob", 20)], "id long, name string, age int")
    assert sorted(tuples(editor.insert(two))) == [(0, True, 1), (1, True, 1)]
    assert tuples(editor.select("age", [("name", "=", "alice")])) == [(30,)]
    with pytest.raises(ItemError, match="duplicate key"):
        editor.insert(two)
    assert sorted(tuples(editor.insert(two, skip_on_conflict=True))) == [(0, True, 0), (1, True, 0)]

    age = items(spark, [(0, "alice", 31), (1, "nobody", 1)], "name string, age int")
    assert sorted(tuples(editor.update(age, "name"))) == [(0, True, 1), (1, True, 0)]
    assert tuples(editor.update(age, "name", "id,age")) == [(0, 1, 31)]

    both = items(spark, [(0, "alice", 32), (1, "dave", 9), (2, "dave", 10)], "name string, age int")
    found = editor.upsert(both, "name", "name,age")
    assert sorted(tuples(found)) == [(0, "alice", 32), (1, "dave", 9), (2, "dave", 10)]
    assert sorted(tuples(editor.select("name,age"))) == [("alice", 32), ("bob", 20), ("dave", 10)]
    assert tuples(editor.update_values("name", "bob", {"age": "21"})) == [(0, True, 1)]
    assert tuples(editor.upsert_values("name", "erin", {"age": "5"})) == [(0, True, 1)]
    assert tuples(editor.insert_values({"name": "fay", "age": "1"}, output_columns="name")) == [
        (0, "fay")
    ]
    assert tuples(editor.delete(where=[("age", ">", "9")])) == [(True, 3)]
    assert sorted(r.name for r in editor.rows().collect()) == ["erin", "fay"]
    assert tuples(editor.delete("truncate")) == [(True, 0)]
    assert editor.rows().count() == 0
    assert tuples(editor.delete("drop")) == [(True, 0)] == tuples(editor.delete("drop"))
    with pytest.raises(ValueError, match="Invalid delete command"):
        editor.delete("vacuum")


def test_batches_are_atomic(spark, editor):
    rows = items(spark, [(0, "ok", "1"), (1, "bad", "x"), (2, None, "2")], "name string, age string")
    with pytest.raises(ItemError, match=r"invalid input syntax .*\[item 1\]"):
        editor.insert(rows)
    assert editor.rows().count() == 0
    editor.continue_on_fail = True
    assert tuples(editor.insert(rows)) == [(0, True, 1)]
    assert sorted(r[ORDINAL] for r in editor.errors.collect()) == [1, 2]
    assert tuples(editor.select("name,age")) == [("ok", 1)]


def test_failed_edit_leaves_the_table(spark, editor):
    editor.insert(items(spark, [(0, "a", 1)], "name string, age int"))
    boom = F.raise_error(F.lit("boom")).cast("int")
    with pytest.raises(Exception, match="boom"):
        catalog.edit(spark, "qa_users", lambda t: t.withColumn("age", boom))
    assert tuples(editor.select("name,age")) == [("a", 1)]


def test_stream_upsert(spark, tmp_path):
    source, schema = tmp_path / "in", "k long, seq long, v string"
    table = KeyedTable(
        spark, str(tmp_path / "table"), spark.createDataFrame([], schema).schema, "k", "seq", 4
    )

    def feed(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        stream_upsert(stream, table, str(tmp_path / "progress")).awaitTermination()
        return sorted(tuples(table.read().select("k", "seq", "v")))

    assert feed([(1, 1, "a"), (2, 2, "b"), (1, 3, "c")]) == [(1, 3, "c"), (2, 2, "b")]
    # 4 comes late for key 1, where 3 would have been the last word
    assert feed([(1, 2, "late"), (3, 4, "d"), (2, 5, "e")]) == [
        (1, 3, "c"), (2, 5, "e"), (3, 4, "d"),
    ]
    before = sorted(tuples(table.read().select("k", "seq", "v")))
    table.upsert(spark.createDataFrame([(2, 5, "e"), (3, 4, "d")], schema))
    assert sorted(tuples(table.read().select("k", "seq", "v"))) == before


def test_stream_batches_are_whole_and_counted_once(spark, tmp_path, monkeypatch):
    schema = "k long, seq long, v string"
    table = KeyedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema, "k", "seq", 4)
    rows = lambda: sorted(tuples(table.read().select("k", "seq", "v")))
    batch = lambda n, v: spark.createDataFrame([(k, n, v) for k in range(20)], schema)
    table.upsert(batch(1, "a"), 0, "s")
    before = rows()

    def killed(*args, **kwargs):
        raise KeyboardInterrupt("after the files, before the ledger")

    with monkeypatch.context() as patch:
        patch.setattr(table.table, "commit", killed)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(batch(2, "b"), 1, "s")
    assert rows() == before  # some buckets had new files already
    table.upsert(batch(2, "b"), 1, "s")
    assert rows() == [(k, 2, "b") for k in range(20)]
    table.upsert(batch(3, "c"), 1, "s")  # a repeated batch changes nothing
    assert rows() == [(k, 2, "b") for k in range(20)]
    table.upsert(batch(3, "c"), 0, "other")
    assert rows() == [(k, 3, "c") for k in range(20)]
    reader = table.read()
    table.upsert(batch(4, "d"), 1, "other")
    assert reader.filter("v = 'c'").count() == 20  # the state before stays readable
    one = spark.createDataFrame([(5, 9, "x")], schema)
    files = set(table.table.files())
    table.upsert(one, 2, "other")
    assert len(files & set(table.table.files())) >= len(files) - 1  # other buckets keep their files


def test_ledger_edits_rewrite_hit_files_only(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id", "concat('n', id) AS name", "id % 10 AS age")
    table = LedgerTable.create(spark, str(tmp_path / "t"), rows.schema)
    table.append(rows.repartitionByRange(8, "id"))
    assert len(table.files()) == 8 and LedgerTable.create(spark, table.path, rows.schema).version() == table.version()
    editor = TableEditor(spark, table, unique="id", not_null=["age"])
    before = set(table.files())

    def items(*values):
        return spark.createDataFrame([(n, *v) for n, v in enumerate(values)], f"{ORDINAL} long, id long, name string, age long")

    summary = editor.update(items((7, "seven", 1), (9, "nine", 2)), "id")
    assert [r.affectedRows for r in summary.collect()] == [1, 1]
    assert len(before & set(table.files())) == 7
    state, version = sorted(tuples(editor.rows())), table.version()
    with pytest.raises(ItemError, match="not-null"):
        editor.update(items((3999, "last", None)), "id")
    with pytest.raises(Exception, match="boom"):
        table.edit(lambda t: t.filter("id = 1"), lambda t: t.withColumn("name", F.raise_error(F.lit("boom")).cast("string")))
    assert table.version() == version and sorted(tuples(editor.rows())) == state
    editor.upsert(items((3999, "last", 3), (4000, "new", 4)), "id")
    editor.delete(where=[("id", "<", "5")])
    editor.delete_each(items((10, "n10", 0), (11, "?", 0)), [("id", "=", "id"), ("name", "=", "name")])
    editor.insert(items((5000, "more", 5)))
    found = {r.id: (r.name, r.age) for r in editor.rows().collect()}
    expected = {k: (f"n{k}", k % 10) for k in range(5, 4000) if k != 10}
    expected |= {7: ("seven", 1), 9: ("nine", 2), 3999: ("last", 3), 4000: ("new", 4), 5000: ("more", 5)}
    assert found == expected and len(before & set(table.files())) == 6
    with pytest.raises(RuntimeError, match="meanwhile"):
        table.commit([], base=version)
    editor.delete("truncate")
    assert editor.rows().count() == 0 and table.vacuum(1) > 0 and table.vacuum(1) == 0
    assert table.read().schema == rows.schema


def test_edits_keep_constraints(spark):
    """NULL and duplicate values are refused by every edit, and the table stays as it was."""
    catalog.drop_table(spark, "qa_limits")
    catalog.create_table(spark, "qa_limits", spark.createDataFrame([], "id long, name string, age int").schema)
    editor = TableEditor(spark, "qa_limits", unique=[["id"], ["name"]], not_null=["age"])

    def items(*rows):
        return spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], f"{ORDINAL} long, id long, name string, age int")

    editor.insert(items((1, "alice", 30), (2, "bob", 40), (3, "carol", 50)))
    before = sorted(tuples(editor.rows()))
    named = lambda *rows: items(*((*r, 0) for r in rows)).drop("age")
    with pytest.raises(ItemError, match="unique"):
        editor.insert(items((4, "bob", 1)))
    with pytest.raises(ItemError, match="unique"):
        editor.update(named((1, "bob")), "id")
    with pytest.raises(ItemError, match="unique"):
        editor.update(named((1, "x"), (2, "x")), "id")
    with pytest.raises(ItemError, match="not-null"):
        editor.update(items((1, "alice", None)), "id")
    with pytest.raises(ItemError, match="unique"):
        editor.upsert(items((9, "carol", 1)), "id")
    with pytest.raises(ItemError, match="not-null"):
        editor.upsert(named((9, "new")), "id")
    assert sorted(tuples(editor.rows())) == before
    editor.update(named((1, "bob"), (2, "alice")), "id")  # swapped in one batch
    skipped = editor.insert(items((5, "bob", 1), (6, "dave", 2), (6, "erin", 3), (7, "erin", 4)), skip_on_conflict=True)
    assert sorted(r.affectedRows for r in skipped.collect()) == [0, 0, 1, 1]
    assert sorted(tuples(editor.rows())) == [(1, "bob", 30), (2, "alice", 40), (3, "carol", 50), (6, "dave", 2), (7, "erin", 4)]
    gone = editor.delete_each(items((0, "dave", 45), (0, "x", 1)), [("name", "=", "name"), ("age", ">", "age")], "OR")
    assert sorted((r[0], r[2]) for r in tuples(gone)) == [(0, 2), (1, 3)] and editor.rows().count() == 0
    catalog.drop_table(spark, "qa_limits")


def test_select_and_query_for_each_item(spark):
    catalog.drop_table(spark, "qa_each")
    rows = spark.createDataFrame([(k, f"g{k % 3}", k * 10) for k in range(9)], "id long, grp string, age int")
    catalog.create_table(spark, "qa_each", rows.schema)
    catalog.append(spark, "qa_each", rows)
    editor = TableEditor(spark, "qa_each", unique="id")
    items = spark.createDataFrame([(0, "g1", 20), (1, "g2", 0), (2, "none", 0)], f"{ORDINAL} long, g string, least int")
    found = editor.select_each(items, [("grp", "=", "g"), ("age", ">=", "least")], "id", sort=[("age", "DESC")], limit=2)
    assert sorted(tuples(found)) == [(0, 4), (0, 7), (1, 5), (1, 8)]
    found = editor.execute_query(
        "SELECT count(*) AS n, max(age) AS top FROM public.qa_each WHERE grp = $1 AND age >= $2 HAVING count(*) > 0", ["g", "least"], items
    )
    assert sorted(tuples(found)) == [(0, 2, 70), (1, 3, 80)]
    catalog.drop_table(spark, "qa_each")
