import re

import numpy as np
import pytest
from row_helpers import tuples
from pyspark.sql import functions as F

from nearspark.functions.distance import (
    check_dims, distance, parse_vector, vector_literal, vector_text,
)
from nearspark.operators import ann
from nearspark.operators.ann import IvfIndex, LshIndex, create_index, recall
from nearspark.operators.knn import knn_join
from nearspark.operators.search import (
    get_many, retrieve_context, retrieve_documents, similarity_search,
)

GOLDEN = [
    ("cosine", [0.1, 0.2, 0.3], [(0.0, 1), (0.002585, 4), (0.025368, 2), (0.040588, 3)]),
    ("l2", [0.4, 0.5, 0.6], [(0.0, 2), (0.433013, 4), (0.519615, 1), (0.519615, 3)]),
    ("inner_product", [0.7, 0.8, 0.9], [(-1.94, 3), (-1.22, 2), (-0.62, 4), (-0.5, 1)]),
    ("manhattan", [0.1, 0.2, 0.3], [(0.0, 1), (0.15, 4), (0.9, 2), (1.8, 3)]),
]


@pytest.mark.parametrize("engine", ["arrow", "jvm"])
@pytest.mark.parametrize("metric, query, expected", GOLDEN)
def test_golden_distances(vectors, metric, query, expected, engine):
    found = similarity_search(vectors, query, 5, metric, engine=engine, decimals=6)
    assert [(r.distance, r.id) for r in found.collect()] == expected
    assert found.columns == ["id", "content", "metadata", "distance"]


def test_filter_comes_before_ranking(vectors):
    found = similarity_search(vectors, [0.5] * 3, 10, "l2", {"source": "test"})
    assert [r.id for r in found.collect()] == [2, 1]
    both = {"source": "test", "category": "greeting"}
    assert [r.id for r in similarity_search(vectors, [0.1] * 3, 10, filters=both).collect()] == [1]


@pytest.mark.parametrize("engine", ["arrow", "jvm"])
def test_zero_null_and_wrong_length(spark, engine):
    rows = [(1, [0.0, 0.0]), (2, None), (3, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    found = similarity_search(df, [1.0, 0.0], 5, columns=("id",), engine=engine).collect()
    assert [r.id for r in found] == [3, 1, 2]
    assert found[0].distance == 0 and np.isnan(found[1].distance) and found[2].distance is None
    with pytest.raises(Exception, match="different vector dimensions"):
        similarity_search(df, [1.0], 5, columns=("id",), engine=engine).collect()


def test_unknown_metric(vectors):
    with pytest.raises(ValueError, match="Unsupported distance strategy"):
        similarity_search(vectors, [1.0] * 3, metric="hamming")


def test_two_columns_and_dims(spark, vectors):
    row = vectors.select(distance("l2", F.col("embedding"), vector_literal([0.1, 0.2, 0.3]))).first()
    assert row[0] == pytest.approx(0, abs=1e-6)
    with pytest.raises(Exception, match="vector has 3 dimensions, expected 4"):
        vectors.select(check_dims(F.col("embedding"), 4)).collect()


def test_vector_text(spark):
    df = spark.createDataFrame([([1.0, -2.5, 1e-8],)], "v array<float>")
    text = df.select(vector_text(F.col("v")).alias("t"))
    assert text.first().t == "[1,-2.5,1e-8]"
    assert text.select(parse_vector(F.col("t"))).first()[0] == df.first().v


def test_retrieval_forms(vectors):
    top = similarity_search(vectors, [0.1, 0.2, 0.3], 2)
    docs = retrieve_documents(top)
    assert sorted(tuples(docs)) == [
        (1, "Hello world", '{"source":"test","category":"greeting"}'),
        (2, "No metadata doc", "{}"),
    ]
    assert retrieve_context(docs).first().context == "Hello world\n\nNo metadata doc"
    flipped = retrieve_documents(top, lambda d: d.withColumn("rank", 3 - F.col("rank")))
    assert retrieve_context(flipped).first().context == "No metadata doc\n\nHello world"


def test_get_many_shape(vectors):
    class Model:
        def embed_query(self, text):
            return [0.1, 0.2, 0.3]

    df = vectors.withColumn("metadata", F.when(F.col("id") != 1, F.col("metadata")))
    found = get_many(df, "hello", Model(), 1)
    assert found.columns == ["pageContent", "metadata", "score"]
    row = found.first()
    assert (row.pageContent, row.metadata, round(row.score, 6)) == ("Hello world", "{}", 0)


# ---------------------------------------------------------------- many queries

DIMS = 12


@pytest.fixture(scope="module")
def corpus(spark):
    """700 vectors, a third of them copies of one, plus zero and missing ones."""
    rng = np.random.default_rng(3)
    data = rng.standard_normal((700, DIMS)).astype(np.float32)
    data[::3] = data[0]
    data[5] = 0
    rows = [(i, data[i].tolist() if i != 7 else None) for i in range(700)]
    return data, spark.createDataFrame(rows, "id long, embedding array<float>").repartition(5).cache()


def brute(data, queries, k, metric, without=7):
    x = data.astype(np.float64)
    result = {}
    for qid in queries:
        q = x[qid]
        if metric == "l2":
            d = np.sqrt(((x - q) ** 2).sum(1))
        elif metric == "manhattan":
            d = np.abs(x - q).sum(1)
        elif metric == "inner_product":
            d = -(x * q).sum(1)
        else:
            norm = np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum())
            with np.errstate(all="ignore"):
                d = np.where(norm == 0, np.inf, np.clip(1 - (x * q).sum(1) / norm, 0, 2))
        d = np.round(d, 6)
        ids = [i for i in np.lexsort((np.arange(len(d)), d)) if i != without][:k]
        result[qid] = [(int(i), float(d[i]) + 0.0) for i in ids]
    return result


def as_lists(found):
    result = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        value = float("inf") if np.isnan(r.distance) else r.distance + 0.0
        result.setdefault(r.query_id, []).append((r.id, value))
    return result


@pytest.mark.parametrize("path", ["broadcast", "bounded", "pivots"])
@pytest.mark.parametrize("metric", ["l2", "cosine", "inner_product", "manhattan"])
def test_knn_join(corpus, metric, path):
    data, df = corpus
    limits = {
        "broadcast": {}, "bounded": {"first_slice": 9},
        "pivots": {"max_query_rows": 3, "block_rows": 150},
    }[path]
    found = as_lists(knn_join(df, df, 8, metric, decimals=6, **limits))
    expected = brute(data, [i for i in range(700) if i != 7], 8, metric)
    if metric == "cosine":
        del expected[5], found[5]  # the zero vector is at no distance from anything
    assert found == expected


def test_knn_join_leaves_out_far_cells(spark, caplog, monkeypatch):
    """Fewer pairs than all, tiles by bytes, and the same rows."""
    from nearspark.operators import knn

    data, df = clustered(spark, 1500)
    monkeypatch.setattr(knn, "BLOCK_BYTES", 16 * 8 * 50)
    for metric in ("l2", "manhattan", "cosine", "inner_product"):
        caplog.clear()
        with caplog.at_level("INFO", "nearspark.operators.knn"):
            found = as_lists(knn_join(df.filter("id < 200"), df, 5, metric, decimals=6, max_query_rows=3))
        assert found == brute(data, range(200), 5, metric, None)
        done, every = (float(w) for w in re.findall(r"[0-9]+", caplog.messages[-1]))
        assert every == 200 * 1500 and (done < 0.4 * every or metric == "inner_product")


def test_knn_join_of_zero_vectors(spark):
    rows = [(i, [0.0, 0.0] if i % 2 else [1.0, float(i)]) for i in range(6)] + [(9, None)]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    found = as_lists(knn_join(df, df, 5, "cosine", decimals=6, max_query_rows=2))
    assert [i for i, d in found[1]] == [0, 1, 2, 3, 4] and all(np.isinf(d) for _, d in found[1])
    assert [i for i, d in found[0]] == [0, 2, 4, 1, 3] and 9 not in found
    zeros = df.filter("id IN (1, 3)")
    assert [i for i, _ in as_lists(knn_join(df, zeros, 5, "cosine", max_query_rows=2))[0]] == [1, 3]
    assert knn_join(df, df.limit(0), 5, "l2", max_query_rows=2).count() == 0


def test_knn_join_fewer_rows_than_k(corpus):
    data, df = corpus
    narrow = as_lists(knn_join(df.filter("id < 3"), df.filter("id < 4"), 10, "l2", decimals=6, max_query_rows=1))
    assert narrow == brute(data[:4], [0, 1, 2], 10, "l2")
    found = as_lists(knn_join(df.filter("id < 3"), df.filter("id < 4"), 10, "l2", decimals=6))
    assert found == brute(data[:4], [0, 1, 2], 10, "l2")


@pytest.mark.parametrize("metric", ["l2", "cosine", "inner_product", "manhattan"])
def test_ivf(spark, corpus, metric):
    data, df = corpus
    index = IvfIndex.build(df, 9, metric)
    assert index.table.count() == 699
    query = data[20].tolist()
    found = index.search(query, 6, index.lists, columns=("id",), decimals=6)
    assert [(r.id, r.distance + 0.0) for r in found.collect()] == brute(data, [20], 6, metric)[20]
    narrow = index.search(query, 3, 1, columns=("id",))
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan
    exact = knn_join(df, df, 5, metric, decimals=6)
    full = index.knn_join(df, 5, index.lists, decimals=6)
    assert recall(exact, full).filter("recall < 1").count() == 0
    assert recall(exact, index.knn_join(df, 5, 2)).agg(F.avg("recall")).first()[0] > 0.3
    with pytest.raises(ValueError, match="index was built for"):
        index.search(query, 3, metric="cosine" if metric != "cosine" else "l2")


def test_ivf_widens_until_the_filter_is_served(spark, corpus):
    data, df = corpus
    rows = df.withColumn("metadata", F.when(F.col("id") % 97 == 1, F.lit('{"rare":"yes"}')))
    rows = rows.withColumn("content", F.lit("x"))
    index = IvfIndex.build(rows, 9, "l2")
    found = index.search(data[20].tolist(), 5, 1, {"rare": "yes"})
    assert found.count() == 5
    assert index.search(data[20].tolist(), 50, 1, {"rare": "yes"}).count() == 8


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_lsh(corpus, metric):
    data, df = corpus
    index = LshIndex.build(df, DIMS, metric)
    own = {r.query_id: r.id for r in index.knn_join(df, 1, decimals=6).collect()}
    expected = brute(data, [i for i in range(700) if i != 7], 1, metric)
    assert all(own[i] == expected[i][0][0] for i in expected if i != 5)
    found = index.search(data[20].tolist(), 699, columns=("id",))
    assert found.count() == 699  # widened to the whole table
    assert index.search(data[20].tolist(), 1, columns=("id",)).first().id == 20


def clustered(spark, count=3000, dims=16, groups=40):
    rng = np.random.default_rng(5)
    centers = rng.standard_normal((groups, dims)) * 4
    data = (centers[rng.integers(0, groups, count)] + rng.standard_normal((count, dims)) * 0.3).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id long, embedding array<float>")
    return data, rows.repartition(4).cache()


def test_lsh_reads_few_buckets_and_finds_the_neighbours(spark):
    data, df = clustered(spark)
    index = LshIndex.build(df, 16, "l2", bits=10)
    hits, read = 0, 0
    for q in range(0, 3000, 300):
        order, _, near = index.probed(data[q].tolist())[0]
        read += index.counts[0][order[:near]].sum()
        expected = brute(data, [q], 10, "l2", None)[q]
        found = index.search(data[q].tolist(), 10, columns=("id",), decimals=6)
        hits += len({r.id for r in found.collect()} & {i for i, _ in expected})
        if q % 900 == 0:
            exact = index.search(data[q].tolist(), 10, columns=("id",), decimals=6, exact=True)
            assert [(r.id, r.distance + 0.0) for r in exact.collect()] == expected
    assert hits >= 0.9 * 100 and read < 0.3 * 10 * 3000
    plan = index.search(data[0].tolist(), 3, columns=("id",))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hash_table" in plan and "folder" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_lsh_gap_bounds_the_distance(spark):
    rng = np.random.default_rng(1)
    rows, query = rng.standard_normal((200, 8)), rng.standard_normal(8)
    planes = ann.Hyperplanes.fit(rows, 8, "l2", 2, 6, 7)
    codes, offsets = planes.codes(rows), planes.offsets(query[None, :])[0]
    for t in range(2):
        assert (planes.gaps(offsets[t])[codes[:, t]] <= np.square(rows - query).sum(axis=1) + 1e-9).all()


@pytest.mark.parametrize("tables", [1, 3])
def test_batch_searches_fill_up(spark, corpus, tables):
    """Every query gets k rows, or all there are, however few its own bucket holds."""
    data, df = corpus
    asked = df.filter("id < 40")
    for index in (LshIndex.build(df, DIMS, "l2", tables=tables), IvfIndex.build(df, 60, "l2")):
        found = index.knn_join(asked, 300, decimals=6) if tables == 1 else index.knn_join(asked, 300, decimals=6, probes=2)
        sizes = {r.query_id: (r.n, r.least) for r in found.groupBy("query_id").agg(F.count("*").alias("n"), F.countDistinct("id").alias("least")).collect()}
        assert sizes == {i: (300, 300) for i in range(40) if i != 7}
    full = as_lists(index.knn_join(asked, 699, decimals=6))
    assert full == brute(data, [i for i in range(40) if i != 7], 699, "l2")


def test_two_level_cells(spark, monkeypatch):
    monkeypatch.setattr(ann, "DIRECT_LISTS", 8)
    data, df = clustered(spark)
    index = IvfIndex.build(df, metric="l2")
    assert len(index.cells.tops) == 7 and 40 <= index.lists <= 56 and index.table.count() == 3000
    hits = 0
    for q in range(0, 3000, 300):
        found = {r.id for r in index.search(data[q].tolist(), 10, columns=("id",), decimals=6).collect()}
        hits += len(found & {i for i, _ in brute(data, [q], 10, "l2", None)[q]})
    assert hits >= 90 and index.probes < index.lists / 2
    plan = index.search(data[0].tolist(), 3, 1, columns=("id",))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(coarse" in plan and "In(cell" in plan.replace("EqualTo(cell", "In(cell")


def test_an_index_is_opened_again(spark, corpus):
    data, df = corpus
    for index in (LshIndex.build(df, DIMS, "cosine", bits=4), IvfIndex.build(df, 9, "cosine")):
        again = ann.load_index(spark, index.path)
        assert type(again) is type(index) and again.total == 699
        one, two = (i.search(data[20].tolist(), 6, columns=("id",), decimals=6).collect() for i in (index, again))
        assert one == two


def test_index_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, embedding array<float>")
    for index in (LshIndex.build(empty, 3), IvfIndex.build(empty)):
        assert index.search([1.0, 2.0, 3.0], 5, columns=("id",)).collect() == []


def test_index_kinds(corpus):
    assert isinstance(create_index(corpus[1], "ivfflat", "l2", lists=3), IvfIndex)
    assert isinstance(create_index(corpus[1], "hnsw", "l2", dims=DIMS), LshIndex)
    with pytest.raises(ValueError, match="Unsupported index type: flat"):
        create_index(corpus[1], "flat")


def test_batch_search_has_no_cap_and_splits_hot_cells(spark, monkeypatch):
    from nearspark.operators import knn

    monkeypatch.setattr(knn, "BLOCK_ROWS", 7)
    rows = spark.range(300).selectExpr(
        "id", "array(float(if(id % 3 = 0, 1, id % 17)), float(id % 5), float(id % 7 + 1)) AS embedding"
    )
    exact = knn.knn_join(rows, rows, 3, "l2", decimals=6).select("query_id", "id", "rank")
    index = IvfIndex.build(rows, 4, "l2")
    found = index.knn_join(rows, 3, probes=4, decimals=6).select("query_id", "id", "rank")
    assert sorted(tuples(found)) == sorted(tuples(exact))
    top = LshIndex.build(rows, 3, "l2").knn_join(rows, 1, decimals=6)
    assert sorted(tuples(top.select("query_id", "id"))) == sorted(
        tuples(exact.filter("rank = 1").select("query_id", "id"))
    )


@pytest.mark.parametrize("metric", ["l2", "cosine", "inner_product", "manhattan"])
def test_best_rows_of_long_batches(monkeypatch, metric):
    """Parts of a batch, single precision and merges leave the exact result, with copies, zero vectors and huge ones."""
    from nearspark.functions.distance import paired
    from nearspark.operators import knn

    rng = np.random.default_rng(5)
    rows = rng.standard_normal((900, 6)) * rng.choice([1e-3, 1.0, 50.0], (900, 1))
    rows[100:400] = rows[7]
    rows[[3, 500]] = 0.0
    ids = rng.permutation(900).astype(np.int64)
    monkeypatch.setattr(knn, "FIRST_ROWS", 20)
    monkeypatch.setattr(knn, "MAX_NEW", 300)
    monkeypatch.setattr(knn, "TILE_CELLS", 5000)
    merges, taken = [], knn.Best._merge
    monkeypatch.setattr(knn.Best, "_merge", lambda self: (merges.append(1), taken(self)))
    for vectors in (rows, rows * 1e16):
        best = knn.Best(ids[:300], vectors[:300], 5, metric, 6)
        best.add(ids[:600], vectors[:600])
        best.add(ids[600:], vectors[600:])
        for n in range(300):
            distance = np.round(paired(metric, vectors, vectors[n]), 6)
            if np.isnan(distance).all():
                continue
            assert best.row[best.query == n].tolist() == ids[np.lexsort((ids, distance))[:5]].tolist()
    best = knn.Best(ids[:300], rows[:300], 5, metric, 6)
    merges.clear()
    monkeypatch.setattr(knn, "MAX_NEW", 10**6)
    best.add(ids, rows)
    assert len(merges) <= 5  # one for each part of the batch, not one for each slice of the queries


def test_tiles_take_known_bounds(spark, monkeypatch):
    from nearspark.operators import knn

    rng = np.random.default_rng(9)
    points = [(n, rng.standard_normal(4).round(3).tolist()) for n in range(300)]
    frame = spark.createDataFrame(points, "id long, embedding array<double>")
    monkeypatch.setattr(knn, "ASKED_ROWS", 40)
    expected = tuples(knn.knn_join(frame, frame, 3, "manhattan", decimals=6))
    found = tuples(knn.knn_join(frame, frame, 3, "manhattan", decimals=6, max_query_rows=0, block_rows=None))
    assert sorted(found) == sorted(expected)


def test_nearest_buckets_without_all_gaps(monkeypatch):
    """The filled codes of least gap, in nearly all cases without the gaps of all codes."""
    rng = np.random.default_rng(3)
    planes = ann.Hyperplanes.fit(rng.standard_normal((500, 16)), 16, "l2", 1, 12, 1)
    filled = np.sort(rng.permutation(1 << 12)[:2500])
    offsets = planes.offsets(rng.standard_normal((200, 16)))[:, 0]
    whole, calls = planes.gaps, []
    monkeypatch.setattr(planes, "gaps", lambda o: (calls.append(1), whole(o))[1])
    for offset in offsets:
        gap = whole(offset)
        for width in (1, 4, 16, 64):
            found = planes.nearest(offset, filled, width)
            assert len(set(found)) == width and set(found) <= set(filled)
            np.testing.assert_allclose(np.sort(gap[found]), np.sort(gap[filled])[:width])
    assert len(calls) < 20


@pytest.mark.parametrize("kind", ["plain", "far", "grouped", "same", "long"])
def test_steps_leave_out_most_pairs(monkeypatch, kind):
    """Manhattan: the best rows are those of all distances, of which few are taken; steps that leave too many are given up."""
    from nearspark.operators import knn

    rng = np.random.default_rng(3)
    dims = 300 if kind == "long" else 30
    rows, asked = rng.normal(size=(6000, dims)), rng.normal(size=(40, dims))
    if kind == "far":  # beside the grid, by far more than its steps can say
        rows[::7] *= 1e6
        rows[5::70] = asked[3] + 1e7
        asked[3] += 1e7
    elif kind == "grouped":
        rows = rng.normal(size=(60, dims))[np.arange(6000) % 60] + rng.normal(size=(6000, dims)) * 1e-3
        asked = rows[:40] + 1e-4
    elif kind == "same":
        asked[:] = asked[0]
    rows[1000:1100] = rows[:100]
    taken = []
    monkeypatch.setattr(knn, "FIRST_ROWS", 1000)
    kernel = knn.manhattan
    monkeypatch.setattr(knn, "manhattan", lambda a, b: (taken.append(len(a) * len(b)), kernel(a, b))[1])
    exact = np.round(np.abs(asked[:, None, :] - rows[None]).sum(axis=2), 6)
    best = knn.Best(np.arange(40), asked, 10, "manhattan", 6)
    best.add(np.arange(6000), rows)
    if kind == "plain":
        assert sum(taken) < 0.1 * exact.size
    expected = [sorted(zip(exact[n], range(6000)))[:10] for n in range(40)]
    found = best.batch().to_pydict()
    got = {n: [] for n in range(40)}
    for n, row, distance in zip(found["query_id"], found["id"], found["distance"]):
        got[n].append((distance, row))
    for n in range(40):
        assert [r for _, r in got[n]] == [r for _, r in expected[n]]
        np.testing.assert_allclose([d for d, _ in got[n]], [d for d, _ in expected[n]], rtol=1e-9)


def test_few_groups_are_cut_for_all_cores(spark, monkeypatch):
    """One group of cells: its queries are dealt to as many tiles as the cores need."""
    from nearspark.operators import knn

    points = [(n, [float(n % 37), float(n % 11), n / 500]) for n in range(500)]
    frame = spark.createDataFrame(points, "id long, embedding array<double>")
    monkeypatch.setattr(knn, "LEAST_ASKED", 10)
    parts, dealt = [], knn.bucket_candidates
    monkeypatch.setattr(knn, "bucket_candidates", lambda *a: (parts.append(a[6:]), dealt(*a))[1])
    found = tuples(knn.knn_join(frame, frame, 3, "manhattan", decimals=6, max_query_rows=0))
    monkeypatch.undo()
    assert parts[0] == () and parts[1][0] > 1
    assert sorted(found) == sorted(tuples(knn.knn_join(frame, frame, 3, "manhattan", decimals=6)))


def test_steps_bound_distances_from_below():
    from nearspark.functions.distance import Steps

    rng = np.random.default_rng(5)
    for dims in (1, 3, 64, 300):
        points, rows = rng.standard_t(2, size=(20, dims)), rng.standard_t(1, size=(500, dims)) * 50
        steps = Steps(points)
        (own, own_away), (others, away) = steps.cut(points), steps.cut(rows)
        exact = np.abs(points[:, None, :] - rows[None]).sum(axis=2)
        for share in (0.01, 0.3, 1.0):
            limit = np.quantile(exact, share, axis=1)
            near = steps.within(own, np.ascontiguousarray(others.T), away, limit / steps.size + own_away + 1e-6)
            assert near[exact <= limit[:, None]].all()
