import random

import math

import pytest
from row_helpers import tuples

from nearspark.operators.select import limit_rows, select_per_item, select_rows, sort_rows


def test_null_order(users):
    assert [r.id for r in sort_rows(users, [("age", "ASC")]).collect()] == [1, 3, 2]
    assert [r.id for r in sort_rows(users, [("age", "DESC")]).collect()] == [2, 3, 1]
    assert [r.id for r in sort_rows(users, [("age", "desc")]).collect()] == [1, 3, 2]
    rules = [{"column": "name", "direction": "DESC"}]
    assert [r.id for r in sort_rows(users, rules).collect()] == [3, 2, 1]


def test_limit(spark):
    df = spark.range(120)
    assert limit_rows(df).count() == 50
    assert limit_rows(df, return_all=True).count() == 120
    with pytest.raises(ValueError):
        limit_rows(df, 0)


def test_select_sorts_by_columns_not_projected(users):
    found = select_rows(users, "name", [("age", "IS NOT NULL")], sort=[("age", "DESC")], limit=1)
    assert tuples(found) == [("carol",)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def brute(rows, items, match, sort_key, limit):
    found = []
    for ordinal, *params in items:
        hits = sorted((r for r in rows if match(r, params)), key=sort_key)[:limit]
        found += [(ordinal, r[0]) for r in hits]
    return sorted(found)


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    rows = [
        # a third of all rows share one group
        (i, "hot" if i % 3 == 0 else f"g{rng.randrange(20)}", rng.choice([None, *range(40)]))
        for i in range(3000)
    ]
    return rows, spark.createDataFrame(rows, "id long, grp string, score int").cache()


@pytest.mark.parametrize("slice_", [None, 3])
@pytest.mark.parametrize("direction", ["ASC", "DESC"])
def test_select_per_item(spark, table, slice_, direction):
    rows, df = table
    items = [(n, "hot" if n < 40 else f"g{n % 25}", n % 4 * 5) for n in range(120)]
    items_df = spark.createDataFrame(items, "item_ordinal long, g string, least int")
    found = select_per_item(
        df, items_df, [("grp", "=", "g"), ("score", ">=", "least")],
        [("score", direction)], "id", "id", limit=4, first_slice=slice_,
    )
    sign = 1 if direction == "ASC" else -1
    expected = brute(
        rows, items, lambda r, p: r[1] == p[0] and r[2] is not None and r[2] >= p[1],
        lambda r: (sign * r[2], r[0]), 4,
    )
    assert sorted(tuples(found)) == expected


@pytest.mark.parametrize("direction", ["ASC", "DESC"])
def test_select_per_item_null_sort_keys(spark, table, direction):
    rows, df = table
    items = [(n, f"g{n}" if n else "hot") for n in range(5)]
    items_df = spark.createDataFrame(items, "item_ordinal long, g string")
    found = select_per_item(
        df, items_df, [("grp", "=", "g")], [("score", direction)], "id", "id", limit=30,
        first_slice=2,
    )
    big = 1000
    sign = 1 if direction == "ASC" else -1
    expected = brute(
        rows, items, lambda r, p: r[1] == p[0],
        lambda r: (sign * (big if r[2] is None else r[2]), r[0]), 30,
    )
    assert sorted(tuples(found)) == expected


@pytest.mark.parametrize("combine", ["AND", "OR"])
def test_select_per_item_grid(spark, table, combine, monkeypatch):
    """Past the broadcast bound, without an equality key."""
    import nearspark.operators.select as module

    monkeypatch.setattr(module, "small_row_count", lambda df: None)
    monkeypatch.setattr(module, "MAX_BROADCAST_ROWS", 7)
    rows, df = table
    items = [(n, n * 2, f"g{n % 3}%" if n % 2 else None) for n in range(20)]
    items_df = spark.createDataFrame(items, "item_ordinal long, above int, pattern string")
    found = select_per_item(
        df, items_df, [("score", ">", "above"), ("grp", "LIKE", "pattern")],
        [("score", "ASC")], "id", "id", combine, limit=3, salts=4, first_slice=5,
    )

    def match(r, p):
        over = r[2] is not None and r[2] > p[0]
        like = p[1] is not None and r[1].startswith(p[1][:-1])
        return over and like if combine == "AND" else over or like

    expected = brute(
        rows, items, match, lambda r: (1000 if r[2] is None else r[2], r[0]), 3
    )
    assert sorted(tuples(found)) == expected


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("direction", ["ASC", "DESC"])
def test_select_per_item_band(spark, monkeypatch, small, direction):
    """Intervals meet rows by quantile buckets: no row is compared with every item."""
    import nearspark.operators.select as module

    if not small:
        monkeypatch.setattr(module, "small_row_count", lambda df: None)
    nan, inf = float("nan"), float("inf")
    special = {3: nan, 4: None, 5: inf, 6: -inf, 7: 0.0}
    rows = [(k, special.get(k, 5.0 if k % 3 == 0 else float(k % 37))) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, v double").repartition(3)
    items = [(n, lo, hi) for n, (lo, hi) in enumerate(
        [(1.0, 9.5), (5.0, 5.0), (30.0, 2.0), (None, 3.0), (36.0, inf), (-inf, 1.0), (nan, nan), (4.0, nan), (5.0, 6.0)] * 3
    )]
    items_df = spark.createDataFrame(items, "item_ordinal long, lo double, hi double")
    where = [("v", ">=", "lo"), ("v", "<=", "hi")]
    found = select_per_item(df, items_df, where, [("v", direction)], "id", "id", limit=6, first_slice=4)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()

    def key(v):  # NaN is the greatest
        return (1, 0.0) if math.isnan(v) else (0, v)

    expected = []
    for n, lo, hi in items:
        mine = [r for r in rows if r[1] is not None and lo is not None and hi is not None and key(lo) <= key(r[1]) <= key(hi)]
        mine.sort(key=lambda r: r[0])
        mine.sort(key=lambda r: key(r[1]), reverse=direction == "DESC")
        expected += [(n, r[0]) for r in mine[:6]]
    assert sorted(tuples(found)) == sorted(expected)
    every = select_per_item(df, items_df, where[:1], [], "id", "id", return_all=True)
    assert every.count() == sum(key(lo) <= key(r[1]) for _, lo, _ in items if lo is not None for r in rows if r[1] is not None)


def test_select_per_item_return_all(spark, table):
    rows, df = table
    items_df = spark.createDataFrame([(0, "hot"), (1, "none"), (2, "hot")], "item_ordinal long, g string")
    found = select_per_item(df, items_df, [("grp", "=", "g")], [], "id", "id", return_all=True)
    hot = [r[0] for r in rows if r[1] == "hot"]
    assert sorted(tuples(found)) == [(0, i) for i in hot] + [(2, i) for i in hot]


def test_select_per_item_needs_a_parameter(spark, table):
    items = spark.createDataFrame([(0, "x")], "item_ordinal long, g string")
    with pytest.raises(ValueError):
        select_per_item(table[1], items, [("grp", "IS NULL", "")], [], "id")
