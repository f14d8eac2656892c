"""Edits against an item-by-item reading of the same rules."""

import random

import pytest
from row_helpers import tuples
from pyspark.sql import functions as F

from nearspark.operators import edits
from nearspark.operators.edits import ORDINAL, PRESENT

FIELDS = ("name", "age")


@pytest.fixture(params=["broadcast", "shuffle"])
def batch(request, monkeypatch, items_of_all_kinds):
    """The items, once as a measured-small batch and once as a large one."""
    if request.param == "shuffle":
        monkeypatch.setattr(edits, "small_row_count", lambda df: None)
    return items_of_all_kinds


@pytest.fixture(scope="module")
def items_of_all_kinds(spark):
    """1,500 items; a third share one key, some fields are absent, some NULL."""
    rng = random.Random(5)
    items = []
    for n in range(1500):
        key = 7 if n % 3 == 0 else rng.randrange(200)
        item = {"id": None if n % 50 == 1 else key}
        if rng.random() < 0.6:
            item["name"] = rng.choice([None, f"n{n}"])
        if rng.random() < 0.6 or "name" not in item:
            item["age"] = rng.choice([None, n])
        items.append((n, item))
    rng.shuffle(items)
    df = spark.createDataFrame(
        [(n, list(i), i.get("id"), i.get("name"), i.get("age")) for n, i in items],
        f"{ORDINAL} long, {PRESENT} array<string>, id long, name string, age int",
    ).repartition(6)
    return sorted(items), df


@pytest.fixture(scope="module")
def table(spark):
    rows = [(k, f"old{k}", k) for k in range(0, 150)]
    return rows, spark.createDataFrame(rows, "id long, name string, age int").repartition(3)


def step(rows, items, insert):
    """Apply items one by one; the rows each one touched."""
    state = {k: {"name": n, "age": a} for k, n, a in rows}
    touched = []
    for ordinal, item in items:
        key = item["id"]
        if key is None or (key not in state and not insert):
            continue
        row = state.setdefault(key, {"name": None, "age": 99})
        row.update({c: item[c] for c in FIELDS if c in item})
        touched.append((ordinal, key, row["name"], row["age"]))
    return sorted((k, r["name"], r["age"]) for k, r in state.items()), touched


def order(rows):
    return sorted(rows, key=repr)


def test_update(batch, table):
    rows, target = table
    items, df = batch
    state, touched = step(rows, items, insert=False)
    assert order(tuples(edits.update_rows(target, df, "id"))) == order(state)
    assert order(tuples(edits.returning_updated(target, df, "id", "*"))) == order(touched)
    hits = {t[0] for t in touched}
    affected = {r[ORDINAL]: r.affectedRows for r in
                edits.affected_by_update(target, df, "id").collect()}
    assert affected == {n: int(n in hits) for n, _ in items}


def test_upsert(batch, table):
    rows, target = table
    items, df = batch
    good = df.filter("id is not null")
    state, touched = step(rows, items, insert=True)
    defaults = {"age": "99"}
    assert order(tuples(edits.upsert_rows(target, good, "id", defaults))) == order(state)
    found = edits.returning_upserted(target, good, "id", ["id", "name", "age"], defaults)
    assert order(tuples(found)) == order(touched)


def test_history_is_the_same_for_any_run_length(batch, table):
    _, df = batch
    whole = order(tuples(edits.running_items(df, "id")))
    assert order(tuples(edits.running_items(df, "id", chunk=7))) == whole


def test_skip_conflicts(batch, table):
    rows, target = table
    items, df = batch
    have, expected, inserted = {r[0] for r in rows}, list(rows), set()
    for ordinal, item in items:
        if item["id"] is not None and item["id"] in have:
            continue
        have.add(item["id"])
        inserted.add(ordinal)
        expected.append((item["id"], item.get("name"), item.get("age", 99) if "age" in item else 99))
    found = edits.insert_skip_conflicts(target, df, "id", defaults={"age": 99})
    assert order(tuples(found)) == order(expected)
    affected = edits.affected_by_insert(target, df, "id", defaults={"age": 99}).collect()
    assert {r[ORDINAL] for r in affected if r.affectedRows} == inserted
    assert len(affected) == len(items)


def test_unique_violations(batch, table):
    rows, target = table
    items, df = batch
    counts = {}
    for _, item in items:
        if item["id"] is not None:
            counts[item["id"]] = counts.get(item["id"], 0) + 1
    keys = {r[0] for r in rows}
    expected = [(k, n, int(k in keys)) for k, n in counts.items() if n > 1 or k in keys]
    assert order(tuples(edits.unique_violations(target, df, "id"))) == order(expected)


def test_composite_key(spark):
    schema = "a int, b string"
    target = spark.createDataFrame([(1, "x")], schema)
    items = spark.createDataFrame(
        [(0, 1, "x"), (1, 1, "y"), (2, 1, "y"), (3, 1, None), (4, 1, None)],
        f"{ORDINAL} long, {schema}",
    )
    found = edits.insert_skip_conflicts(target, items, ["a", "b"])
    assert order(tuples(found)) == order([(1, "x"), (1, "y"), (1, None), (1, None)])


def test_update_hits_every_matching_row(spark):
    target = spark.createDataFrame([(i, i % 2) for i in range(6)], "id long, grp int")
    items = spark.createDataFrame([(0, 1, 50)], f"{ORDINAL} long, grp int, id long")
    assert order(tuples(edits.update_rows(target, items, "grp"))) == order(
        [(0, 0), (2, 0), (4, 0), (50, 1), (50, 1), (50, 1)]
    )
    assert edits.affected_by_update(target, items, "grp").first().affectedRows == 3


def test_absent_and_null_from_json(spark, users):
    rows = spark.createDataFrame(
        [(0, '{"name":"alice"}'), (1, '{"name":"bob","age":null}'), (2, '{"age":1}')],
        "n long, json string",
    )
    items = edits.items_from_json(rows, "json", users.select("name", "age").schema, "n")
    checked = edits.item_errors(users, items, "update", "name")
    good, bad = edits.split_errors(checked)
    assert tuples(bad.orderBy(ORDINAL)) == [
        (0, edits.NOTHING_TO_UPDATE),
        (2, "Column to match on 'name' not found in input item"),
    ]
    assert order(tuples(edits.update_rows(users, good, "name"))) == order(
        [(1, "alice", 30), (2, "bob", None), (3, "carol", 41)]
    )


def test_upsert_checks(spark, users):
    with pytest.raises(ValueError, match="must have a value"):
        edits.upsert_rows(users, spark.createDataFrame([(0, 3)], f"{ORDINAL} long, age int"), "name")
    with pytest.raises(ValueError, match="Add at least one value besides"):
        edits.upsert_rows(
            users, spark.createDataFrame([(0, "a")], f"{ORDINAL} long, name string"), "name"
        )
    items = spark.createDataFrame([(0, None, 1), (1, "x", 2)], f"{ORDINAL} long, name string, age int")
    _, bad = edits.split_errors(edits.item_errors(users, items, "upsert", "name"))
    assert tuples(bad) == [(0, "Unique column 'name' must have a value")]


def test_type_errors_and_not_null(spark, users):
    items = spark.createDataFrame(
        [(0, "1", "x"), (1, "one", "y"), (2, None, None)], f"{ORDINAL} long, age string, name string"
    )
    checked = edits.item_errors(users, items, "insert", not_null=["name"])
    assert tuples(edits.split_errors(checked)[1].orderBy(ORDINAL)) == [
        (1, 'invalid input syntax for type int: "one"'),
        (2, 'null value in column "name" violates not-null constraint'),
    ]
    with pytest.raises(Exception, match="violates not-null constraint"):
        edits.insert_rows(users, items.filter(F.col(ORDINAL) == 2), not_null=["name"]).collect()
    with pytest.raises(ValueError, match="does not exist"):
        edits.insert_rows(users, items.withColumnRenamed("age", "years"))


def test_manual_forms(users):
    values = {"name": "", " age ": "5", "": "x"}
    assert (None, "", 5) in tuples(edits.insert_values(users, values))
    updated = edits.update_values(users, "name", "bob", {"age": "7", "name": "ignored"})
    assert (2, "bob", 7) in tuples(updated)
    with pytest.raises(ValueError, match="No columns to update"):
        edits.update_values(users, "name", "bob", {})
    assert (None, "dave", 1) in tuples(edits.upsert_values(users, "name", "dave", {"age": "1"}))


def test_insert_defaults(spark, users):
    items = spark.createDataFrame([(0,), (1,)], f"{ORDINAL} long")
    found = tuples(edits.insert_defaults(users, items, defaults={"name": "anon"}))
    assert found[3:] == [(None, "anon", None)] * 2


def test_delete_keeps_rows_with_null_condition(users):
    assert order(tuples(edits.delete_rows(users, [("age", ">", "30")]))) == order(
        [(1, "alice", 30), (2, "bob", None)]
    )
    assert edits.delete_rows(users).count() == 0
    assert edits.affected_by_delete(users, [("age", ">", "30")]).first().affectedRows == 1
    assert edits.affected_by_delete(users).first().affectedRows == 3
    assert edits.truncate_rows(users).columns == users.columns


def test_returning_columns(spark, users):
    items = spark.createDataFrame([(0, "bob", 8)], f"{ORDINAL} long, name string, age int")
    assert tuples(edits.returning_updated(users, items, "name", "age,id")) == [(0, 8, 2)]
    assert edits.returning_updated(users, items, "name", "").count() == 0


def test_update_plan_does_not_shuffle_the_table_for_few_items(spark, tmp_path):
    spark.range(1000).selectExpr("id", "id as v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    items = spark.createDataFrame([(0, 5, 1)], f"{ORDINAL} long, id long, v long")
    plan = edits.update_rows(target, items, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("path", ["broadcast", "shuffle"])
def test_insert_with_several_unique_keys(spark, monkeypatch, seed, path):
    """Items one by one: each must be new in all keys, and refused ones free their other keys."""
    if path == "shuffle":
        monkeypatch.setattr(edits, "small_row_count", lambda df: None)
    rng = random.Random(seed)
    rows = [(k, f"old{k % 3}", k) for k in range(5)]
    table = spark.createDataFrame(rows, "id long, name string, age int")
    items = [(n, rng.choice([None, *range(60)]), rng.choice([None, "old1", *(f"n{k}" for k in range(40))]), rng.randrange(9)) for n in range(150)]
    items += [(n, n, f"c{n // 2}", n % 2) for n in range(200, 240)] + [(n, (n + 1) // 2 * 2, f"c{n}", 1) for n in range(240, 260)]
    frame = spark.createDataFrame(items, f"{ORDINAL} long, id long, name string, age int").repartition(4)
    ids, names, accepted = {r[0] for r in rows}, {(r[1], r[2]) for r in rows}, []
    for n, key, name, age in items:
        pair = (name, age)
        if (key is None or key not in ids) and (name is None or pair not in names):
            accepted.append((n, key, name, age))
            ids.add(key)
            names.add(pair)
    got = edits.accepted_rows(table, frame, ["id", ["name", "age"]])
    assert sorted(tuples(got)) == accepted
    assert edits.insert_skip_conflicts(table, frame, [["id"], ["name", "age"]]).count() == len(rows) + len(accepted)


def test_chain_of_items(spark):
    """Each item shares a key with the one before it, so every other one gets in."""
    items = spark.createDataFrame([(n, n // 2, (n + 1) // 2) for n in range(11)], f"{ORDINAL} long, a long, b long")
    table = spark.createDataFrame([], "a long, b long")
    assert sorted(r[0] for r in tuples(edits.accepted_rows(table, items, [["a"], ["b"]]))) == [0, 2, 4, 6, 8, 10]


DELETES = [
    ([("grp", "=", "g"), ("v", ">", "x")], "AND", lambda r, i: i[1] is not None and r[1] == i[1] and _over(r[2], i[2])),
    ([("v", ">", "x"), ("v", "<=", "y")], "AND", lambda r, i: _over(r[2], i[2]) and i[3] is not None and r[2] <= i[3]),
    ([("grp", "=", "g"), ("v", ">", "y")], "OR", lambda r, i: (i[1] is not None and r[1] == i[1]) or _over(r[2], i[3])),
    ([("grp", "LIKE", "g"), ("v", "IS NOT NULL", None)], "AND", lambda r, i: i[1] is not None and r[1] == i[1] and r[2] is not None),
    ([("v", "IS NULL", None), ("grp", "!=", "g")], "OR", lambda r, i: r[2] is None or (i[1] is not None and r[1] not in (None, i[1]))),
]


def _over(value, bound):
    return value is not None and bound is not None and value > bound


@pytest.mark.parametrize("where,combine,match", DELETES)
@pytest.mark.parametrize("path", ["broadcast", "shuffle"])
def test_delete_each(spark, monkeypatch, where, combine, match, path):
    import nearspark.operators.select as module

    if path == "shuffle":
        monkeypatch.setattr(module, "small_row_count", lambda df: None)
    rng = random.Random(7)
    rows = [(k % 90, rng.choice([None, "a", "b", "c"]), rng.choice([None, *range(30)])) for k in range(100)]
    items = [(n, rng.choice([None, "a", "c"]), rng.choice([None, 5, 11, 25]), rng.choice([None, 7, 13, 27])) for n in range(12)]
    table = spark.createDataFrame(rows, "id long, grp string, v int").repartition(3)
    frame = spark.createDataFrame(items, f"{ORDINAL} long, g string, x int, y int")
    kept, counts = [], dict.fromkeys(range(12), 0)
    for row in rows:
        first = next((i[0] for i in items if match(row, i)), None)
        if first is None:
            kept.append(row)
        else:
            counts[first] += 1
    assert sorted(tuples(edits.delete_each(table, frame, where, combine)), key=repr) == sorted(kept, key=repr)
    affected = {r[0]: (r[1], r[2]) for r in tuples(edits.affected_by_delete_each(table, frame, where, combine))}
    assert affected == {n: (True, c) for n, c in counts.items()}
    none = frame.limit(0)
    assert edits.delete_each(table, none, where, combine).count() == 100
    assert edits.affected_by_delete_each(table, none, where, combine).count() == 0


def test_delete_each_needs_a_condition(spark, table):
    with pytest.raises(ValueError):
        edits.delete_each(table[1], spark.range(1).withColumnRenamed("id", ORDINAL), [])


def test_constraint_errors(spark):
    table = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, None, 4), (None, "z", 5)], "id long, name string, age int")
    items = spark.createDataFrame([(0, 1, "c", None), (1, 2, "x", 7), (2, 9, "x", 8)], f"{ORDINAL} long, id long, name string, age int")
    changed, others = edits.changed_rows(table, items, "update", "id")
    found = edits.constraint_errors(changed, others, [["name"]], ["age"], ["name", "age"])
    assert sorted(tuples(found), key=repr) == [("not null: age", None, 1), ("unique: name", '{"name":"c"}', 2)]
    changed, others = edits.changed_rows(table, items, "upsert", "id")
    found = edits.constraint_errors(changed, others, ["name", "id"], ["age"])
    assert sorted(tuples(found), key=repr) == [("not null: age", None, 1)]
    found = edits.constraint_errors(changed, others, [["name"], ["id"]])
    assert sorted(tuples(found), key=repr) == [("unique: name", '{"name":"c"}', 2), ("unique: name", '{"name":"x"}', 2)]
    assert edits.constraint_errors(changed, others).count() == 0


@pytest.mark.parametrize("where,combine,match", DELETES)
@pytest.mark.parametrize("low", [None, 6, 40])
def test_deletes_by_many_items_are_cut_into_cells(spark, monkeypatch, where, combine, match, low):
    """Cells and their tree give each row its first item, with NULL, equal bounds and several keys."""
    import nearspark.operators.select as module

    monkeypatch.setattr(module, "CELL_ITEMS", 3)
    rng = random.Random(low)
    rows = [(k, rng.choice([None, "a", "b", "c"]), rng.choice([None, *range(60)])) for k in range(150)]
    items = [(n, rng.choice([None, "a", "c"]), rng.choice([None, low, *range(60)]), rng.choice([None, *range(60)])) for n in range(120)]
    rng.shuffle(items)
    table = spark.createDataFrame(rows, "id long, grp string, v int").repartition(3)
    frame = spark.createDataFrame(items, f"{ORDINAL} long, g string, x int, y int")
    counts = dict.fromkeys(range(120), 0)
    for row in rows:
        hits = [i[0] for i in items if match(row, i)]
        if hits:
            counts[min(hits)] += 1
    affected = {r[0]: r[2] for r in tuples(edits.affected_by_delete_each(table, frame, where, combine))}
    assert affected == counts


def test_many_items_meet_few_rows(spark):
    """Rows meet items with a bound in their cell, not all that match."""
    from nearspark.operators.select import match_first

    table = spark.range(2000).select(F.col("id"), (F.col("id") % 500).cast("double").alias("v"))
    items = spark.range(1000).select(F.col("id").alias(ORDINAL), (F.col("id") % 500).cast("double").alias("x"))
    assert match_first(table, items, [("v", ">", "x")], ORDINAL).count() < 2000 * 100


def test_not_a_number_bounds_rows_too(spark, monkeypatch):
    import nearspark.operators.select as module

    monkeypatch.setattr(module, "CELL_ITEMS", 2)
    nan = float("nan")
    table = spark.createDataFrame([(k, v) for k, v in enumerate([1.0, 5.0, nan, None, 9.0])], "id long, v double")
    items = spark.createDataFrame([(0, nan), (1, 8.0), (2, None), (3, 4.0), (4, 20.0), (5, 2.0)], f"{ORDINAL} long, x double")
    found = edits.affected_by_delete_each(table, items, [("v", ">=", "x")])
    assert {r[0]: r[2] for r in tuples(found)} == {0: 1, 1: 1, 2: 0, 3: 1, 4: 0, 5: 0}
