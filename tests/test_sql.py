import pytest
from row_helpers import tuples

from nearspark.operators.sqlexec import bind, execute_sql, execute_sql_each, parse_parameters, with_metadata_map


@pytest.mark.parametrize("raw, values", [
    ("", []), (None, []), ("  ", []), ("10,electronics", ["10", "electronics"]),
    ("a,,b", ["a", "b"]), (["x", 1], ["x", 1]), ('["x",1]', ["x", 1]),
    ("[bad", ["[bad"]), ("[bad, x", ["[bad", "x"]), (5, [5]), (True, [True]), ({"a": 1}, [{"a": 1}]),
])
def test_parse_parameters(raw, values):
    assert parse_parameters(raw) == values


def test_bind_skips_quotes_and_comments():
    sql = """SELECT '$1', "a$1", `b$2`, $2, $10 -- $1
    /* $1 */ WHERE x = $1 LIMIT $3"""
    text, args = bind(sql, ["a", "b", "7", *"cdefghi"])
    assert args == {"p1": "a", "p2": "b", "p10": "i", "n3": 7}
    assert text == """SELECT '$1', "a$1", `b$2`, :p2, :p10 -- $1
    /* $1 */ WHERE x = :p1 LIMIT :n3"""
    with pytest.raises(ValueError, match=r"no parameter \$2"):
        bind("SELECT $2", [1])


def test_execute(spark, users):
    sql = 'SELECT "name" FROM users WHERE age > $1 OR (age > $1 AND name = $2) ORDER BY 1 LIMIT $3'
    assert tuples(execute_sql(spark, sql, "25,bob,1", {"users": users})) == [("alice",)]
    assert tuples(execute_sql(spark, "SELECT 'it''s', 'a\\b', 'x' LIKE 'x'")) == [
        ("it's", "a\\b", True)
    ]
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "false"


def test_injection_is_data(spark, users):
    users.createOrReplaceTempView("users")
    found = execute_sql(spark, "SELECT * FROM users WHERE name = $1", ["x' OR '1'='1"])
    assert found.count() == 0 and found.columns == ["id", "name", "age"]


def test_command_gives_success(spark):
    assert tuples(execute_sql(spark, "CREATE DATABASE IF NOT EXISTS scratch")) == [(True,)]
    assert tuples(execute_sql(spark, "DROP DATABASE IF EXISTS scratch")) == [(True,)]


def test_settings_survive_an_error(spark):
    before = spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers")
    with pytest.raises(Exception):
        execute_sql(spark, "SELECT FROM WHERE")
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == before


def test_metadata_sql(spark, vectors):
    sql = "SELECT content FROM docs WHERE metadata_map['source'] = $1"
    found = execute_sql(spark, sql, ["demo"], {"docs": with_metadata_map(vectors)})
    assert tuples(found) == [("Vector search",)]
    count = execute_sql(spark, "SELECT COUNT(*) AS count FROM docs")
    assert count.first()["count"] == 4


def test_sql_for_each_item(spark):
    rows = spark.createDataFrame([(k, k % 4, f"t{k}") for k in range(12)], "id long, grp long, name string")
    items = spark.createDataFrame([(5, 1, "7"), (6, 2, "0"), (7, 9, "0")], "item_ordinal long, g long, least string")
    views = {"facts": rows}
    found = execute_sql_each(spark, "SELECT id, '$1' AS mark FROM facts WHERE grp = $1 AND id >= $2;", items, ["g", "least"], views)
    assert sorted(tuples(found)) == [(5, 9, "$1"), (6, 2, "$1"), (6, 6, "$1"), (6, 10, "$1")]
    top = execute_sql_each(spark, "SELECT id FROM facts WHERE grp = $1 ORDER BY id DESC LIMIT 1", items, ["g"], views)
    assert sorted(tuples(top)) == [(5, 9), (6, 10)]
    with pytest.raises(ValueError, match="LIMIT"):
        execute_sql_each(spark, "SELECT id FROM facts LIMIT $1", items, ["g"], views)
    with pytest.raises(ValueError, match="no parameter"):
        execute_sql_each(spark, "SELECT $2 FROM facts", items, ["g"], views)


def test_callers_views_are_put_back(spark):
    spark.range(3).createOrReplaceTempView("mine")
    assert execute_sql(spark, "SELECT count(*) AS n FROM mine", None, {"mine": spark.range(7)}).first().n == 7
    assert spark.table("mine").count() == 3
    spark.catalog.dropTempView("mine")


def test_views_left_behind_are_not_the_callers(spark, vectors):
    execute_sql(spark, "SELECT count(*) FROM left_docs", None, {"left_docs": spark.range(200)})
    execute_sql(spark, "SELECT count(*) FROM left_docs", None, {"left_docs": vectors})
    assert execute_sql(spark, "SELECT count(*) AS n FROM left_docs").first().n == 4
    spark.catalog.dropTempView("left_docs")


def test_aggregate_for_each_item_joins_on_its_key(spark):
    """An equality next to a range, below an aggregate: no parameter meets rows of another key."""
    rows = spark.createDataFrame([(k, k % 4, f"t{k}") for k in range(12)], "id long, grp long, name string")
    items = spark.createDataFrame(
        [(5, 1, 3), (6, 2, 0), (7, 9, 0), (8, None, 0), (9, 1, 3), (10, 1, None)], "item_ordinal long, g long, least long")
    sql = "SELECT count(*) AS n, min(name) AS first FROM {} WHERE grp = $1 AND id > $2"
    found = execute_sql_each(spark, sql.format("facts"), items, ["g", "least"], {"facts": rows})
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.columns == ["item_ordinal", "n", "first"]
    assert spark.table("facts").columns == ["id", "grp", "name"]
    expected = [(5, 2, "t5"), (6, 3, "t10"), (7, 0, None), (8, 0, None), (9, 2, "t5"), (10, 0, None)]
    assert sorted(tuples(found)) == expected
    derived = "(SELECT * FROM facts) d"  # a star that would show the constant: as before
    assert sorted(tuples(execute_sql_each(spark, sql.format(derived), items, ["g", "least"], {"facts": rows}))) == expected


@pytest.mark.parametrize("cells", [4, 200_000])
@pytest.mark.parametrize("operator, key, flipped", [(">", "grp", False), ("<=", "grp", True), (">=", "'' || grp", False), ("<", None, False)])
def test_aggregates_for_each_item_make_no_pairs(spark, monkeypatch, cells, operator, key, flipped):
    """Repeated and missing keys and values, infinities and NaN: as one query per item finds them, without a join of pairs."""
    from nearspark.operators import summaries

    monkeypatch.setattr(summaries, "CELL_VALUES", cells)
    number = [None, 0.0, -0.0, 1.5, 2.0, 2.0, 7.25, float("inf"), float("-inf"), float("nan"), 40.0, -3.0]
    rows = [(k % 3 if k % 7 else None, number[k % 12], f"t{k % 20:02}" if k % 5 else None, k * 0.5) for k in range(90)]
    facts = spark.createDataFrame(rows, "grp int, v double, name string, size double")
    given = [(k % 19, (None, 0, 1, 2, 9)[k % 5], number[k // 5 % 12]) for k in range(60)] + [(3, 1, 2.0)] * 2
    text = "''" in (key or "")
    items = spark.createDataFrame(given, f"item_ordinal long, g {'string' if text else 'long'}, least double") if not text else (
        spark.createDataFrame([(o, g if g is None else str(g), x) for o, g, x in given], "item_ordinal long, g string, least double"))
    order = lambda x: (x != x, 0.0 if x != x else x)  # noqa: E731, NaN is the greatest
    holds = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}[operator]
    expected = []
    for o, g, x in given:
        seen = [(n, s) for k, v, n, s in rows if None not in (x, v) and holds(order(v), order(x)) and s != 7
                and (key is None or None not in (g, k) and k == g)]
        names = [n for n, _ in seen if n is not None]
        expected.append((o, len(seen), len(names), sum(s for _, s in seen) + 1 if seen else None, min(names, default=None), max(names, default=None)))
    mirrored = {">": "<", "<": ">", ">=": "<=", "<=": ">="}
    bound = f"$2 {mirrored[operator]} v" if flipped else f"v {operator} $2"
    sql = f"""SELECT count(*), count(name) AS named, sum(size) + 1 AS "{{size}}", min(name), MAX (name) -- $9
        FROM facts AS f WHERE {bound} AND size <> 7 {f"AND {key} = $1" if key else ""};"""
    found = execute_sql_each(spark, sql, items, ["g", "least"], {"facts": facts})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "size" in found.columns[3]
    none = lambda rows: sorted([tuple((c is not None, c) for c in r) for r in rows])
    assert none(tuples(found)) == none(expected)


def test_other_statements_for_each_item_stay_joins(spark):
    facts = spark.createDataFrame([(k, k % 4, k % 3) for k in range(12)], "id long, grp long, other int")
    items = spark.createDataFrame([(5, 1, 3)], "item_ordinal long, g long, least long")
    for sql, expected in (
        ("SELECT count(*) AS n FROM facts WHERE grp = $1 OR id > $2", (5, 9)),
        ("SELECT count(*) AS n FROM facts WHERE NOT grp = $1", (5, 9)),
        ("SELECT count(*) AS n FROM facts WHERE id BETWEEN $1 AND $2", (5, 3)),
        ("SELECT count(*) AS n FROM facts WHERE id > $1 AND id < $2 + 4", (5, 5)),
        ("SELECT count(DISTINCT other) AS n FROM facts WHERE grp = $1", (5, 3)),
        ("SELECT sum(id) AS n FROM facts WHERE grp = $1", (5, 15)),
        ("SELECT count(*) AS n FROM facts WHERE grp = $1 HAVING count(*) > 0", (5, 3)),
    ):
        assert tuples(execute_sql_each(spark, sql, items, ["g", "least"], {"facts": facts})) == [expected], sql
