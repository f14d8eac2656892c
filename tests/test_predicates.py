import re
from decimal import Decimal

import pytest
from row_helpers import tuples

from nearspark.functions.literals import number_text, parse_number, value_text
from nearspark.functions.names import (
    output_columns, parse_output_columns, quote_ident, quote_table,
)
from nearspark.operators import predicates
from nearspark.operators.predicates import (
    filter_rows, metadata_filter, parse_metadata_filter,
)


def ids(df):
    return sorted(r[0] for r in df.collect())


@pytest.mark.parametrize("clause, expected", [
    (("age", "=", "30"), [1]),
    (("age", "equal", 30), [1]),
    (("age", "!=", "30"), [3]),
    (("age", ">", "30"), [3]),
    (("age", ">=", "3e1"), [1, 3]),
    (("age", "<", "0x29"), [1]),
    (("age", "<=", 41), [1, 3]),
    (("age", "IS NULL", "anything"), [2]),
    (("age", "IS NOT NULL"), [1, 3]),
    (("name", "LIKE", "_o%"), [2]),
    (("name", "LIKE", "A%"), []),
    (("name", "NOT LIKE", "%o%"), [1]),
    ({"column": "name", "condition": "=", "value": "carol"}, [3]),
])
def test_conditions(users, clause, expected):
    assert ids(filter_rows(users, [clause])) == expected


def test_combine(users):
    clauses = [("age", ">", "35"), ("name", "=", "bob")]
    assert ids(filter_rows(users, clauses)) == []
    assert ids(filter_rows(users, clauses, "OR")) == [2, 3]
    assert ids(filter_rows(users, clauses, "or")) == []
    assert ids(filter_rows(users, [])) == [1, 2, 3]


def test_unknown_condition_and_column(users):
    with pytest.raises(ValueError, match="Unsupported condition"):
        filter_rows(users, [("age", "> 0 OR 1 =", "1")])
    with pytest.raises(ValueError, match="does not exist"):
        filter_rows(users, [("AGE", "=", "1")])


def test_bad_value_is_an_error(users):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        filter_rows(users, [("age", "=", "old")]).collect()


def test_text_column_range_takes_numbers_first(spark):
    df = spark.createDataFrame([("7",), ("007",), ("8",), ("x",)], "v string")
    assert sorted(r.v for r in filter_rows(df, [("v", ">=", "007")]).collect()) == ["7", "8", "x"]
    assert [r.v for r in filter_rows(df, [("v", "=", "007")]).collect()] == ["007"]
    assert [r.v for r in filter_rows(df, [("v", ">", " ")]).collect() if r.v == "x"] == ["x"]


def test_decimal_bound_is_not_rounded(spark):
    df = spark.createDataFrame([(Decimal("10.00"),), (Decimal("10.01"),)], "v decimal(10,2)")
    assert ids(filter_rows(df, [("v", ">", "10.005")])) == [Decimal("10.01")]
    assert ids(filter_rows(df, [("v", "<=", "10.005")])) == [Decimal("10.00")]


def test_like_escape(spark):
    df = spark.createDataFrame([("50%",), ("500",)], "v string")
    assert tuples(filter_rows(df, [("v", "LIKE", "50\\%")])) == [("50%",)]


@pytest.mark.parametrize("text, number", [
    ("007", 7), ("1e3", 1000), (" 5 ", 5), ("", None), ("  ", None), ("1_0", None),
    ("0x10", 16), ("0b11", 3), ("-0x10", None), ("Infinity", float("inf")), ("inf", None),
    (".5", 0.5), ("5.", 5), ("1e", None), ("nan", None), ("\u0663", None),
])
def test_parse_number(text, number):
    found = parse_number(text)
    assert (found is None) if number is None else float(found) == number


@pytest.mark.parametrize("number, text", [
    (7.0, "7"), (0.1, "0.1"), (1e21, "1e+21"), (1e20, "100000000000000000000"),
    (1e-7, "1e-7"), (1.5e-7, "1.5e-7"), (1e-6, "0.000001"), (-2.5, "-2.5"), (-0.0, "0"),
    (123456789.125, "123456789.125"), (float("-inf"), "-Infinity"),
])
def test_number_text(number, text):
    assert number_text(number) == text


def test_value_text():
    assert [value_text(v) for v in (True, None, 2023, 1.0, "a")] == [
        "true", "null", "2023", "1", "a"
    ]
    with pytest.raises(ValueError):
        value_text(["a"])


def test_names(spark):
    assert quote_ident("a`b") == "`a``b`"
    assert quote_table("public.t x") == "`public`.`t x`"
    assert quote_table("t.x", "public") == "`public`.`t.x`"
    with pytest.raises(ValueError, match="Identifier cannot be empty"):
        quote_ident("")
    assert parse_output_columns(" a, ,b ") == ["a", "b"]
    assert parse_output_columns(["a ", ""]) == ["a"]
    assert parse_output_columns(None) == []
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    assert df.select(*output_columns(df, "a.b")).columns == ["a.b"]
    assert df.select(*output_columns(df, "a.b,*")).columns == ["a.b", "c`d"]
    assert tuples(filter_rows(df, [("a.b", "=", "1"), ("c`d", "=", "2")])) == [(1, 2)]


def test_metadata_filter(spark):
    rows = [
        (1, '{"k":"v","year":2023,"ok":true,"a.b":"x"}'), (2, None), (3, "null"), (4, "[1]"),
        (5, '{"k":null}'), (6, "{}"), (7, '{"k":"w","k":"v"}'), (8, "not json"),
    ]
    df = spark.createDataFrame(rows, "id long, metadata string")
    assert ids(metadata_filter(df, {"k": "v"})) == [1, 7]
    assert ids(metadata_filter(df, {"year": 2023, "ok": True})) == [1]
    assert ids(metadata_filter(df, {"year": 2023.0})) == [1]
    assert ids(metadata_filter(df, {"a.b": "x"})) == [1]
    assert ids(metadata_filter(df, {"k": None})) == []
    assert ids(metadata_filter(df, {})) == ids(metadata_filter(df, None)) == list(range(1, 9))
    with pytest.raises(ValueError):
        metadata_filter(df, {"k": {"x": 1}})


def test_parse_metadata_filter():
    assert parse_metadata_filter("") is None
    assert parse_metadata_filter('{"a": 1}') == {"a": 1}
    for bad in ("{", "[1]", "5"):
        with pytest.raises(ValueError, match="Invalid metadata filter format"):
            parse_metadata_filter(bad)


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id as string) as name", "id * 2 as other").write.parquet(
        str(tmp_path / "t")
    )
    df = filter_rows(spark.read.parquet(str(tmp_path / "t")), [("id", ">", "9e1")]).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,90)" in plan and "other" not in plan


def test_side_columns_of_metadata(spark, tmp_path):
    """The same rows as from the JSON, by filters that reach the files."""
    texts = ['{"lang":"en","n":1}', '{"lang":"fr","n":1}', "null", None, "[1]", '{"lang":null}', '{"lang":"en","rare.key":"x"}',
             '{"lang":"en","lang":"de"}', "{}", "not json", '{"n":"1","lang":"en"}']
    df = spark.createDataFrame(list(enumerate(texts * 30)), "id long, metadata string")
    assert predicates.common_keys(df) == ["lang", "n", "rare.key"] and predicates.common_keys(df, 1) == ["lang"]
    rows = predicates.shred_metadata(df, ["lang", "rare.key"])
    rows.write.options(**predicates.bloom_options(rows)).parquet(str(tmp_path / "t"))
    stored = spark.read.schema(rows.schema).parquet(str(tmp_path / "t"))
    for filters in ({"lang": "en"}, {"lang": "en", "n": 1}, {"rare.key": "x", "lang": "en"}, {"n": "1"}, {"lang": "de"}, {"no": 1}):
        found = metadata_filter(stored, filters)
        assert sorted(r.id for r in found.collect()) == sorted(r.id for r in metadata_filter(df, filters).collect())
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert bool(re.search(r"PushedFilters: \[IsNotNull\(`?metadata\$(lang|rare)", plan)) == bool({"lang", "rare.key"} & set(filters))
    assert predicates.common_keys(df.limit(0)) == []
