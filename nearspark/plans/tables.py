"""Scans, projections, filters, sorts, limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.predicates import filter_rows
from ..operators.select import (
    count_rows, limit_rows, project_columns, select_per_item, select_rows, sort_rows,
)
from ..sources.staging import new_path
from ..sources.tables import read_items, read_markdown, write_markdown
from .registry import Tables, query

#: Files of a folder of Markdown files.
FOLDER_FILES = 1000

# Orders with NULLs: 5-LOW has no priority, status P no price.
ORDERS_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
           nullif(o_orderpriority, '5-LOW') AS priority,
           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price
    FROM orders"""


def sparse_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )


@query("scan_table", "SELECT * FROM lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem


@query("count_rows", "SELECT count(*) AS count FROM lineitem")
def _(t: Tables) -> DataFrame:
    return count_rows(t.lineitem)


@query("read_items", "SELECT event_id, event_type, value, props FROM events")
def _(t: Tables) -> DataFrame:
    path = new_path(t.spark, "items")
    t.events.select("event_id", "event_type", "value", "props").write.json(path)
    return read_items(t.spark, path, "event_id long, event_type string, value double, props string")


@query("read_markdown", """
    SELECT doc_id, text || chr(10) AS text, length(text) + 1 AS n FROM documents""")
def _(t: Tables) -> DataFrame:
    # one file per document; the id stands in the first line. Each folder is written by one task, so the tasks grow
    # with the documents
    path = new_path(t.spark, "markdown")
    folders = max(1, -(-t.documents.count() // FOLDER_FILES))
    lines = t.documents.select(
        F.concat_ws("\n", F.col("doc_id").cast("string"), "text").alias("value"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(folders)).alias("folder"),
    )
    write_markdown(lines.select("folder", "value"), path, folders)
    files = read_markdown(t.spark, path)
    doc_id = F.substring_index("text", "\n", 1)
    text = files.select(doc_id.cast("long").alias("doc_id"), F.expr("substr(text, length(substring_index(text, '\n', 1)) + 2)").alias("text"))
    return text.select("doc_id", "text", F.length("text").cast("long").alias("n"))


@query("project_columns", "SELECT l_shipdate, l_orderkey, l_linenumber FROM lineitem")
def _(t: Tables) -> DataFrame:
    return project_columns(t.lineitem, "l_shipdate, l_orderkey,l_linenumber")


def _filter(name: str, clauses: list, where: str, combine: str = "AND") -> None:
    @query(name, f"SELECT * FROM ({ORDERS_SQL}) WHERE {where}")
    def _(t: Tables) -> DataFrame:
        return filter_rows(sparse_orders(t), clauses, combine)


_filter("filter_eq", [("priority", "=", "2-HIGH")], "priority = '2-HIGH'")
_filter("filter_ne", [("priority", "!=", "2-HIGH")], "priority <> '2-HIGH'")
_filter("filter_like", [("priority", "LIKE", "_-%I%")], r"priority LIKE '_-%I%' ESCAPE '\'")
_filter("filter_not_like", [("priority", "NOT LIKE", "%IUM")],
        r"priority NOT LIKE '%IUM' ESCAPE '\'")
_filter("filter_gt", [("price", ">", "250000.5")], "price > 250000.5")
_filter("filter_lt", [("price", "<", "1e5")], "price < 100000")
_filter("filter_ge", [("o_orderdate", ">=", "1998-06-01")],
        "o_orderdate >= TIMESTAMP '1998-06-01'")
_filter("filter_le", [("o_custkey", "<=", "0700")], "o_custkey <= 700")
_filter("filter_is_null", [("price", "IS NULL", "ignored")], "price IS NULL")
_filter("filter_is_not_null", [("priority", "IS NOT NULL")], "priority IS NOT NULL")
_ALL = [("price", ">", 1000), ("priority", "LIKE", "1%"), ("o_orderstatus", "equal", "F")]
_filter("filter_all", _ALL, r"price > 1000 AND priority LIKE '1%' AND o_orderstatus = 'F'")
_filter("filter_any", _ALL, r"price > 1000 OR priority LIKE '1%' OR o_orderstatus = 'F'", "OR")


@query("sort_rows", f"SELECT * FROM ({ORDERS_SQL}) ORDER BY price DESC NULLS FIRST, o_orderkey")
def _(t: Tables) -> DataFrame:
    return sort_rows(sparse_orders(t), [("price", "DESC"), ("o_orderkey", "ASC")])


@query("limit_rows", f"""
    SELECT * FROM ({ORDERS_SQL})
    ORDER BY priority ASC NULLS LAST, price DESC NULLS FIRST, o_orderkey LIMIT 50""")
def _(t: Tables) -> DataFrame:
    rules = [("priority", "ASC"), ("price", "DESC"), "o_orderkey"]
    return limit_rows(sort_rows(sparse_orders(t), rules))


@query("select_rows", """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_quantity >= 10 AND l_returnflag <> 'N' AND l_shipdate < TIMESTAMP '2000-01-01'
    ORDER BY l_extendedprice DESC NULLS FIRST, l_orderkey, l_linenumber, l_partkey LIMIT 100""")
def _(t: Tables) -> DataFrame:
    return select_rows(
        t.lineitem,
        ["l_orderkey", "l_linenumber", "l_extendedprice"],
        [("l_quantity", ">=", "10"), ("l_returnflag", "!=", "N"), ("l_shipdate", "<", "2000-01-01")],
        sort=[("l_extendedprice", "DESC"), "l_orderkey", "l_linenumber", "l_partkey"],
        limit=100,
    )


@query("select_per_item", """
    SELECT n_nationkey AS item_ordinal, c_custkey, c_acctbal FROM (
        SELECT *, row_number() OVER (
            PARTITION BY n_nationkey ORDER BY c_acctbal DESC NULLS FIRST, c_custkey) AS place
        FROM nation JOIN customer
          ON c_nationkey = n_nationkey AND c_acctbal >= 1000.0 * n_regionkey)
    WHERE place <= 5""")
def _(t: Tables) -> DataFrame:
    items = t.nation.select(
        F.col("n_nationkey").alias("item_ordinal"), "n_nationkey",
        (F.col("n_regionkey") * F.lit(1000.0)).alias("least"),
    )
    return select_per_item(
        t.customer, items,
        [("c_nationkey", "=", "n_nationkey"), ("c_acctbal", ">=", "least")],
        [("c_acctbal", "DESC")], "c_custkey", ["c_custkey", "c_acctbal"], limit=5,
    )


@query("select_per_item_range", """
    SELECT n_nationkey AS item_ordinal, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (
            PARTITION BY n_nationkey ORDER BY o_totalprice NULLS LAST, o_orderkey) AS place
        FROM nation JOIN orders ON o_totalprice > 20000.0 * n_nationkey)
    WHERE place <= 4""")
def _(t: Tables) -> DataFrame:
    items = t.nation.select(
        F.col("n_nationkey").alias("item_ordinal"),
        (F.col("n_nationkey") * F.lit(20000.0)).alias("above"),
    )
    return select_per_item(
        t.orders, items, [("o_totalprice", ">", "above")], [("o_totalprice", "ASC")],
        "o_orderkey", ["o_orderkey", "o_totalprice"], limit=4,
    )
