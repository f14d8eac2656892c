"""SQL passthrough and the kinds of statements users send through it."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.edits import ORDINAL
from ..operators.sqlexec import execute_sql, execute_sql_each, with_metadata_map
from .registry import Tables, query
from .vectors import RAG_SQL, rag_docs


def _statement(name: str, sql: str, views: tuple[str, ...], params: Any = None,
               literals: Mapping[str, str] | None = None) -> None:
    oracle = sql
    for mark, text in (literals or {}).items():
        oracle = oracle.replace(mark, text)

    @query(name, oracle)
    def _(t: Tables) -> DataFrame:
        return execute_sql(t.spark, sql, params, {v: getattr(t, v) for v in views})


_statement("execute_sql", """
    SELECT "o_orderkey", o_totalprice::double AS price, 'it''s $1' AS note -- $9
    FROM orders WHERE o_totalprice > $2 AND o_orderpriority = $1 AND o_orderpriority <> ''
    ORDER BY o_totalprice DESC, o_orderkey LIMIT $3""",
    ("orders",), "2-HIGH, 100000, 25",
    {"> $2": "> 100000", "= $1": "= '2-HIGH'", "LIMIT $3": "LIMIT 25"})

_statement("sql_inner_join", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate, c_name, n_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE l_discount >= $1""",
    ("lineitem", "orders", "customer", "nation"), [0.05], {"$1": "0.05"})

_statement("sql_outer_semi_anti_join", """
    SELECT 'left' AS kind, c_custkey AS id, o_orderkey AS other
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'
    UNION ALL
    SELECT 'semi', s_suppkey, NULL FROM supplier
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > $1)
    UNION ALL
    SELECT 'anti', p_partkey, NULL FROM part
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > $1)""",
    ("customer", "orders", "supplier", "lineitem", "part"), "[49]", {"$1": "49"})

_statement("sql_group_by_having", """
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_quantity), 4) AS avg_qty,
           max(l_extendedprice) AS top_price, count(DISTINCT l_suppkey) AS suppliers
    FROM lineitem GROUP BY l_returnflag, l_linestatus HAVING count(*) > $1""",
    ("lineitem",), 10, {"$1": "10"})

_statement("sql_grouping_sets", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n, min(o_totalprice) AS least
    FROM orders
    GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())""",
    ("orders",))

_statement("sql_window_rank", """
    SELECT c_custkey, c_nationkey, CAST(place AS INTEGER) AS place FROM (
        SELECT c_custkey, c_nationkey, row_number() OVER (
            PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place
        FROM customer) ranked
    WHERE place <= $1""",
    ("customer",), [3], {"$1": "3"})

_statement("sql_set_ops", """
    (SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F'
     INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal < $1""",
    ("orders", "customer"), [0], {"$1": "0"})

_statement("sql_cte_subquery", """
    WITH totals AS (
        SELECT o_custkey, sum(o_totalprice) AS spent FROM orders GROUP BY o_custkey)
    SELECT o_custkey, round(spent, 2) AS spent FROM totals
    WHERE spent > (SELECT avg(spent) FROM totals)
      AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = $1)""",
    ("orders", "customer"), "BUILDING", {"$1": "'BUILDING'"})


@query("metadata_sql", f"""
    WITH {RAG_SQL} SELECT id, metadata ->> 'lang' AS lang FROM rag_docs
    WHERE json_type(metadata) = 'OBJECT' AND metadata ->> 'lang' IN ('en', 'de')
      AND CAST(metadata ->> 'label' AS INTEGER) BETWEEN 2 AND 6""")
def _(t: Tables) -> DataFrame:
    return execute_sql(t.spark, """
        SELECT id, metadata_map['lang'] AS lang FROM docs
        WHERE metadata_map['lang'] IN ($1, $2) AND metadata_map['label']::int BETWEEN 2 AND 6""",
        ["en", "de"], {"docs": with_metadata_map(rag_docs(t))})


@query("execute_sql_per_item", """
    SELECT s_suppkey AS item_ordinal, count(*) AS n, round(sum(c_acctbal), 2) AS total, min(c_name) AS first
    FROM supplier JOIN customer ON c_nationkey = s_nationkey AND c_acctbal > s_acctbal
    WHERE c_mktsegment <> '$1' GROUP BY s_suppkey""")
def _(t: Tables) -> DataFrame:
    items = t.supplier.select(F.col("s_suppkey").alias(ORDINAL), "s_nationkey", "s_acctbal")
    found = execute_sql_each(t.spark, """
        SELECT count(*) AS n, round(sum(c_acctbal), 2) AS total, min(c_name) AS "first" FROM customer
        WHERE c_nationkey = $1 AND c_acctbal > $2 AND c_mktsegment <> '$1'""",
        items, ["s_nationkey", "s_acctbal"], {"customer": t.customer})
    return found.filter("n > 0")
