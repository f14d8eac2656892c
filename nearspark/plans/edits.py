"""Table edits on ``customer``, with items taken from orders, suppliers and regions."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import edits
from ..operators.edits import ORDINAL, PRESENT
from ..operators.ingest import assign_ids
from ..sources import catalog
from ..sources.ledger import LedgerTable
from ..sources.staging import new_path, stage
from ..streaming.upsert import KeyedTable, stream_upsert
from ..table import ItemError, TableEditor
from .registry import Tables, query

COLUMNS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"

# One item per order. Half of the keys are new customers; status F gives no balance,
# status O no segment, and priority 5-LOW sets the segment to NULL.
ITEMS_SQL = """items AS (
    SELECT o_orderkey AS ord, o_custkey * 2 AS k,
           o_orderstatus <> 'F' AS has_bal, o_totalprice AS bal,
           o_orderstatus <> 'O' AS has_seg, nullif(o_orderpriority, '5-LOW') AS seg
    FROM orders)"""
LAST_SQL = f"""{ITEMS_SQL}, last AS (
    SELECT k, arg_max({{'v': bal}}, ord) FILTER (WHERE has_bal) AS bal,
           arg_max({{'v': seg}}, ord) FILTER (WHERE has_seg) AS seg
    FROM items GROUP BY k)"""


def order_items(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    fields = F.array_compact(F.array(
        F.lit("c_custkey"),
        F.when(status != "F", F.lit("c_acctbal")),
        F.when(status != "O", F.lit("c_mktsegment")),
    ))
    return t.orders.select(
        F.col("o_orderkey").alias(ORDINAL), fields.alias(PRESENT),
        (F.col("o_custkey") * 2).alias("c_custkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("c_mktsegment"),
    )


def supplier_items(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias(ORDINAL), F.col("s_suppkey").alias("c_custkey"),
        F.col("s_name").alias("c_name"), F.col("s_acctbal").alias("c_acctbal"),
    )


_SUPPLIERS_SQL = """
    SELECT s_suppkey AS c_custkey, s_name AS c_name, NULL AS c_nationkey,
           s_acctbal AS c_acctbal, 'NEW' AS c_mktsegment FROM supplier"""


@query("insert_rows", f"SELECT {COLUMNS} FROM customer UNION ALL {_SUPPLIERS_SQL}")
def _(t: Tables) -> DataFrame:
    defaults = {"c_mktsegment": "NEW"}
    return edits.insert_rows(t.customer, supplier_items(t), defaults, ["c_name"])


@query("insert_values", f"""
    SELECT {COLUMNS} FROM customer
    UNION ALL SELECT -1, '', 7, 12.5, NULL""")
def _(t: Tables) -> DataFrame:
    return edits.insert_values(t.customer, {
        "c_custkey": "-1", "c_name": "", "c_nationkey": "7", "c_acctbal": "12.50", " ": "skipped",
    })


@query("insert_defaults", f"""
    SELECT {COLUMNS} FROM customer
    UNION ALL SELECT 0, NULL, NULL, NULL, 'NONE' FROM orders""")
def _(t: Tables) -> DataFrame:
    items = t.orders.select(F.col("o_orderkey").alias(ORDINAL))
    defaults = {"c_custkey": "0", "c_mktsegment": "NONE"}
    return edits.insert_defaults(t.customer, items, defaults=defaults)


# Keys for the conflict rules; status P has none.
_KEYED_SQL = """keyed AS (
    SELECT o_orderkey AS ord, CASE WHEN o_orderstatus <> 'P' THEN o_custkey * 2 END AS k,
           o_orderpriority AS name, o_totalprice AS bal FROM orders),
    first AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ord) AS place FROM keyed),
    accepted AS (
        SELECT * FROM first WHERE k IS NULL
           OR (place = 1 AND k NOT IN (SELECT c_custkey FROM customer)))"""


def keyed_items(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias(ORDINAL),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey") * 2).alias("c_custkey"),
        F.col("o_orderpriority").alias("c_name"), F.col("o_totalprice").alias("c_acctbal"),
    )


@query("insert_skip_conflicts", f"""
    WITH {_KEYED_SQL} SELECT {COLUMNS} FROM customer
    UNION ALL SELECT k, name, NULL, bal, NULL FROM accepted""")
def _(t: Tables) -> DataFrame:
    return edits.insert_skip_conflicts(t.customer, keyed_items(t), "c_custkey")


@query("insert_unique_check", f"""
    WITH {_KEYED_SQL}, batch AS (SELECT k, count(*) AS n FROM keyed WHERE k IS NOT NULL GROUP BY k)
    SELECT k AS c_custkey, n AS in_batch, count(c_custkey) AS in_table
    FROM batch LEFT JOIN customer ON c_custkey = k
    GROUP BY k, n HAVING n > 1 OR count(c_custkey) > 0""")
def _(t: Tables) -> DataFrame:
    return edits.unique_violations(t.customer, keyed_items(t), "c_custkey")


# Suppliers as customers that must be new in two keys: a number, missing for every fifth of them, and a name.
_TWO_KEYS_SQL = """i AS (
        SELECT row_number() OVER (ORDER BY s_suppkey) AS n, s_suppkey AS ord, s_acctbal AS bal,
               CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey * 7 % 61 * 300 END AS k,
               'N' || (s_suppkey * s_nationkey % 40) AS name
        FROM supplier),
    c AS (SELECT i.*, k IN (SELECT c_custkey FROM customer) IS TRUE AS known FROM i),
    r AS (
        SELECT 0::BIGINT AS n, []::BIGINT[] AS ks, []::VARCHAR[] AS names, []::BIGINT[] AS accepted
        UNION ALL
        SELECT n, CASE WHEN ok AND k IS NOT NULL THEN list_append(ks, k) ELSE ks END,
               CASE WHEN ok THEN list_append(names, name) ELSE names END,
               CASE WHEN ok THEN list_append(accepted, ord) ELSE accepted END
        FROM (
            SELECT c.*, ks, names, accepted, NOT known AND NOT list_contains(names, name)
                AND NOT coalesce(list_contains(ks, k), false) AS ok
            FROM r JOIN c ON c.n = r.n + 1)),
    accepted AS (SELECT unnest(arg_max(accepted, n)) AS ord FROM r)"""


def two_key_items(t: Tables) -> DataFrame:
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    return t.supplier.select(
        key.alias(ORDINAL), F.when(key % 5 != 0, key * 7 % 61 * 300).alias("c_custkey"),
        F.concat(F.lit("N"), key * nation % 40).alias("c_name"), F.col("s_acctbal").alias("c_acctbal"),
    )


@query("insert_skip_two_keys", f"""
    WITH RECURSIVE {_TWO_KEYS_SQL} SELECT {COLUMNS} FROM customer
    UNION ALL SELECT k, name, NULL, bal, NULL FROM i JOIN accepted USING (ord)""")
def _(t: Tables) -> DataFrame:
    return edits.insert_skip_conflicts(t.customer, two_key_items(t), ["c_custkey", ["c_name"]])


_OLD_OR_NEW = """
    CASE WHEN bal IS NOT NULL THEN bal.v ELSE c_acctbal END AS c_acctbal,
    CASE WHEN seg IS NOT NULL THEN seg.v ELSE c_mktsegment END AS c_mktsegment"""


@query("update_rows", f"""
    WITH {LAST_SQL} SELECT c_custkey, c_name, c_nationkey, {_OLD_OR_NEW}
    FROM customer LEFT JOIN last ON k = c_custkey""")
def _(t: Tables) -> DataFrame:
    return edits.update_rows(t.customer, order_items(t), "c_custkey")


@query("update_rows_shared_key", """
    WITH last AS (
        SELECT s_nationkey AS k, arg_max(s_name, s_suppkey) AS name FROM supplier GROUP BY ALL)
    SELECT c_custkey, coalesce(name, c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer LEFT JOIN last ON k = c_nationkey""")
def _(t: Tables) -> DataFrame:
    return edits.update_rows(t.customer, nation_items(t), "c_nationkey")


# New names that suppliers of a nation share, and balances that may be missing.
_RENAMED_SQL = """state AS (
        SELECT c_custkey, s_suppkey IS NOT NULL AS changed,
               CASE WHEN s_suppkey IS NULL THEN c_name WHEN s_suppkey % 4 = 0 THEN 'Customer#' || (s_suppkey + 1)
                    ELSE 'of ' || s_nationkey END AS c_name,
               CASE WHEN s_suppkey IS NULL THEN c_acctbal WHEN s_suppkey % 3 > 0 THEN s_acctbal END AS c_acctbal
        FROM (SELECT c_custkey, c_acctbal, 'Customer#' || c_custkey AS c_name FROM customer)
        LEFT JOIN supplier ON s_suppkey = c_custkey)"""


@query("update_constraint_errors", f"""
    WITH {_RENAMED_SQL}
    SELECT 'not null: c_acctbal' AS "constraint", NULL AS value, count(*) AS "rows" FROM state
    WHERE changed AND c_acctbal IS NULL HAVING count(*) > 0
    UNION ALL
    SELECT 'unique: c_name', CAST(to_json({{'c_name': c_name}}) AS VARCHAR), count(*) FROM state
    GROUP BY c_name HAVING count(*) > 1 AND bool_or(changed)""")
def _(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    table = t.customer.withColumn("c_name", F.concat(F.lit("Customer#"), F.col("c_custkey")))
    items = t.supplier.select(
        key.alias(ORDINAL), key.alias("c_custkey"),
        F.when(key % 4 == 0, F.concat(F.lit("Customer#"), key + 1)).otherwise(
            F.concat(F.lit("of "), F.col("s_nationkey"))
        ).alias("c_name"),
        F.when(key % 3 > 0, F.col("s_acctbal")).alias("c_acctbal"),
    )
    changed, others = edits.changed_rows(table, items, "update", "c_custkey")
    return edits.constraint_errors(changed, others, [["c_name"]], ["c_acctbal"], ["c_name", "c_acctbal"])


@query("update_values", """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS c_name,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 7 ELSE c_nationkey END AS c_nationkey,
           c_acctbal, c_mktsegment FROM customer""")
def _(t: Tables) -> DataFrame:
    return edits.update_values(
        t.customer, "c_mktsegment", "BUILDING", {"c_nationkey": "7", "c_name": ""}
    )


@query("upsert_rows", f"""
    WITH {LAST_SQL} SELECT coalesce(c_custkey, k) AS c_custkey, c_name,
        CASE WHEN c_custkey IS NULL THEN 99 ELSE c_nationkey END AS c_nationkey, {_OLD_OR_NEW}
    FROM customer FULL JOIN last ON k = c_custkey""")
def _(t: Tables) -> DataFrame:
    return edits.upsert_rows(t.customer, order_items(t), "c_custkey", {"c_nationkey": "99"})


@query("upsert_values", f"""
    SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN c_custkey = 5 THEN -1.5 ELSE c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer
    UNION ALL SELECT -5, NULL, NULL, 3.0, NULL""")
def _(t: Tables) -> DataFrame:
    changed = edits.upsert_values(t.customer, "c_custkey", "5", {"c_acctbal": "-1.5"})
    return edits.upsert_values(changed, "c_custkey", "-5", {"c_acctbal": "3"})


# Customers with NULLs: BUILDING has no segment, nation 3 no balance.
_SPARSE_SQL = """sparse AS (
    SELECT c_custkey, c_name, CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS c_acctbal,
           nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)"""


def sparse_customers(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", "c_name",
        F.when(F.col("c_nationkey") != 3, F.col("c_acctbal")).alias("c_acctbal"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
    )


@query("delete_rows", f"""
    WITH {_SPARSE_SQL} SELECT * FROM sparse
    WHERE NOT coalesce(c_acctbal > 5000 OR c_mktsegment = 'MACHINERY', false)""")
def _(t: Tables) -> DataFrame:
    where = [("c_acctbal", ">", "5000"), ("c_mktsegment", "=", "MACHINERY")]
    return edits.delete_rows(sparse_customers(t), where, "OR")


@query("delete_affected", f"""
    WITH {_SPARSE_SQL} SELECT true AS success, count(*) AS "affectedRows" FROM sparse
    WHERE c_acctbal > 5000 AND c_mktsegment <> 'MACHINERY'""")
def _(t: Tables) -> DataFrame:
    where = [("c_acctbal", ">", "5000"), ("c_mktsegment", "!=", "MACHINERY")]
    return edits.affected_by_delete(sparse_customers(t), where)


def limits(t: Tables) -> DataFrame:
    """Per supplier its nation and an interval of balances."""
    return t.supplier.select(
        F.col("s_suppkey").alias(ORDINAL), "s_nationkey", F.col("s_acctbal").alias("low"),
        (F.col("s_acctbal") + F.lit(50.0)).alias("high"),
    )


def _per_item_sql(match: str) -> str:
    return f"""hits AS (
        SELECT c_custkey, min(s_suppkey) AS ord FROM customer JOIN supplier ON {match} GROUP BY c_custkey),
    affected AS (
        SELECT s_suppkey AS item_ordinal, true AS success, count(c_custkey) AS "affectedRows"
        FROM supplier LEFT JOIN hits ON ord = s_suppkey GROUP BY s_suppkey),
    kept AS (SELECT customer.* FROM customer ANTI JOIN hits USING (c_custkey))"""


_BY_NATION = "c_nationkey = s_nationkey AND c_acctbal > s_acctbal"
_BY_BALANCE = "c_acctbal >= s_acctbal AND c_acctbal < s_acctbal + 50.0"
_NATION_WHERE = [("c_nationkey", "=", "s_nationkey"), ("c_acctbal", ">", "low")]
_BALANCE_WHERE = [("c_acctbal", ">=", "low"), ("c_acctbal", "<", "high")]


@query("delete_per_item", f"WITH {_per_item_sql(_BY_NATION)} SELECT * FROM affected")
def _(t: Tables) -> DataFrame:
    return edits.affected_by_delete_each(t.customer, limits(t), _NATION_WHERE)


@query("delete_per_item_range", f"WITH {_per_item_sql(_BY_BALANCE)} SELECT * FROM affected")
def _(t: Tables) -> DataFrame:
    return edits.affected_by_delete_each(t.customer, limits(t), _BALANCE_WHERE)


@query("delete_per_item_rows", f"WITH {_per_item_sql(_BY_BALANCE)} SELECT {COLUMNS} FROM kept")
def _(t: Tables) -> DataFrame:
    return edits.delete_each(t.customer, limits(t), _BALANCE_WHERE)


def _refilled(t: Tables, last_id: int) -> DataFrame:
    """The table after a truncate and an insert of all orders with fresh ids."""
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("value"))
    table = t.orders.select(F.col("o_custkey").alias("id"), "o_orderkey", F.lit(0.0).alias("value"))
    added = assign_ids(rows, last_id + 1, ("o_orderkey",))
    return edits.truncate_rows(table).unionByName(added)


@query("truncate_rows", """
    SELECT (SELECT max(o_custkey) FROM orders) + row_number() OVER (ORDER BY o_orderkey) AS id,
           o_orderkey, o_totalprice AS value FROM orders""")
def _(t: Tables) -> DataFrame:
    return _refilled(t, t.orders.agg(F.max("o_custkey")).first()[0])


@query("truncate_restart_identity", """
    SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey, o_totalprice AS value
    FROM orders""")
def _(t: Tables) -> DataFrame:
    return _refilled(t, 0)


_HISTORY_SQL = f"""{ITEMS_SQL}, history AS (
    SELECT ord, k,
        last_value(CASE WHEN has_bal THEN {{'v': bal}} END IGNORE NULLS) OVER w AS bal,
        last_value(CASE WHEN has_seg THEN {{'v': seg}} END IGNORE NULLS) OVER w AS seg
    FROM items WINDOW w AS (PARTITION BY k ORDER BY ord ROWS UNBOUNDED PRECEDING))"""


@query("returning", f"""
    WITH {_HISTORY_SQL} SELECT ord AS item_ordinal, c_custkey, {_OLD_OR_NEW}
    FROM customer JOIN history ON k = c_custkey""")
def _(t: Tables) -> DataFrame:
    return edits.returning_updated(
        t.customer, order_items(t), "c_custkey", "c_custkey,c_acctbal,c_mktsegment"
    )


@query("returning_upserted", f"""
    WITH {_HISTORY_SQL} SELECT ord AS item_ordinal, k AS c_custkey, c_name, c_nationkey,
        {_OLD_OR_NEW} FROM history LEFT JOIN customer ON k = c_custkey""")
def _(t: Tables) -> DataFrame:
    return edits.returning_upserted(t.customer, order_items(t), "c_custkey", "*")


def nation_items(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias(ORDINAL), F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_name").alias("c_name"),
    )


@query("affected_rows", """
    SELECT s_suppkey AS item_ordinal, true AS success, count(c_custkey) AS "affectedRows"
    FROM supplier LEFT JOIN customer ON c_nationkey = s_nationkey GROUP BY s_suppkey""")
def _(t: Tables) -> DataFrame:
    return edits.affected_by_update(t.customer, nation_items(t), "c_nationkey")


@query("affected_rows_skip", f"""
    WITH {_KEYED_SQL} SELECT keyed.ord AS item_ordinal, true AS success,
        CAST(accepted.ord IS NOT NULL AS BIGINT) AS "affectedRows"
    FROM keyed LEFT JOIN accepted ON accepted.ord = keyed.ord""")
def _(t: Tables) -> DataFrame:
    return edits.affected_by_insert(t.customer, keyed_items(t), "c_custkey")


# Text items: status P has a word for a balance, 5-LOW orders of status F no key.
_TEXT_SQL = """texts AS (
    SELECT o_orderkey AS ord,
           CASE WHEN o_orderstatus <> 'F' OR o_orderpriority <> '5-LOW'
                THEN o_custkey * 2 END AS k,
           CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
                ELSE CAST(o_orderkey AS VARCHAR) END AS bal FROM orders)"""


def text_items(t: Tables) -> DataFrame:
    status, low = F.col("o_orderstatus"), F.col("o_orderpriority") == "5-LOW"
    key = F.when((status != "F") | ~low, (F.col("o_custkey") * 2).cast("string"))
    balance = F.when(status == "P", F.col("o_orderpriority")).otherwise(
        F.col("o_orderkey").cast("string")
    )
    return t.orders.select(
        F.col("o_orderkey").alias(ORDINAL), key.alias("c_custkey"), balance.alias("c_acctbal")
    )


@query("edit_errors", f"""
    WITH {_TEXT_SQL} SELECT ord AS item_ordinal,
        CASE WHEN k IS NULL THEN 'Unique column ''c_custkey'' must have a value'
             ELSE 'invalid input syntax for type double: "' || bal || '"' END AS error
    FROM texts WHERE k IS NULL OR TRY_CAST(bal AS DOUBLE) IS NULL""")
def _(t: Tables) -> DataFrame:
    checked = edits.item_errors(t.customer, text_items(t), "upsert", "c_custkey")
    return edits.split_errors(checked)[1]


def _on_table(t: Tables, rows: DataFrame, work: Callable[[TableEditor], None], **options) -> DataFrame:
    """The rows of a catalog table that starts with ``rows`` after ``work``; the table is dropped."""
    name = f"query_{uuid.uuid4().hex}"
    catalog.create_table(t.spark, name, rows.schema)
    try:
        catalog.append(t.spark, name, rows)
        editor = TableEditor(t.spark, name, **options)
        work(editor)
        return stage(editor.rows(), "table")
    finally:
        catalog.drop_table(t.spark, name)


@query("atomic_batch", f"""
    WITH {_TEXT_SQL}, last AS (
        SELECT k, arg_max(CAST(bal AS DOUBLE), ord) AS bal FROM texts
        WHERE k IS NOT NULL AND TRY_CAST(bal AS DOUBLE) IS NOT NULL GROUP BY k)
    SELECT coalesce(c_custkey, k) AS c_custkey, c_name, c_nationkey,
           coalesce(bal, c_acctbal) AS c_acctbal, c_mktsegment
    FROM customer FULL JOIN last ON k = c_custkey""")
def _(t: Tables) -> DataFrame:
    """A batch with bad items changes nothing; without them the others go in."""
    def work(editor: TableEditor) -> None:
        before = editor.rows().count()
        try:
            editor.upsert(text_items(t), "c_custkey")
        except ItemError:
            editor.continue_on_fail = True
        if editor.rows().count() != before:
            raise RuntimeError("a refused batch changed the table")
        editor.upsert(text_items(t), "c_custkey")

    return _on_table(t, t.customer, work, unique="c_custkey")


@query("table_round_trip", f"""
    WITH {LAST_SQL}, inserted AS (
        SELECT {COLUMNS} FROM customer
        UNION ALL SELECT -1 - s_suppkey, s_name, NULL, s_acctbal, 'NEW' FROM supplier),
    named AS (
        SELECT c_custkey, CASE WHEN s_suppkey IS NULL THEN c_name ELSE 'renamed ' || s_suppkey END AS c_name,
               c_nationkey, c_acctbal, c_mktsegment
        FROM inserted LEFT JOIN supplier ON s_suppkey * 2 = c_custkey),
    upserted AS (
        SELECT coalesce(c_custkey, k) AS c_custkey, c_name, c_nationkey, {_OLD_OR_NEW}
        FROM named FULL JOIN (SELECT k, bal, CASE WHEN c.c_custkey IS NULL AND seg IS NULL THEN {{'v': 'NEW'}} ELSE seg END AS seg
                              FROM last LEFT JOIN customer c ON c.c_custkey = k) ON k = c_custkey),
    deleted AS (SELECT * FROM upserted WHERE NOT coalesce(c_acctbal > 300000 OR c_mktsegment = 'MACHINERY', false))
    SELECT {COLUMNS} FROM deleted WHERE NOT EXISTS (
        SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey AND c_acctbal > s_acctbal + 5000)""")
def _(t: Tables) -> DataFrame:
    """All edits, one after the other, on one catalog table."""
    def work(editor: TableEditor) -> None:
        editor.insert(supplier_items(t).withColumn("c_custkey", -1 - F.col("c_custkey")))
        key = F.col("s_suppkey")
        editor.update(t.supplier.select(
            key.alias(ORDINAL), (key * 2).alias("c_custkey"), F.concat(F.lit("renamed "), key).alias("c_name")
        ), "c_custkey")
        editor.upsert(order_items(t), "c_custkey")
        editor.delete(where=[("c_acctbal", ">", "300000"), ("c_mktsegment", "=", "MACHINERY")], combine="OR")
        items = limits(t).withColumn("low", F.col("low") + 5000)
        editor.delete_each(items, _NATION_WHERE)

    return _on_table(t, t.customer, work, unique="c_custkey", defaults={"c_mktsegment": "NEW"})


@query("ledger_edits", """
    WITH changed AS (
        SELECT c_custkey, c_name, c_nationkey,
               CASE WHEN s_suppkey IS NOT NULL THEN s_acctbal ELSE c_acctbal END AS c_acctbal, c_mktsegment
        FROM customer LEFT JOIN supplier ON s_suppkey * 3 = c_custkey)
    SELECT * FROM changed WHERE c_custkey % 50 <> 7 OR c_acctbal IS NULL
    UNION ALL SELECT -1 - s_suppkey, s_name, NULL, s_acctbal, NULL FROM supplier""")
def _(t: Tables) -> DataFrame:
    """Insert, update and delete on a table with a ledger, which rewrites only files with hits."""
    table = LedgerTable.create(t.spark, new_path(t.spark, "ledger"), t.customer.schema)
    table.append(t.customer.repartitionByRange(8, "c_custkey"))
    editor = TableEditor(t.spark, table, unique="c_custkey")
    key = F.col("s_suppkey")
    editor.update(t.supplier.select(
        key.alias(ORDINAL), (key * 3).alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal")
    ), "c_custkey")
    table.edit(
        lambda rows: rows.filter("c_custkey % 50 = 7 AND c_acctbal IS NOT NULL"),
        lambda rows: rows.filter("c_custkey % 50 <> 7 OR c_acctbal IS NULL"),
    )
    editor.insert(supplier_items(t).withColumn("c_custkey", -1 - F.col("c_custkey")))
    return editor.rows()


@query("item_lineage", """
    SELECT s_suppkey AS item_ordinal, s_suppkey AS c_custkey, s_name AS c_name,
           NULL::INTEGER AS c_nationkey, s_acctbal AS c_acctbal, NULL::VARCHAR AS c_mktsegment
    FROM supplier""")
def _(t: Tables) -> DataFrame:
    image = edits.insert_image(t.customer, supplier_items(t))
    return edits.returning_inserted(image, "*")


@query("stream_upsert", """
    SELECT user_id, event_id, ts, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place
        FROM events) WHERE place = 1""")
def _(t: Tables) -> DataFrame:
    fields = ["user_id", "event_id", "ts", "event_type", "value"]
    path = new_path(t.spark, "events")
    t.events.write.parquet(path)
    items = t.spark.readStream.schema(t.events.schema).parquet(path).select(*fields)
    table = KeyedTable(
        t.spark, new_path(t.spark, "keyed"), items.schema, "user_id", "event_id", buckets=8
    )
    stream_upsert(items, table).awaitTermination()
    return table.read().select(*fields)
