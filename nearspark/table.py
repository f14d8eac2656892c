"""The six table operations on a catalog table, or on a table with a ledger."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.names import parse_output_columns
from .operators import edits
from .operators.edits import ORDINAL
from .operators.predicates import filter_rows
from .operators.select import DEFAULT_LIMIT, select_per_item, select_rows
from .operators.sqlexec import execute_sql, execute_sql_each
from .sources import catalog
from .sources.ledger import LedgerTable
from .sources.staging import stage


class ItemError(ValueError):
    """An item that cannot apply; nothing of its batch was written."""


class TableEditor:
    """Select, insert, update, upsert and delete on one table.

    ``unique`` is a column, the columns of a composite key, or a list of several keys; ``not_null`` are
    columns that need a value. Edits that would break one of them are refused as a whole.

    On a catalog table, named by ``table``, an edit writes the whole new state. On a ``LedgerTable`` it rewrites
    only the files that hold rows it touches.

    Each edit returns rows for its items: the output columns asked for, else
    ``(item_ordinal, success, affectedRows)``. Batches are all-or-nothing, except that
    with ``continue_on_fail`` bad items turn into ``(item_ordinal, error)`` rows,
    available as ``errors`` afterwards, and the others go on.
    """

    def __init__(
        self,
        spark: SparkSession,
        table: str | LedgerTable,
        schema: str = catalog.DEFAULT_SCHEMA,
        unique: str | Sequence | None = None,
        not_null: Sequence[str] = (),
        defaults: Mapping[str, Any] | None = None,
        continue_on_fail: bool = False,
    ):
        self.spark = spark
        self.ledger = table if isinstance(table, LedgerTable) else None
        self.name = table.path if self.ledger else table if "." in table else f"{schema}.{table}"
        self.unique, self.not_null, self.defaults = unique, tuple(not_null), dict(defaults or {})
        self.continue_on_fail = continue_on_fail
        self.errors: DataFrame | None = None

    def rows(self) -> DataFrame:
        return self.ledger.read() if self.ledger else catalog.read_table(self.spark, self.name)

    def _append(self, rows: DataFrame) -> None:
        if self.ledger:
            self.ledger.append(rows)
        else:
            catalog.append(self.spark, self.name, rows)

    def _edit(self, hit: Callable[[DataFrame], DataFrame], change: Callable[[DataFrame], DataFrame]) -> None:
        """Apply ``change``, which leaves rows alone that ``hit`` leaves out."""
        if self.ledger:
            self.ledger.edit(hit, change)
            self.ledger.vacuum()
        else:
            catalog.edit(self.spark, self.name, change)

    def execute_query(self, sql: str, parameters: Any = None, items: DataFrame | None = None) -> DataFrame:
        """Run SQL, or with ``items`` a query for each of them, whose ``parameters`` are item columns."""
        if items is not None:
            return execute_sql_each(self.spark, sql, items, parameters)
        return execute_sql(self.spark, sql, parameters)

    def _keys(self) -> list[list[str]]:
        return edits.unique_keys(self.unique)

    def _check_constraints(self, changed: DataFrame, others: DataFrame, fields=None) -> None:
        broken = edits.constraint_errors(changed, others, self.unique, self.not_null, fields).first()
        if broken is None:
            return
        kind, name = broken["constraint"].split(": ", 1)
        if kind == "not null":
            raise ItemError(f'null value in column "{name}" violates not-null constraint')
        raise ItemError(f"duplicate key value violates unique constraint: {broken['value']}")

    def select(
        self, columns=None, where: Iterable = (), combine: str = "AND", sort: Iterable = (),
        limit: int = DEFAULT_LIMIT, return_all: bool = False,
    ) -> DataFrame:
        return select_rows(self.rows(), columns, where, combine, sort, limit, return_all)

    def select_each(
        self, items: DataFrame, where: Iterable, columns=None, combine: str = "AND", sort: Iterable = (),
        limit: int = DEFAULT_LIMIT, return_all: bool = False, unique: str | None = None,
    ) -> DataFrame:
        """The select of every item, with its own values and its own limit.

        ``where`` holds ``(column, condition, item column)``. Ties fall to the smaller value of
        ``unique``, by default the table's first unique column.
        """
        unique = unique or next((key[0] for key in self._keys() if len(key) == 1), None)
        if unique is None:
            raise ValueError("name a unique column")
        return select_per_item(
            self.rows(), items, where, sort, unique, columns, combine, limit, return_all
        )

    def insert(
        self, items: DataFrame, output_columns=None, skip_on_conflict: bool = False
    ) -> DataFrame:
        required = [c for c in self.not_null if c not in self.defaults]
        items = self._accept(items, "insert", None, required)
        table = self.rows()
        options = {"defaults": self.defaults, "not_null": self.not_null}
        if self.unique and skip_on_conflict:
            image = edits.accepted_rows(table, items, self.unique, **options)
        else:
            image = edits.insert_image(table, items, **options)
            for key in self._keys():
                clash = edits.unique_violations(table, image, key).first()
                if clash is not None:
                    raise ItemError(f"duplicate key value violates unique constraint: {clash}")
        image = stage(image, "insert")
        self._append(image.drop(ORDINAL))
        if parse_output_columns(output_columns):
            return edits.returning_inserted(image, output_columns)
        hit = image.select(ORDINAL, F.lit(1).cast("long").alias("_in"))
        joined = items.select(ORDINAL).join(hit, ORDINAL, "left")
        return edits.summary(joined, F.coalesce("_in", F.lit(0)).cast("long"))

    def insert_values(self, values: Mapping[str, str], **options) -> DataFrame:
        return self.insert(edits.manual_item(self.rows(), values), **options)

    def update(self, items: DataFrame, match: str, output_columns=None) -> DataFrame:
        items = self._accept(items, "update", match)
        table = self.rows()
        fields = [f for f in edits.item_fields(items) if f != match]
        if set(fields) & {*self.not_null, *(c for key in self._keys() for c in key)}:
            self._check_constraints(*edits.changed_rows(table, items, "update", match), fields)
        if parse_output_columns(output_columns):
            result = edits.returning_updated(table, items, match, output_columns)
        else:
            result = edits.affected_by_update(table, items, match)
        # staged before the swap, as it reads the table as it was
        result = stage(result, "result")
        self._edit(edits.having(items, match), lambda t: edits.update_rows(t, items, match))
        return result

    def update_values(self, match: str, value: Any, values: Mapping[str, str], **options):
        return self.update(edits.manual_item(self.rows(), {**values, match: value}), match, **options)

    def upsert(self, items: DataFrame, key: str, output_columns=None) -> DataFrame:
        items = self._accept(items, "upsert", key)
        table = self.rows()
        if edits.unique_violations(table, items, key).filter("in_table > 1").first() is not None:
            raise ItemError(f"column '{key}' is not unique in {self.name}")
        if self.not_null or self.unique:
            self._check_constraints(*edits.changed_rows(table, items, "upsert", key, self.defaults))
        if parse_output_columns(output_columns):
            result = edits.returning_upserted(table, items, key, output_columns, self.defaults)
        else:
            result = edits.affected_by_upsert(items)
        result = stage(result, "result")
        self._edit(edits.having(items, key), lambda t: edits.upsert_rows(t, items, key, self.defaults))
        return result

    def upsert_values(self, key: str, value: str, values: Mapping[str, str], **options):
        return self.upsert(edits.manual_item(self.rows(), {**values, key: value}), key, **options)

    def delete(
        self, command: str = "delete", where: Iterable = (), combine: str = "AND",
        restart_identity: bool = False,
    ) -> DataFrame:
        """``delete`` (by conditions), ``truncate`` or ``drop``."""
        if command == "drop" and not self.ledger:
            catalog.drop_table(self.spark, self.name)
        elif command == "truncate" and self.ledger:
            self.ledger.commit([])
        elif command == "truncate":
            catalog.truncate(self.spark, self.name, restart_identity)
        elif command == "delete":
            where = list(where)
            result = stage(edits.affected_by_delete(self.rows(), where, combine), "result")
            self._edit(
                lambda t: t if not where else filter_rows(t, where, combine), lambda t: edits.delete_rows(t, where, combine)
            )
            return result
        else:
            raise ValueError(f"Invalid delete command '{command}'")
        return self.spark.createDataFrame([(True, 0)], "success boolean, affectedRows long")

    def delete_each(self, items: DataFrame, where: Iterable, combine: str = "AND") -> DataFrame:
        """Every item deletes the rows that match its values; one row per item says how many.

        ``where`` holds ``(column, condition, item column)``.
        """
        where, table = [tuple(c) for c in where], self.rows()
        result = stage(edits.affected_by_delete_each(table, items, where, combine), "result")
        gone = lambda t: edits.hit_each(t, items, where, combine)
        self._edit(gone, lambda t: edits.delete_each(t, items, where, combine))
        return result

    def _accept(self, items: DataFrame, operation: str, key: str | None, not_null=()) -> DataFrame:
        checked = edits.item_errors(self.rows(), items, operation, key, not_null)
        good, bad = edits.split_errors(checked)
        if self.continue_on_fail:
            self.errors = bad
            return good
        first = bad.orderBy(ORDINAL).first()
        if first is not None:
            raise ItemError(f"{first['error']} [item {first[ORDINAL]}]")
        return items
