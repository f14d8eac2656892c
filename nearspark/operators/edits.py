"""Table edits as functions from table state to table state.

A batch of items is a DataFrame with an ordinal column that says in which order the
items apply. An optional ``item_columns`` array names the fields an item really has:
a field that is there but NULL sets NULL, a field that is not there leaves the table
value alone. Without that array every column counts as given.

The item-by-item loop becomes per-key aggregation: only the order of items with the
same key matters, and the last given value of each column wins. Aggregation starts
before the shuffle, so a key that many items share is no hot spot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.literals import typed_literal
from ..functions.names import column, data_type, output_columns, parse_output_columns
from ..sources.staging import stage
from .predicates import NULL_CONDITIONS, combine_columns, condition_column, where_column
from .select import match_first, match_params
from .sizing import has_rows, small_row_count

ORDINAL = "item_ordinal"
PRESENT = "item_columns"
HISTORY_CHUNK = 1_000_000


# ---------------------------------------------------------------- items

def items_from_json(rows: DataFrame, json: str, schema: T.StructType, ordinal: str) -> DataFrame:
    """Items out of JSON text, knowing absent fields from NULL ones."""
    return rows.select(
        F.col(ordinal).alias(ORDINAL),
        F.json_object_keys(json).alias(PRESENT),
        F.from_json(json, schema).alias("_item"),
    ).select(ORDINAL, PRESENT, "_item.*")


def item_fields(items: DataFrame) -> list[str]:
    return [c for c in items.columns if c not in (ORDINAL, PRESENT)]


def given(items: DataFrame, name: str) -> Column:
    """Whether an item has the field."""
    if name not in items.columns:
        return F.lit(False)
    if PRESENT not in items.columns:
        return F.lit(True)
    return F.coalesce(F.array_contains(PRESENT, name), F.lit(False))


def _check_fields(table: DataFrame, fields: Iterable[str]) -> None:
    for name in fields:
        column(table, name)


def _cast(items: DataFrame, table: DataFrame) -> DataFrame:
    """Item fields in the types of the table."""
    _check_fields(table, item_fields(items))
    kept = [c for c in (ORDINAL, PRESENT) if c in items.columns]
    return items.select(
        *kept, *[column(items, c).cast(data_type(table, c)).alias(c) for c in item_fields(items)]
    )


def manual_item(table: DataFrame, values: Mapping[str, str], ordinal: int = 0) -> DataFrame:
    """One item from column/text pairs; blank names are skipped, blank text stays text."""
    kept = {k.strip(): v for k, v in values.items() if k.strip()}
    _check_fields(table, kept)
    one = table.sparkSession.range(ordinal, ordinal + 1).withColumnRenamed("id", ORDINAL)
    return one.select(
        ORDINAL, *[typed_literal(v, data_type(table, c)).alias(c) for c, v in kept.items()]
    )


# ---------------------------------------------------------------- insert

def insert_image(
    table: DataFrame,
    items: DataFrame,
    defaults: Mapping[str, Any] | None = None,
    not_null: Sequence[str] = (),
) -> DataFrame:
    """Items as full table rows plus their ordinal; absent fields take the default."""
    items, fields, rows = _cast(items, table), item_fields(items), []
    for name in table.columns:
        default = typed_literal((defaults or {}).get(name), data_type(table, name))
        value = default
        if name in fields:
            value = F.when(given(items, name), column(items, name)).otherwise(default)
        if name in not_null:
            error = F.raise_error(
                F.lit(f'null value in column "{name}" violates not-null constraint')
            )
            value = F.coalesce(value, error.cast(data_type(table, name)))
        rows.append(value.alias(name))
    return items.select(ORDINAL, *rows)


def insert_rows(
    table: DataFrame,
    items: DataFrame,
    defaults: Mapping[str, Any] | None = None,
    not_null: Sequence[str] = (),
) -> DataFrame:
    """The table plus the items."""
    return table.unionByName(insert_image(table, items, defaults, not_null).drop(ORDINAL))


def insert_values(table: DataFrame, values: Mapping[str, str], **options) -> DataFrame:
    """The table plus one row given as column/text pairs."""
    return insert_rows(table, manual_item(table, values), **options)


def insert_defaults(table: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The table plus one all-defaults row for every (empty) item."""
    return insert_rows(table, items.select(ORDINAL), **options)


def _key(df: DataFrame, key: str | Sequence[str]) -> list[str]:
    names = [key] if isinstance(key, str) else list(key)
    _check_fields(df, names)
    return names


def unique_keys(key: str | Sequence | None) -> list[list[str]]:
    """One or more unique keys: a column, the columns of a composite key, or a list of such lists."""
    if not key:
        return []
    if isinstance(key, str):
        return [[key]]
    parts = list(key)
    if all(isinstance(p, str) for p in parts):
        return [parts]
    return [[p] if isinstance(p, str) else list(p) for p in parts]


def _any_null(names: Sequence[str]) -> Column:
    condition = F.lit(False)
    for name in names:
        condition = condition | F.col(f"`{name}`").isNull()
    return condition


def accepted_rows(
    table: DataFrame, items: DataFrame, key: str | Sequence, **options
) -> DataFrame:
    """The insert images (with ordinal) that a skip-on-conflict insert lets in.

    Rows of the table win over items, earlier items over later ones. A NULL in the
    key never conflicts; such rows go past the key join, where they would all meet
    in one partition. ``key`` may be several unique keys, see :func:`unique_keys`.
    """
    image = insert_image(table, items, **options)
    keys = [_key(table, k) for k in unique_keys(key)]
    few = small_row_count(items) is not None
    if len(keys) > 1:
        return _accepted_by_all(table, image, keys, few)
    names = keys[0]
    keyed = image.filter(~_any_null(names))
    first = keyed.groupBy(*names).agg(
        F.min_by(F.struct(*[column(image, c) for c in image.columns]), F.col(ORDINAL)).alias("_row")
    )
    fresh = _without_existing(table, first, names, few)
    return fresh.select("_row.*").unionByName(image.filter(_any_null(names)))


def _accepted_by_all(table: DataFrame, image: DataFrame, keys: list[list[str]], few: bool) -> DataFrame:
    """The items that get in one after the other when each must be new in all of its keys.

    An item that is the first of the open items in all of its keys gets in; items that share a
    key with it are out, which frees their other keys. This is repeated until no item is open: as often
    as the longest chain of items of which each depends on the one before. Only ordinals and keys take part.
    """
    image = stage(image, "insert-image")
    groups = [f"_g{n}" for n in range(len(keys))]
    open_ = image
    for names in keys:
        nulls = open_.filter(_any_null(names))
        open_ = _without_existing(table, open_.filter(~_any_null(names)), names, few).unionByName(nulls)
    open_ = open_.select(ORDINAL, *[
        F.when(~_any_null(names), F.struct(*[column(image, n) for n in names])).alias(g) for names, g in zip(keys, groups)
    ])
    open_, accepted = stage(open_, "insert-open"), None
    while True:
        first, known = F.lit(True), open_
        for n, g in enumerate(groups):
            least = open_.filter(F.col(g).isNotNull()).groupBy(g).agg(F.min(ORDINAL).alias(f"_least{n}"))
            known = known.join(least, g, "left")
            first = first & (F.col(g).isNull() | (F.col(ORDINAL) == F.col(f"_least{n}")))
        known = stage(known.select(ORDINAL, *groups, first.alias("_first")), "insert-first")
        let_in = known.filter("_first")
        accepted = let_in if accepted is None else accepted.unionByName(let_in)
        left = known.filter("NOT _first").drop("_first")
        for g in groups:
            left = left.join(let_in.filter(F.col(g).isNotNull()).select(g), g, "left_anti")
        open_ = stage(left.select(ORDINAL, *groups), "insert-open")
        if not has_rows(open_, 1):
            return image.join(accepted.select(ORDINAL), ORDINAL, "left_semi").select(*image.columns)


def _without_existing(
    table: DataFrame, rows: DataFrame, names: Sequence[str], few: bool
) -> DataFrame:
    """``rows`` whose key the table does not have.

    If they are known to be few, the table is only probed with their keys, not shuffled.
    """
    keys = table.select(*[column(table, n) for n in names])
    if few:
        wanted = rows.select(*[column(rows, n) for n in names])
        keys = F.broadcast(keys.join(F.broadcast(wanted), list(names), "left_semi").distinct())
    return rows.join(keys, list(names), "left_anti")


def _count_keys(
    table: DataFrame, wanted: DataFrame, names: Sequence[str], items: DataFrame, alias: str
) -> DataFrame:
    """Table rows per key. For few items only the wanted keys are counted; otherwise all
    are, as counting starts before the shuffle and shrinks hot keys, which a join would not.
    """
    keys = table.select(*[column(table, n) for n in names]).filter(~_any_null(names))
    if small_row_count(items) is not None:
        keys = keys.join(F.broadcast(wanted), list(names), "left_semi")
    return keys.groupBy(*names).agg(F.count(F.lit(1)).alias(alias))


def insert_skip_conflicts(
    table: DataFrame, items: DataFrame, key: str | Sequence, **options
) -> DataFrame:
    """The table plus the items that do not collide on the (possibly composite) key, or on any
    of several keys."""
    return table.unionByName(accepted_rows(table, items, key, **options).drop(ORDINAL))


def unique_violations(table: DataFrame, items: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys a plain insert would duplicate: ``key, in_batch, in_table``."""
    names = _key(table, key)
    batch = _cast(items, table).filter(~_any_null(names)).groupBy(*names).agg(
        F.count(F.lit(1)).alias("in_batch")
    )
    existing = _count_keys(table, batch.select(*names), names, items, "in_table")
    both = batch.join(existing, names, "left").na.fill(0, ["in_table"])
    return both.filter((F.col("in_batch") > 1) | (F.col("in_table") > 0))


# ---------------------------------------------------------------- update, upsert

def reduce_items(items: DataFrame, key: str, ordinal: str = ORDINAL) -> DataFrame:
    """One row per non-NULL key with, per field, a struct of its last given value.

    The struct is NULL if no item of the key gives the field, which keeps "set to
    NULL" apart from "not given".
    """
    fields = [f for f in item_fields(items) if f != key]
    rows = items.filter(column(items, key).isNotNull())
    if PRESENT not in items.columns:
        last = F.max_by(F.struct(*[column(items, f) for f in fields]), F.col(ordinal))
        whole = rows.groupBy(key).agg(last.alias("_last"))
        return whole.select(
            key, *[F.struct(F.col("_last")[f].alias("v")).alias(f) for f in fields]
        )
    return rows.groupBy(key).agg(*[
        F.max_by(
            F.struct(column(items, f).alias("v")), F.when(given(items, f), F.col(ordinal))
        ).alias(f)
        for f in fields
    ])


def _overlay(table: DataFrame, changes: DataFrame, key: str) -> list[Column]:
    """Table columns with the given changes on top (aliases ``t`` and ``s``)."""
    rows = []
    for name in table.columns:
        old = F.col(f"t.`{name}`")
        if name != key and name in changes.columns:
            new = F.col(f"s.`{name}`")
            old = F.when(new.isNotNull(), new["v"]).otherwise(old)
        rows.append(old.alias(name))
    return rows


def _same_key(key: str) -> Column:
    return F.col(f"t.`{key}`") == F.col(f"s.`{key}`")


def _measured(items: DataFrame, changes: DataFrame) -> DataFrame:
    """``changes``, broadcast if the items they come from were measured to be few."""
    return F.broadcast(changes) if small_row_count(items) is not None else changes


def update_rows(table: DataFrame, items: DataFrame, match: str) -> DataFrame:
    """The table after every item set its fields on all rows matching its ``match`` value.

    Few items: the table is not shuffled. Many: one join on the key, where adaptive
    execution splits a key that many table rows share.
    """
    _check_update(items, match)
    items = _cast(items, table)
    changes = _measured(items, reduce_items(items, match))
    return table.alias("t").join(changes.alias("s"), _same_key(match), "left").select(
        *_overlay(table, changes, match)
    )


def update_values(
    table: DataFrame, match: str, value: Any, values: Mapping[str, str]
) -> DataFrame:
    """Manual form: set columns to texts where ``match`` equals ``value``; one projection."""
    kept = {k.strip(): v for k, v in values.items() if k.strip() and k.strip() != match}
    _check_fields(table, kept)
    if not kept:
        raise ValueError(NOTHING_TO_UPDATE)
    hit = F.coalesce(condition_column(table, (match, "=", value)), F.lit(False))
    return table.select(*[
        F.when(hit, typed_literal(kept[c], data_type(table, c))).otherwise(column(table, c)).alias(c)
        if c in kept else column(table, c)
        for c in table.columns
    ])


# What users of these edits know the errors by.
NOTHING_TO_UPDATE = "No columns to update. An item needs a value besides the match column."
NOTHING_TO_UPSERT = "Add at least one value besides the unique column"


def _check_update(items: DataFrame, match: str) -> None:
    if match not in items.columns:
        raise ValueError(f"Column to match on '{match}' not found in input item")
    if not [f for f in item_fields(items) if f != match]:
        raise ValueError(NOTHING_TO_UPDATE)


def _check_upsert(items: DataFrame, key: str) -> None:
    if key not in items.columns:
        raise ValueError(f"Unique column '{key}' must have a value")
    if not [f for f in item_fields(items) if f != key]:
        raise ValueError(NOTHING_TO_UPSERT)


def _fresh_row(table: DataFrame, changes: DataFrame, key: str, defaults) -> list[Column]:
    """A new row out of the changes of its key (alias ``s``); the rest takes defaults."""
    rows = []
    for name in table.columns:
        default = typed_literal((defaults or {}).get(name), data_type(table, name))
        if name == key:
            value = F.col(f"s.`{name}`")
        elif name in changes.columns:
            new = F.col(f"s.`{name}`")
            value = F.when(new.isNotNull(), new["v"]).otherwise(default)
        else:
            value = default
        rows.append(value.alias(name))
    return rows


def upsert_rows(
    table: DataFrame, items: DataFrame, key: str, defaults: Mapping[str, Any] | None = None
) -> DataFrame:
    """The table after inserting the items or, where the key exists, overwriting.

    The key is unique in the table. Few items: the table is read twice (the second
    time only its key) but never shuffled. Many items: one full outer join.
    """
    _check_upsert(items, key)
    items = _cast(items, table)
    changes = reduce_items(items, key)
    old = table.alias("t")
    if small_row_count(items) is not None:
        small = F.broadcast(changes).alias("s")
        kept = old.join(small, _same_key(key), "left").select(*_overlay(table, changes, key))
        fresh = _without_existing(table, changes, [key], True).alias("s")
        return kept.unionByName(fresh.select(*_fresh_row(table, changes, key, defaults)))
    old = table.withColumn("_old", F.lit(True)).alias("t")
    merged = old.join(changes.alias("s"), _same_key(key), "full_outer")
    stays = F.coalesce(F.col("t._old"), F.lit(False))
    both = zip(
        table.columns, _overlay(table, changes, key), _fresh_row(table, changes, key, defaults)
    )
    return merged.select(*[F.when(stays, o).otherwise(n).alias(c) for c, o, n in both])


def upsert_values(
    table: DataFrame, key: str, value: str, values: Mapping[str, str],
    defaults: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Manual form of :func:`upsert_rows` for one key value and column/text pairs."""
    item = manual_item(table, {**values, key: value})
    return upsert_rows(table, item, key, defaults)


# ---------------------------------------------------------------- constraints

def changed_rows(
    table: DataFrame, items: DataFrame, operation: str, key: str, defaults: Mapping[str, Any] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows an ``update`` or ``upsert`` touches as they will be, and the rows it leaves alone."""
    wanted = _cast(items, table).select(column(items, key)).filter(column(items, key).isNotNull()).distinct()
    wanted = _measured(items, wanted)
    touched, others = table.join(wanted, key, "left_semi"), table.join(wanted, key, "left_anti")
    if operation == "upsert":
        return upsert_rows(touched, items, key, defaults), others
    return update_rows(touched, items, key), others


def having(items: DataFrame, key: str) -> Callable[[DataFrame], DataFrame]:
    """The filter that leaves the rows whose ``key`` an item has."""
    def rows(table: DataFrame) -> DataFrame:
        fields = [c for c in table.columns if c in items.columns]
        wanted = _cast(items.select(ORDINAL, *[column(items, c) for c in fields]), table.select(*fields)).select(key)
        wanted = _measured(items, wanted.filter(column(wanted, key).isNotNull()).distinct())
        return table.join(wanted, key, "left_semi")

    return rows


def constraint_errors(
    changed: DataFrame, others: DataFrame, unique: str | Sequence | None = None, not_null: Sequence[str] = (),
    fields: Iterable[str] | None = None,
) -> DataFrame:
    """What the changed rows would break: ``constraint``, ``value`` (JSON of the key, NULL for a missing
    value) and the number of ``rows`` that share it.

    Only keys of changed rows are counted, and of the other rows only those that have one of these.
    ``fields`` are the columns that may have changed; constraints on others hold as before.
    """
    fields = set(changed.columns if fields is None else fields)
    spark, found = changed.sparkSession, []
    for name in not_null:
        if name in fields:
            bad = changed.filter(column(changed, name).isNull()).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 0")
            found.append(bad.select(F.lit(f"not null: {name}").alias("constraint"), F.lit(None).cast("string").alias("value"), "rows"))
    for names in unique_keys(unique):
        if not fields.intersection(names):
            continue
        keys = [column(changed, n) for n in names]
        new = changed.filter(~_any_null(names)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_new"))
        old = others.select(*[column(others, n) for n in names]).join(new.select(*keys), names, "left_semi")
        old = old.groupBy(*keys).agg(F.count(F.lit(1)).alias("_old"))
        both = new.join(old, names, "left").withColumn("rows", F.col("_new") + F.coalesce("_old", F.lit(0)))
        found.append(both.filter("rows > 1").select(
            F.lit(f"unique: {','.join(names)}").alias("constraint"), F.to_json(F.struct(*keys)).alias("value"), "rows"
        ))
    if not found:
        return spark.createDataFrame([], "constraint string, value string, rows long")
    errors = found[0]
    for more in found[1:]:
        errors = errors.unionByName(more)
    return errors


# ---------------------------------------------------------------- delete, truncate

def delete_rows(table: DataFrame, where: Iterable = (), combine: str = "AND") -> DataFrame:
    """The rows that stay: those for which the clauses are FALSE or NULL.

    Without clauses nothing stays.
    """
    hit = where_column(table, where, combine)
    return truncate_rows(table) if hit is None else table.filter(~F.coalesce(hit, F.lit(False)))


def truncate_rows(table: DataFrame) -> DataFrame:
    return table.filter(F.lit(False))


def _each(table: DataFrame, items: DataFrame, where: Iterable, combine: str) -> list[list[tuple]]:
    """Clauses of a delete by items, as groups of which any may match a row."""
    clauses = [tuple(c) for c in where]
    if not clauses:
        raise ValueError("a delete by items needs a condition")
    return [[c] for c in clauses] if combine == "OR" else [clauses]


def delete_each(
    table: DataFrame, items: DataFrame, where: Iterable[tuple[str, str, str]], combine: str = "AND"
) -> DataFrame:
    """The rows that stay after every item deleted the rows for which its clauses are TRUE.

    ``where`` holds ``(column, condition, item column)``. Equality conditions lead to a hash join and range
    conditions to a band join; only what has neither compares rows with all items.
    """
    for clauses in _each(table, items, where, combine):
        if all(c in NULL_CONDITIONS for _, c, _ in clauses):
            hit = combine_columns([condition_column(table, (n, c)) for n, c, _ in clauses])
            table = table.filter(~F.coalesce(hit, F.lit(False))) if has_rows(items, 1) else table
        else:
            table = match_params(table, items, clauses, how="left_anti")
    return table


def hit_each(
    table: DataFrame, items: DataFrame, where: Iterable[tuple[str, str, str]], combine: str = "AND"
) -> DataFrame:
    """Rows that some item of :func:`delete_each` matches; a row may come several times."""
    found = None
    for clauses in _each(table, items, where, combine):
        if all(c in NULL_CONDITIONS for _, c, _ in clauses):
            rows = table.filter(combine_columns([condition_column(table, (n, c)) for n, c, _ in clauses]))
        else:
            rows = match_params(table, items, clauses).select(*[column(table, c) for c in table.columns])
        found = rows if found is None else found.unionByName(rows)
    return found


def affected_by_delete_each(
    table: DataFrame, items: DataFrame, where: Iterable[tuple[str, str, str]], combine: str = "AND"
) -> DataFrame:
    """Per item the number of rows it deletes; a row counts for the first item that matches it.

    The table is written down once, so that its rows can be told apart by file and position.
    """
    rows = stage(table, "delete-table")
    rows = rows.select(*rows.columns, F.struct("_metadata.file_path", "_metadata.row_index").alias("_row"))
    matches = []
    for clauses in _each(table, items, where, combine):
        if all(c in NULL_CONDITIONS for _, c, _ in clauses):
            hit = combine_columns([condition_column(rows, (n, c)) for n, c, _ in clauses])
            first = items.agg(F.min(ORDINAL).alias(ORDINAL)).filter(F.col(ORDINAL).isNotNull())
            matches.append(rows.filter(hit).select("_row").join(F.broadcast(first)))  # one row at most
        else:
            matches.append(match_first(rows, items, clauses, ORDINAL).select("_row", ORDINAL))
    found = matches[0]
    for more in matches[1:]:
        found = found.unionByName(more)
    counts = found.groupBy("_row").agg(F.min(ORDINAL).alias(ORDINAL)).groupBy(ORDINAL).agg(F.count(F.lit(1)).alias("_rows"))
    return summary(items.select(ORDINAL).join(counts, ORDINAL, "left"), F.coalesce("_rows", F.lit(0)).cast("long"))


# ---------------------------------------------------------------- reports

def running_items(items: DataFrame, key: str, chunk: int = HISTORY_CHUNK) -> DataFrame:
    """Every item with, per field, a struct of the last value given up to it (same key).

    A running window over one key would put a hot key into one task. So a key's
    items are cut into runs of ``chunk`` ordinals: windows work within a run, the last
    values of each run are aggregated, and a window over runs carries them on.
    """
    fields = [f for f in item_fields(items) if f != key]
    rows = items.filter(column(items, key).isNotNull()).withColumn(
        "_run", F.floor(F.col(ORDINAL) / F.lit(chunk))
    )
    boxed = {
        f: F.when(given(items, f), F.struct(column(items, f).alias("v"))) for f in fields
    }
    boxes = rows.select(key, ORDINAL, "_run", *[b.alias(f) for f, b in boxed.items()])
    within = Window.partitionBy(key, "_run").orderBy(ORDINAL).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inside = boxes.select(
        key, ORDINAL, "_run", *[F.last(f, ignorenulls=True).over(within).alias(f) for f in fields]
    )
    runs = boxes.groupBy(key, "_run").agg(*[
        F.max_by(f, F.when(F.col(f).isNotNull(), F.col(ORDINAL))).alias(f) for f in fields
    ])
    earlier = Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    carried = runs.select(
        key, "_run", *[F.last(f, ignorenulls=True).over(earlier).alias(f"_c_{f}") for f in fields]
    )
    return inside.join(carried, [key, "_run"]).select(
        key, ORDINAL, *[F.coalesce(f, F.col(f"_c_{f}")).alias(f) for f in fields]
    )


def returning_inserted(image: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Inserted rows with their item ordinal; nothing for an empty column list."""
    return _returned(image, columns)


def returning_updated(
    table: DataFrame, items: DataFrame, match: str, columns: str | Sequence[str]
) -> DataFrame:
    """Each item's rows as they are right after that item."""
    _check_update(items, match)
    history = running_items(_cast(items, table), match)
    after = table.alias("t").join(history.alias("s"), _same_key(match)).select(
        F.col(f"s.{ORDINAL}").alias(ORDINAL), *_overlay(table, history, match)
    )
    return _returned(after, columns)


def returning_upserted(
    table: DataFrame, items: DataFrame, key: str, columns: str | Sequence[str],
    defaults: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Each item's row as it is right after that item."""
    _check_upsert(items, key)
    history = running_items(_cast(items, table), key)
    old = table.withColumn("_old", F.lit(True)).alias("t")
    joined = history.alias("s").join(old, _same_key(key), "left")
    known = F.coalesce(F.col("t._old"), F.lit(False))
    both = zip(
        table.columns, _overlay(table, history, key), _fresh_row(table, history, key, defaults)
    )
    after = joined.select(
        F.col(f"s.{ORDINAL}").alias(ORDINAL),
        *[F.when(known, o).otherwise(n).alias(c) for c, o, n in both],
    )
    return _returned(after, columns)


def _returned(after: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    rows = after.drop(ORDINAL)
    if not parse_output_columns(columns):
        return after.select(ORDINAL).filter(F.lit(False))
    return after.select(ORDINAL, *output_columns(rows, columns))


def summary(items: DataFrame, affected: Column) -> DataFrame:
    return items.select(ORDINAL, F.lit(True).alias("success"), affected.alias("affectedRows"))


def affected_by_update(table: DataFrame, items: DataFrame, match: str) -> DataFrame:
    """Per item the number of table rows it matches, 0 when none."""
    items = _cast(items, table)
    wanted = items.select(match).filter(column(items, match).isNotNull()).distinct()
    counts = _count_keys(table, wanted, [match], items, "_rows")
    joined = items.join(counts, match, "left")
    return summary(joined, F.coalesce("_rows", F.lit(0)).cast("long"))


def affected_by_insert(
    table: DataFrame, items: DataFrame, key: str | Sequence[str] | None = None, **options
) -> DataFrame:
    """Per item 1, or 0 where a skip-on-conflict insert on ``key`` leaves it out."""
    if key is None:
        return summary(items, F.lit(1).cast("long"))
    accepted = accepted_rows(table, items, key, **options).select(ORDINAL, F.lit(1).alias("_in"))
    joined = items.select(ORDINAL).join(accepted, ORDINAL, "left")
    return summary(joined, F.coalesce("_in", F.lit(0)).cast("long"))


def affected_by_upsert(items: DataFrame) -> DataFrame:
    """Every valid upsert item touches exactly one row."""
    return summary(items, F.lit(1).cast("long"))


def affected_by_delete(table: DataFrame, where: Iterable = (), combine: str = "AND") -> DataFrame:
    """One row with the number of rows a delete removes."""
    hit = where_column(table, where, combine)
    gone = table if hit is None else table.filter(hit)
    return gone.agg(F.count(F.lit(1)).alias("affectedRows")).select(
        F.lit(True).alias("success"), "affectedRows"
    )


def item_errors(
    table: DataFrame,
    items: DataFrame,
    operation: str,
    key: str | None = None,
    not_null: Sequence[str] = (),
) -> DataFrame:
    """``items`` plus an ``error`` column: the first reason an item cannot apply, else NULL.

    ``operation`` is ``insert``, ``update`` or ``upsert``. With text fields this also
    finds values that do not convert to the table's type.
    """
    fields = item_fields(items)
    _check_fields(table, fields)
    others = [f for f in fields if f != key]
    has_other = F.lit(False)
    for name in others:
        has_other = has_other | given(items, name)
    checks: list[tuple[Column, Column]] = []
    if operation == "update":
        message = f"Column to match on '{key}' not found in input item"
        checks += [(~given(items, key), F.lit(message)), (~has_other, F.lit(NOTHING_TO_UPDATE))]
    if operation == "upsert":
        message = f"Unique column '{key}' must have a value"
        missing = ~given(items, key)
        if key in fields:
            missing = missing | column(items, key).isNull()
        checks += [(missing, F.lit(message)), (~has_other, F.lit(NOTHING_TO_UPSERT))]
    for name in fields:
        dtype = data_type(table, name)
        if items.schema[name].dataType != dtype:
            value = column(items, name)
            bad = given(items, name) & value.isNotNull() & value.try_cast(dtype).isNull()
            text = F.concat(
                F.lit(f"invalid input syntax for type {dtype.simpleString()}: \""),
                value.cast("string"), F.lit('"'),
            )
            checks.append((bad, text))
    for name in not_null:
        empty = F.lit(True)
        if name in fields:
            empty = ~given(items, name) | column(items, name).isNull()
        text = f'null value in column "{name}" violates not-null constraint'
        checks.append((empty, F.lit(text)))
    error = F.lit(None).cast("string")
    for failed, message in reversed(checks):
        error = F.when(failed, message).otherwise(error)
    return items.withColumn("error", error)


def split_errors(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Continue-on-fail: the items that go on, and ``(ordinal, error)`` of the others."""
    good = checked.filter(F.col("error").isNull()).drop("error")
    bad = checked.filter(F.col("error").isNotNull()).select(ORDINAL, "error")
    return good, bad
