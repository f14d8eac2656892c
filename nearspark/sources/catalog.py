"""Vector and business tables in the session catalog.

A table's state is a folder of files. Edits write the new state to a fresh folder
and then move the table's location there, so a failed job leaves the table as it
was, and readers see the old or the new state but no mixture. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import quote_ident, quote_table
from ..operators.ingest import vector_schema

DEFAULT_SCHEMA = "public"
LAST_ID = "nearspark.last_id"
DIMS = "nearspark.dims"
VERSIONS = "_versions"
#: Folder of the table's approximate index, and the last row id that is in it.
INDEX = "nearspark.index"
INDEXED_ID = "nearspark.indexed_id"
INDEXES = "_indexes"


def full_name(name: str, schema: str | None = None) -> str:
    """Quoted ``schema.table``; the schema defaults to ``public``."""
    if schema is None and "." not in name:
        schema = DEFAULT_SCHEMA
    return quote_table(name, schema)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(full_name(name))


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, if_not_exists: bool = False
) -> None:
    """An empty table; an existing one is an error unless ``if_not_exists``."""
    if table_exists(spark, name):
        if if_not_exists:
            return
        raise ValueError(f'relation "{name}" already exists')
    target = full_name(name)
    database = target.rsplit(".", 1)[0]
    if database == quote_ident(DEFAULT_SCHEMA):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.createDataFrame([], schema).write.format("parquet").saveAsTable(target)


def create_vector_table(
    spark: SparkSession, name: str, dims: int, if_not_exists: bool = False
) -> None:
    if if_not_exists and table_exists(spark, name):
        return
    create_table(spark, name, vector_schema(dims))
    set_property(spark, name, DIMS, str(dims))
    set_property(spark, name, LAST_ID, "0")


def ensure_vector_table(
    spark: SparkSession, name: str, dims: int | None, vectors: DataFrame | None = None
) -> int:
    """Create the table if it is missing; the length comes from ``dims`` or a first vector."""
    if table_exists(spark, name):
        known = get_property(spark, name, DIMS)
        if known:
            return int(known)
    if not dims and vectors is not None:
        first = vectors.select(F.size("embedding").alias("n")).first()
        dims = first.n if first is not None and first.n > 0 else None
    if not dims:
        raise ValueError(
            'Vector dimensions unknown. Set the "dimensions" parameter or ensure the '
            "embedding model returns vectors."
        )
    create_vector_table(spark, name, dims, if_not_exists=True)
    return int(dims)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop the table, with all of its versions, if it exists."""
    if table_exists(spark, name):
        # back to the table's own folder, which is what a drop clears
        spark.sql(f"ALTER TABLE {full_name(name)} SET LOCATION '{home(spark, name)}'")
    spark.sql(f"DROP TABLE IF EXISTS {full_name(name)}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    if not table_exists(spark, name):
        raise ValueError(f'relation "{name}" does not exist')
    return spark.table(full_name(name))


def get_property(spark: SparkSession, name: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {full_name(name)}").filter(F.col("key") == key)
    found = rows.first()
    return found["value"] if found else None


def set_property(spark: SparkSession, name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {full_name(name)} SET TBLPROPERTIES ('{key}' = '{value}')")


def drop_property(spark: SparkSession, name: str, key: str) -> None:
    spark.sql(f"ALTER TABLE {full_name(name)} UNSET TBLPROPERTIES IF EXISTS ('{key}')")


def location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name(name)}")
    return rows.filter(F.col("col_name") == "Location").first()["data_type"]


def home(spark: SparkSession, name: str) -> str:
    """The table's own folder; edited states lie below it."""
    return location(spark, name).split(f"/{VERSIONS}/")[0].rstrip("/")


def append(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Add rows in one job, which commits all of its files or none."""
    target = spark.table(full_name(name))
    rows.select(*target.columns).write.insertInto(full_name(name))


def replace(spark: SparkSession, name: str, state: DataFrame) -> None:
    """Make ``state`` the content of the table; it may be derived from the table itself.

    An index knows nothing of changed rows, so the table loses it.
    """
    path = f"{home(spark, name)}/{VERSIONS}/{uuid.uuid4().hex}"
    target = spark.table(full_name(name))
    state.select(*target.columns).write.parquet(path)
    drop_property(spark, name, INDEX)
    spark.sql(f"ALTER TABLE {full_name(name)} SET LOCATION '{path}'")
    spark.catalog.refreshTable(full_name(name))


def edit(spark: SparkSession, name: str, change: Callable[[DataFrame], DataFrame]) -> None:
    """Apply a state-to-state function and swap the result in."""
    replace(spark, name, change(read_table(spark, name)))


def truncate(spark: SparkSession, name: str, restart_identity: bool = False) -> None:
    """Empty the table; ids go on counting unless ``restart_identity``."""
    edit(spark, name, lambda df: df.filter(F.lit(False)))
    if restart_identity:
        set_property(spark, name, LAST_ID, "0")
