"""Continuous upsert of a stream of items into a keyed table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.edits import ORDINAL, upsert_rows
from ..sources.ledger import LedgerTable
from ..sources.staging import stage, unstage

BUCKET = "bucket"


class KeyedTable:
    """A table split into ``buckets`` by a hash of its key, each with files of its own.

    A batch rewrites only the buckets its keys fall into. The hash spreads keys
    evenly, and the key is unique, so no bucket outgrows the others; choose the
    number of buckets so that one is about a gigabyte. All buckets of a batch become visible together,
    by one entry of the table's ledger, which also says which batches of a stream are in.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str, order: str,
        buckets: int = 64,
    ):
        self.spark, self.path, self.key, self.order = spark, path, key, order
        self.buckets = buckets
        self.schema = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        self.table = LedgerTable.create(spark, path, self.schema)

    def read(self) -> DataFrame:
        """The rows after the last whole batch."""
        return self.table.read()

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def upsert(self, batch: DataFrame, batch_id: int | None = None, stream: str | None = None) -> None:
        """Bring in a micro-batch; per key the row with the greatest ``order`` stays.

        The batch is written down first, as it is read several times. A batch of a ``stream`` that is in
        already changes nothing, and a failed one leaves the table as it was. An item without a key
        fails its batch.
        """
        base = self.table.version()
        done = self.table.state(base).get("streams", {})
        if stream is not None and done.get(stream, -1) >= batch_id:
            return
        items = batch.withColumn(ORDINAL, F.col(self.order)).withColumn(BUCKET, self._bucket())
        items = stage(items, "stream-batch")
        lost = items.filter(F.col(self.key).isNull()).limit(1).count()
        if lost:
            raise ValueError(f"Unique column '{self.key}' must have a value")
        touched = {r[0] for r in items.select(BUCKET).distinct().collect()}  # at most `buckets`
        facts = {} if stream is None else {"streams": {**done, stream: batch_id}}
        files = self.table.files(base)
        old = [f for f in files if int(re.search(r"/_folder=(\d+)/", f)[1]) in touched]
        if touched:
            current = self.table.read(old, base)
            known = current.select(self.key, F.col(self.order).alias("_known"))
            fresh = items.join(known, self.key, "left").filter(
                F.col("_known").isNull() | (F.col(self.order) >= F.col("_known"))
            ).drop("_known")
            new = self.table.write(upsert_rows(current, fresh, self.key).hint("rebalance", BUCKET), BUCKET)
            files = [f for f in files if f not in set(old)] + new
        if touched or facts:
            self.table.commit(files, base, **facts)
            self.table.vacuum()
        unstage(items)


def stream_upsert(
    items: DataFrame, table: KeyedTable, checkpoint: str | None = None
) -> StreamingQuery:
    """Upsert everything the streaming frame ``items`` has to offer now, then stop.

    Progress is kept in ``checkpoint``, by default a folder of the table, so the next call goes on where this
    one ended. Streams of different sources need checkpoints of their own.
    """
    checkpoint = checkpoint or f"{table.path}/_progress"
    return (
        items.writeStream.foreachBatch(lambda batch, batch_id: table.upsert(batch, batch_id, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
