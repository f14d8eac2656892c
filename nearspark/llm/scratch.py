"""Intermediate tables of one operator run, written to the shared folder and removed when used up."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..sources.staging import new_path

#: How a table is written. Nothing reads the job's shuffle files after it, and small Arrow batches keep what
#: tasks hold of long texts small.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


@contextmanager
def _settings(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    try:
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class Scratch:
    """``put`` writes a table and reads it back, which cuts the lineage at a copy that
    survives lost executors; ``drop`` removes one once nothing reads it any more."""

    def __init__(self, spark, label: str):
        self.spark, self.label = spark, label
        self.paths: dict[int, str] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, f"{self.label}-{name}")
        with _settings(self.spark):
            df.write.parquet(path)
        read = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(read)] = path
        read._scratch = self  # the path lives as long as someone can name it
        return read

    def drop(self, *tables: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df)))
            path.getFileSystem(conf).delete(path, True)
