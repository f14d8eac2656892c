"""Written intermediate tables in the folder the cluster names for checkpoints.

A staged table survives the loss of executors and has a fixed file layout, which
is what dense id assignment and the table swap rely on.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder; on a
    cluster a machine-local folder would not be shared, so that is an error.
    """
    root = spark.conf.get(CHECKPOINT_DIR, "") or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="nearspark-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh location below the staging root."""
    return f"{staging_root(spark).rstrip('/')}/nearspark/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a reader over the written files."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged = path
    return staged


def unstage(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._staged)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
