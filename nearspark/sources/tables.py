"""Reading tables, JSON items and Markdown files."""

from __future__ import annotations

import bz2
import gzip
import os
import re
import shutil
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table of a data folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_items(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines, one item per line, by an explicit schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


#: Files and bytes that a task hands on at a time, and files of a folder that the driver lists itself.
BATCH_FILES, BATCH_BYTES, LISTED_FILES = 1000, 16 << 20, 1000
# Characters that a path in a URI is written without.
_QUOTED = re.compile(r'[\x00-\x20"#%<>?\[\\\]^`{|}\x7f]')


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path``: ``(path, text)`` with the whole text.

    Folders of a local (or mounted) file system are listed and read in the tasks with plain calls: Spark's reader
    makes a job context and looks for a checksum file for each of them, and lists them all at the driver.
    """
    folder = local_path(spark, path)
    if folder is None or not os.path.isdir(folder):
        files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
        return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    wanted = 4 * spark.sparkContext.defaultParallelism
    units = _units(folder, wanted)
    slices = max(1, min(len(units), max(wanted, len(units) // 16)))
    work = spark.createDataFrame(units, "folder string, files array<string>").repartition(slices)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit in batch.to_pylist():
                yield from _texts(_files(unit["folder"]) if unit["folder"] is not None else unit["files"])

    found = work.mapInArrow(read, "path string, text binary")
    return found.select("path", F.col("text").cast("string").alias("text"))


def write_markdown(rows: DataFrame, path: str, folders: int) -> None:
    """One file per row of ``(folder, value)``, the value and a line end, in ``folders`` folders below ``path``.

    A task writes whole folders and moves them to their place when they are complete, so a repeated task changes
    nothing. On a local (or mounted) file system that is done with plain calls: without its native library
    Hadoop starts a process for the permissions of each file, and writes a checksum file beside it.
    """
    target = local_path(rows.sparkSession, path)
    placed = rows.repartition(folders, "folder")
    if target is None:
        placed.write.option("maxRecordsPerFile", 1).partitionBy("folder").text(path)
        return
    os.makedirs(target)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = os.path.join(target, f"_{uuid.uuid4().hex}"), {}
        for batch in batches:
            for folder, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if folder not in counts:
                    os.makedirs(os.path.join(own, f"folder={folder}"))
                counts[folder] = number = counts.get(folder, -1) + 1
                with open(os.path.join(own, f"folder={folder}", f"part-{number:06}.txt"), "xb", 0) as file:
                    file.write(value.as_py() + b"\n")
        for folder in counts:
            try:
                os.rename(os.path.join(own, f"folder={folder}"), os.path.join(target, f"folder={folder}"))
            except OSError:
                if not os.path.isdir(os.path.join(target, f"folder={folder}")):
                    raise  # otherwise an earlier attempt of this task has put it there
        shutil.rmtree(own, ignore_errors=True)
        yield pa.RecordBatch.from_pydict({"files": pa.array([sum(counts.values()) + len(counts)], pa.int64())})

    placed.select("folder", F.col("value").cast("binary")).mapInArrow(write, "files long").agg(F.sum("files")).collect()


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path on a local file system that ``path`` stands for; None for others and for patterns."""
    if any(c in path for c in "*?[]{}\\"):
        return None
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    uri = found.getFileSystem(conf).makeQualified(found).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _shown(folder: str) -> Iterator[os.DirEntry]:
    """Entries of a folder that Spark's readers see: nothing hidden."""
    with os.scandir(folder) as entries:
        for e in entries:
            if not (e.name[0] == "." or e.name[0] == "_" and "=" not in e.name or e.name.endswith("._COPYING_")):
                yield e


def _units(folder: str, wanted: int) -> list[tuple[str | None, list[str] | None]]:
    """Folders, and parts of the files beside them; it goes down until there are as many as wanted."""
    folders, loose = [folder], []
    while folders and len(folders) + len(loose) // LISTED_FILES < wanted:
        deeper = []
        for at in folders:
            for e in _shown(at):
                (deeper if e.is_dir() else loose).append(e.path)
        folders = deeper
    size = max(1, min(LISTED_FILES, -(-len(loose) // wanted)))
    parts = [loose[at : at + size] for at in range(0, len(loose), size)]
    return [*[(f, None) for f in folders], *[(None, part) for part in parts]]


def _files(folder: str) -> Iterator[str]:
    for e in _shown(folder):
        if e.is_dir():
            yield from _files(e.path)
        else:
            yield e.path


def _texts(files: Iterable[str]) -> Iterator[pa.RecordBatch]:
    """Path and content of the files, but the empty ones, in batches."""
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(texts, pa.binary())], names=["path", "text"])

    paths, texts, size = [], [], 0
    for at in files:
        with open(at, "rb", 0) as file:
            text = file.read()
        if not text:
            continue
        paths.append("file:" + _QUOTED.sub(lambda m: quote(m[0], safe=""), at))
        texts.append(_unpacked(at, text))
        size += len(texts[-1])
        if len(texts) >= BATCH_FILES or size >= BATCH_BYTES:
            yield batch()
            paths, texts, size = [], [], 0
    if texts:
        yield batch()


def _unpacked(path: str, content: bytes) -> bytes:
    """Compressed files are known by their names."""
    unpack = {".gz": gzip.decompress, ".bz2": bz2.decompress, ".deflate": zlib.decompress}.get(os.path.splitext(path)[1])
    return unpack(content) if unpack else content


def describe_table(df: DataFrame) -> DataFrame:
    """``column_name, data_type, is_nullable`` with the position of each column.

    Built from the schema only; no row of the table is read.
    """
    rows = [
        (i, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO")
        for i, f in enumerate(df.schema, start=1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "ordinal_position int, column_name string, data_type string, is_nullable string"
    )
