"""Tables whose state is a list of files, kept in a ledger.

Every change writes its new files first and then one ledger entry, which names all files of the new state;
the entry is written aside and renamed, so readers see the state before or after a change and
a failed change leaves no trace in it. An edit finds the files that hold rows it touches and rewrites only
these. One writer at a time; a second one that comes first makes the other's commit fail.

The ledger is as long as the list of files, which the driver holds; rows never pass through it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATA, LEDGER = "data", "_ledger"


class LedgerTable:
    """A table below ``path``; ``create`` makes one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = lambda name: hadoop.Path(f"{self.path}/{name}")
        self._fs = self._path(LEDGER).getFileSystem(spark._jsc.hadoopConfiguration())

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType) -> LedgerTable:
        """The empty table, or the one that is there already."""
        table = cls(spark, path)
        if table.version() < 0:
            table.commit([], schema=schema.jsonValue())
        return table

    # -------------------------------------------------------------- ledger

    def _entries(self) -> list[int]:
        if not self._fs.exists(self._path(LEDGER)):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(self._path(LEDGER))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))

    def version(self) -> int:
        """Number of the newest state, -1 for no table."""
        return max(self._entries(), default=-1)

    def state(self, version: int | None = None) -> dict[str, Any]:
        """What the ledger says of a state, by default the newest."""
        version = self.version() if version is None else version
        stream = self._fs.open(self._path(f"{LEDGER}/{version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, files: list[str], base: int | None = None, **facts) -> int:
        """Make ``files`` the state after version ``base``; facts of the state before stay unless given anew."""
        version = self.version()
        if base is not None and base != version:
            raise RuntimeError(f"the table went on from version {base} to {version} meanwhile")
        entry = {**(self.state(version) if version >= 0 else {}), **facts, "files": sorted(files)}
        aside = self._path(f"{LEDGER}/_{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        final = self._path(f"{LEDGER}/{version + 1:012d}.json")
        if self._fs.exists(final) or not self._fs.rename(aside, final):
            self._fs.delete(aside, False)
            raise RuntimeError(f"version {version + 1} was written by someone else")
        return version + 1

    def vacuum(self, keep: int = 2) -> int:
        """Remove files that none of the newest ``keep`` states names, and older entries; returns how many files."""
        entries = self._entries()
        named = {f for v in entries[-keep:] for f in self.state(v)["files"]}
        gone = [f for f in self._listed(DATA) if f not in named]
        for name in [*(f"{DATA}/{f}" for f in gone), *(f"{LEDGER}/{v:012d}.json" for v in entries[:-keep])]:
            self._fs.delete(self._path(name), False)
        return len(gone)

    # -------------------------------------------------------------- rows

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.state()["schema"])

    def files(self, version: int | None = None) -> list[str]:
        return self.state(version)["files"]

    def read(self, files: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """The rows of a state, or of some of its files."""
        state = self.state(version)
        names = list(state["files"] if files is None else files)
        schema = T.StructType.fromJson(state["schema"])
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{DATA}/{n}" for n in names))

    def _listed(self, folder: str) -> list[str]:
        """Data files below a folder, named from the data folder on."""
        if not self._fs.exists(self._path(folder)):
            return []
        found, names = self._fs.listFiles(self._path(folder), True), []
        while found.hasNext():
            name = found.next().getPath().toString()
            if name.endswith(".parquet"):
                names.append(name.rsplit(f"/{DATA}/", 1)[1])
        return names

    def write(self, rows: DataFrame, folders: str | None = None) -> list[str]:
        """New files with ``rows``, which no state names yet; one folder per value of a column, if asked for."""
        name = uuid.uuid4().hex
        rows = rows.select(*self.schema.names)
        if folders is None:
            rows.write.parquet(f"{self.path}/{DATA}/{name}")
        else:  # the column stays in the files
            rows.withColumn("_folder", F.col(folders)).write.partitionBy("_folder").parquet(f"{self.path}/{DATA}/{name}")
        return self._listed(f"{DATA}/{name}")

    def append(self, rows: DataFrame, **facts) -> int:
        base = self.version()
        return self.commit([*self.files(base), *self.write(rows)], base, **facts)

    def holding(self, hit: Callable[[DataFrame], DataFrame]) -> list[str]:
        """The files that hold rows which ``hit`` leaves; only the columns it looks at are read."""
        rows = self.read()
        if not self.files():
            return []
        named = rows.withColumn("_file", F.col("_metadata.file_path"))
        return [r[0].rsplit(f"/{DATA}/", 1)[1] for r in hit(named).select("_file").distinct().collect()]

    def edit(self, hit: Callable[[DataFrame], DataFrame], change: Callable[[DataFrame], DataFrame], **facts) -> list[str]:
        """Replace the files with rows that ``hit`` leaves by ``change`` of their rows; returns these files.

        ``change`` may add rows, so it is applied even where no file is hit.
        """
        base = self.version()
        touched = self.holding(hit)
        new = self.write(change(self.read(touched)))
        gone = set(touched)
        self.commit([f for f in self.files(base) if f not in gone] + new, base, **facts)
        return touched
