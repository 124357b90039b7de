"""Runs of tables that count as a whole: a folder per run, and a manifest written last.

A reader takes the newest run that has its manifest. A run that stopped half-way has none and
is never read; what it left is found by ``unfinished_runs``. Runs are not changed after that.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it wants it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def new_run_name() -> str:
    """Names sort by time; two runs of one moment differ."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:12]}"


class Run:
    """A run that is being written."""

    def __init__(self, spark: SparkSession, path: str, name: str | None = None) -> None:
        self.spark, self.root = spark, path.rstrip("/")
        self.name = name or new_run_name()
        self.tables: dict[str, str] = {}

    def add(self, table: str, rows: DataFrame, by: tuple[str, ...] = (), sort: tuple[str, ...] = ()) -> DataFrame:
        """Write one table and return it as it was written.

        ``sort`` orders rows by range, so that a group with most rows is several files; ``by``
        lays files out in folders.
        """
        if sort:
            rows = rows.repartitionByRange(*map(F.col, sort)).sortWithinPartitions(*sort)
        at = f"{self.root}/{self.name}/{table}"
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(at)
        # The schema as a reader gets it: columns of folders come last.
        kept = [f for f in rows.schema if f.name not in by] + [rows.schema[c] for c in by]
        self.tables[table] = json.dumps({"type": "struct", "fields": [f.jsonValue() for f in kept]})
        return self.spark.read.schema(_schema(self.tables[table])).parquet(at)

    def commit(self) -> str:
        """Write the manifest: from now on the run counts."""
        fs, folder = _files(self.spark, f"{self.root}/{MANIFEST}")
        fs.mkdirs(folder)
        hidden = _files(self.spark, f"{self.root}/{MANIFEST}/_{self.name}.{uuid.uuid4().hex}")[1]
        out = fs.create(hidden, True)
        out.write(json.dumps({"run": self.name, "tables": self.tables}).encode())
        out.close()
        final = _files(self.spark, f"{self.root}/{MANIFEST}/{self.name}.json")[1]
        if not fs.rename(hidden, final) and not fs.exists(final):
            raise OSError(f"the manifest of run {self.name} could not be written")
        return self.name


def _schema(text: str):
    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads(text))


def whole_runs(spark: SparkSession, path: str) -> list[str]:
    """Names of the runs that have a manifest, the newest last."""
    fs, folder = _files(spark, f"{path.rstrip('/')}/{MANIFEST}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith(("_", ".")))


def unfinished_runs(spark: SparkSession, path: str) -> list[str]:
    """Folders of runs without a manifest: still being written, or left behind."""
    fs, folder = _files(spark, path.rstrip("/"))
    if not fs.exists(folder):
        return []
    found = {s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()}
    return sorted(found - {MANIFEST} - set(whole_runs(spark, path)))


class ReadRun:
    """The tables of a whole run: the newest one, or the one of a name."""

    def __init__(self, spark: SparkSession, path: str, name: str | None = None) -> None:
        runs = whole_runs(spark, path)
        if not runs or (name is not None and name not in runs):
            raise FileNotFoundError(f"no whole run {name or ''} under {path}")
        self.spark, self.root, self.name = spark, path.rstrip("/"), name or runs[-1]
        fs, at = _files(spark, f"{self.root}/{MANIFEST}/{self.name}.json")
        size = int(fs.getFileStatus(at).getLen())
        stream = fs.open(at)
        self.tables: Mapping[str, str] = json.loads(bytes(stream.readNBytes(size)).decode())["tables"]
        stream.close()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(_schema(self.tables[name])).parquet(f"{self.root}/{self.name}/{name}")


def written_run(spark: SparkSession, path: str, steps: Callable[[Run], None], name: str | None = None) -> ReadRun:
    """Let ``steps`` add the tables of a run, commit it, and open it for reading."""
    run = Run(spark, path, name)
    steps(run)
    return ReadRun(spark, path, run.commit())
