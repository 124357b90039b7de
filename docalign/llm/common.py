"""Helpers of the operators: tables in the shared folder, row identity, text as bytes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; a new local one only where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Stash:
    """Tables written to the shared folder, so that a lost executor costs no earlier stage."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def path(self, name: str = "t") -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def save(self, frame: DataFrame, name: str = "t") -> DataFrame:
        """Write a table and read it back: the plan before it is not needed again."""
        at = self.path(name)
        frame.write.option("compression", "zstd").parquet(at)
        saved = self.spark.read.schema(frame.schema).parquet(at)
        saved.stash_path = at
        return saved

    def drop(self, *frames: DataFrame) -> None:
        """Delete saved tables that no later step reads."""
        for frame in frames:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(frame.stash_path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(*parts: str) -> Column:
    """A hash that tells rows of one id apart; null and '' differ, equal rows share it."""
    return F.xxhash64(*[x for p in parts for x in (F.col(p).isNull(), F.col(p))])


def as_bytes(column: pa.Array) -> Iterator[bytes]:
    """Texts as UTF-8; null becomes the empty text."""
    for value in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()):
        yield value.as_py() or b""
