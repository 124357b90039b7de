"""Text file scans shared by the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from docalign.functions.text import file_stem


def scan_text(
    reader: DataFrameReader | DataStreamReader,
    path: str | list[str],
    pattern: str | None = "*.json",
    whole: bool = True,
    recursive: bool = False,
    profile: str | None = None,
) -> DataFrame:
    """Files as rows ``profile, source_file, stem, content``.

    ``whole`` makes one row per file, else one row per line. Without
    ``profile`` the column is null, which means "all profiles".
    """
    reader = reader.option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path, wholetext=whole).select(
        F.lit(profile).cast("string").alias("profile"),
        F.col("_metadata.file_path").alias("source_file"),
        file_stem(F.col("_metadata.file_name")).alias("stem"),
        F.col("value").alias("content"),
    )

