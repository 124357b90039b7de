"""The same transformation on a folder that keeps receiving files.

All operators from reading to the diff are row-local, so they accept a streaming
DataFrame as it is: no state, no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docalign.sources.documents import document_json, parse_documents
from docalign.sources.files import scan_text


def read_document_stream(
    spark: SparkSession,
    path: str,
    profile: str | None = None,
    id_field: str = "record_id",
    files_per_batch: int = 10_000,
) -> DataFrame:
    """New ``*.json`` files of a folder as documents."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return parse_documents(scan_text(reader, path, profile=profile), id_field)


def write_document_stream(documents: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append output documents for all files there are, then stop.

    ``checkpoint`` must be on storage that all executors share; a restart goes
    on after the last finished batch and writes no document twice.
    """
    rows = documents.select("source_file", "error", F.when(F.col("error").isNull(), document_json(documents)).alias("document"))
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
