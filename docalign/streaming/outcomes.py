"""A stream that keeps documents, dead letters and run rows apart, whole batch by whole batch.

Every batch is written to folders of its own, ``stream=<query>/batch=<number>``: first all
outcomes in one pass, laid out by status, then one run row, which is computed from what was
written. A batch that is repeated after a failure replaces itself; readers take only batches
that have a run row, so what a batch left half-way is never read. Streams with checkpoints of
their own may write below one path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docalign.plans.harmonize import LOG_TYPES, run_summary
from docalign.sources.documents import document_json, file_outcomes
from docalign.sources.runs import _files

OUTCOME = "input_file string, output_file string, error string, objects_processed int, log_entries int, document string"
TOTALS = "files long, successful long, failed long, objects_processed long, log_entries long"
KEYS = "stream string, batch long"


def write_outcome_stream(documents: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write output documents, dead letters and run rows for all files there are, then stop.

    ``documents`` is a streaming result of ``output_documents``, or of parsing alone, with its
    ``error``. ``path`` and ``checkpoint`` must be on storage that all executors share.
    """
    entries = None
    if "processing_log" in documents.columns:
        sizes = [F.size(F.col("processing_log")[name]) for name in LOG_TYPES]
        entries = sum(sizes[1:], sizes[0])
    document = F.when(F.col("error").isNull(), document_json(documents)).alias("document")
    outcomes = file_outcomes(documents, entries, document)

    def write(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_batch(batch, path.rstrip("/"), f"stream={stream}/batch={number}")

    writer = outcomes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def write_batch(outcomes: DataFrame, path: str, place: str) -> None:
    """Replace one batch: it does not count until its run row is written again."""
    spark = outcomes.sparkSession
    fs, row = _files(spark, f"{path}/runs/{place}")
    fs.delete(row, True)
    outcomes.write.mode("overwrite").partitionBy("status").parquet(f"{path}/outcomes/{place}")
    written = spark.read.schema(f"{OUTCOME}, status string").parquet(f"{path}/outcomes/{place}")
    run_row(written).write.mode("overwrite").parquet(f"{path}/runs/{place}")


def run_row(outcomes: DataFrame) -> DataFrame:
    """The counts of one batch; texts are not read for them."""
    return run_summary(outcomes)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    fs, at = _files(spark, path)
    return spark.read.schema(schema).parquet(path) if fs.exists(at) else spark.createDataFrame([], schema)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row of counts for each whole batch, with ``stream`` and ``batch``."""
    return _table(spark, f"{path.rstrip('/')}/runs", f"{TOTALS}, {KEYS}")


def _outcomes(spark: SparkSession, path: str, status: str) -> DataFrame:
    found = _table(spark, f"{path.rstrip('/')}/outcomes", f"{OUTCOME}, {KEYS}, status string")
    # Folders of the other status are not listed as input; whole batches are told by their run rows.
    return found.where(F.col("status") == status).join(read_runs(spark, path).select("stream", "batch"), ["stream", "batch"], "left_semi")


def read_output_documents(spark: SparkSession, path: str) -> DataFrame:
    """``stream, batch, input_file, output_file, document`` of whole batches."""
    return _outcomes(spark, path, "success").select("stream", "batch", "input_file", "output_file", "document")


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """``stream, batch, input_file, status, error`` of whole batches."""
    return _outcomes(spark, path, "failed").select("stream", "batch", "input_file", "status", "error")


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all whole batches together, as of one run."""
    names = [c.split()[0] for c in TOTALS.split(", ")]
    return read_runs(spark, path).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
