"""The whole transformation of a document, as one chain of projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.operators.config import Config
from docalign.operators.diff import diff_documents
from docalign.operators.fields import rename_fields
from docalign.operators.nested_diff import diff_nested
from docalign.operators.rules import apply_rules
from docalign.operators.schema import conform_to_schema
from docalign.operators.values import standardize_values

# Types of the log columns, for phases that are left out.
LOG_TYPES = {
    "field_mappings": "array<struct<legacy:string,target:string>>",
    "value_mappings": "array<struct<field:string,old:string,kind:string,text:string>>",
    "ambiguous_mappings": f"array<struct<field:string,kind:string,text:string,options:array<{C.VALUE}>>>",
    "excluded_data": C.CELLS,
}


def harmonize(
    documents: DataFrame,
    rules: Config | None = None,
    field_map: Config | None = None,
    value_map: Config | None = None,
    schema: Config | None = None,
    lookup: str | None = None,
) -> DataFrame:
    """Update, rename, standardize and conform, in this order.

    What is not given is skipped. The result has ``modified_metadata`` and the
    log columns next to the original ``metadata``. Documents stay in their
    partitions: there is no exchange, unless a table is joined (``lookup``, see
    ``operators.config``).
    """
    result = documents.withColumn("modified_metadata", F.col("metadata"))
    if rules is not None:
        result = apply_rules(result, rules, lookup=lookup)
    if field_map is not None:
        result = rename_fields(result, field_map, lookup=lookup)
    if value_map is not None:
        result = standardize_values(result, value_map, lookup=lookup)
    if schema is not None:
        result = conform_to_schema(result, schema, lookup=lookup)
    for name, log_type in LOG_TYPES.items():
        if name not in result.columns:
            result = result.withColumn(name, F.array().cast(log_type))
    return result


def processing_log() -> Column:
    """The log columns as one struct, in the order of the output document."""
    return F.struct(*LOG_TYPES)


def log_entries() -> Column:
    """How many entries the log of a document has."""
    sizes = [F.size(n) for n in LOG_TYPES]
    return sizes[0] + sizes[1] + sizes[2] + sizes[3]


def output_documents(harmonized: DataFrame, nested: bool = False) -> DataFrame:
    """Add the diff and fold the log columns, ready for ``write_documents``.

    With ``nested`` the diff goes down into nested values, see ``operators.nested_diff``.
    """
    logged = harmonized.withColumn("processing_log", processing_log()).drop(*LOG_TYPES)
    return diff_nested(logged) if nested else diff_documents(logged)


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Files, successes, failures, objects and log entries of a run."""
    return outcomes.agg(
        F.count("*").alias("files"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.sum("objects_processed").cast("bigint").alias("objects_processed"),
        F.sum("log_entries").cast("bigint").alias("log_entries"),
    )
