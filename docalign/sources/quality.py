"""Writing the results of the quality checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docalign.operators.config import Config
from docalign.operators.quality import (
    ISSUE_TYPES,
    group_summary,
    issue_rows,
    nonstandard_values,
    quality_counts,
)
from docalign.operators.review import choice_lists, review_rows
from docalign.sources.runs import ReadRun, Run, written_run


def write_quality_run(
    checked: DataFrame,
    schema: Config,
    path: str,
    base_url: str,
    hints: Mapping[str, str] | None = None,
    name: str | None = None,
) -> ReadRun:
    """Write everything a review needs as one run under ``path``, and open that run.

    ``checked`` (the issues of every document) is written first and all else is made from that
    table: ``nonstandard_values``, ``counts``, ``summary``, ``choices`` and a table per issue type,
    ``review_<type>``. A run counts once its manifest is there: readers (``runs.ReadRun``) see all
    tables of the newest whole run, or none of a run that failed.
    """

    def steps(run: Run) -> None:
        head = [c for c in ("profile", "record_id", "group_name", "dataset_type") if c in checked.columns]
        kept = [F.filter("head", lambda c: c["field"].isin("group_name", "dataset_type")).alias("head")]
        stored = run.add("checked", checked.select(*head, *(kept if "head" in checked.columns else []), *ISSUE_TYPES))
        issues = issue_rows(stored)
        run.add("nonstandard_values", nonstandard_values(stored), sort=("field", "value"))
        run.add("counts", quality_counts(stored))
        run.add("summary", group_summary(stored), sort=("group_slug",))
        run.add("choices", choice_lists(issues, schema), sort=("group_slug", "col_no", "row_no"))
        for issue_type in ISSUE_TYPES:
            rows = review_rows(issues, issue_type, base_url, hints)
            run.add(f"review_{issue_type}", rows, sort=("group_slug", "dataset_id", "field_name"))

    return written_run(checked.sparkSession, path, steps, name)


def write_quality(
    checked: DataFrame,
    schema: Config,
    path: str,
    base_url: str,
    hints: Mapping[str, str] | None = None,
    mode: str = "error",
) -> None:
    """Write everything a review needs under ``path``.

    ``checked`` (the issues of every document) comes first, as a table: all else
    is made from that table, so the documents are transformed once. Then
    ``nonstandard_values`` and ``summary`` (sorted by range), ``counts``, ``choices``, and per issue
    type ``review/<type>``, with one folder per group and rows sorted by document
    and field. The sort is by range of both, so a group that holds most issues
    is spread over several tasks and files.
    """
    spark = checked.sparkSession
    head = [c for c in ("profile", "record_id", "group_name", "dataset_type") if c in checked.columns]
    # Of the heads only what says whether a document counts is stored.
    kept = [F.filter("head", lambda c: c["field"].isin("group_name", "dataset_type")).alias("head")]
    checked.select(*head, *(kept if "head" in checked.columns else []), *ISSUE_TYPES).write.mode(mode).parquet(f"{path}/checked")
    stored = spark.read.parquet(f"{path}/checked")
    issues = issue_rows(stored)
    nonstandard_values(stored).orderBy("field", "value").write.mode(mode).json(f"{path}/nonstandard_values")
    quality_counts(stored).write.mode(mode).json(f"{path}/counts")
    group_summary(stored).orderBy("group_slug").write.mode(mode).json(f"{path}/summary")
    choice_lists(issues, schema).write.mode(mode).partitionBy("group_slug").json(f"{path}/choices")
    for issue_type in ISSUE_TYPES:
        rows = review_rows(issues, issue_type, base_url, hints)
        keys = [F.col(c) for c in ("group_slug", "dataset_id", "field_name")]
        (
            rows.repartitionByRange(*keys)
            .sortWithinPartitions(*keys)
            .write.mode(mode)
            .partitionBy("group_slug")
            .json(f"{path}/review/{issue_type}")
        )
