"""Unfolding arrays and choosing rows without repeating expensive columns.

For ``explode`` of a column the optimizer adds a filter on its size; that filter,
like any other, then moves down through every projection below it and brings
the expressions of these projections along, so they are evaluated twice. The
two functions here keep such expressions where they are. Filters on plain
columns of a table need none of this and still reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unfold(
    rows: DataFrame, keep: Sequence[str | Column], array: str | Column, name: str, position: str | None = None
) -> DataFrame:
    """One row per array element, with the columns of ``keep``."""
    made = F.explode_outer(array).alias(name) if position is None else F.posexplode_outer(array).alias(position, name)
    return rows.select(*keep, made).where(F.col(name).isNotNull())


def rows_where(rows: DataFrame, condition: Column) -> DataFrame:
    """``rows.where(condition)`` for a condition on computed columns."""
    columns = [F.col(c) for c in rows.columns]
    return rows.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))
