"""Review lists: what a curator has to decide, per group."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docalign.functions.lookup import constant_lookup
from docalign.operators.config import Config, is_joined, profiles_of, scoped_lookup
from docalign.operators.joins import with_scope
from docalign.operators.membership import schema_table
from docalign.operators.quality import ISSUE_TYPES, MISSING, REGEX, schema_facets
from docalign.functions.cells import VALUE


def review_rows(
    issues: DataFrame,
    issue_type: str,
    base_url: str,
    hints: Mapping[str, str] | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Rows of one review list, ``new_value`` still empty.

    Columns follow the type: missing values have no ``current_value``, patterns
    have an ``expected_input_hint``. ``ordered`` sorts by group, document and
    field; that is one more exchange, so a large list is better sorted within
    the files of its group, as ``write_quality`` does.
    """
    if issue_type not in ISSUE_TYPES:
        raise ValueError(f"unknown issue type: {issue_type}")
    profile = ["profile"] if "profile" in issues.columns else []
    keys = [*profile, "group_slug", "record_id", "field"]
    rows = (
        issues.where(F.col("issue_type") == issue_type)
        .groupBy(*keys)
        .agg(F.min("value").alias("value"))
    )
    columns = [*profile, "group_slug", F.col("record_id").alias("dataset_id"), F.col("field").alias("field_name")]
    if issue_type != MISSING:
        columns.append(F.col("value").alias("current_value"))
    columns.append(F.lit("").alias("new_value"))
    if issue_type == REGEX:
        hint = constant_lookup((((k,), v) for k, v in (hints or {}).items()), "string")
        columns.append(F.coalesce(hint(F.col("field")), F.lit("")).alias("expected_input_hint"))
    columns.append(F.concat(F.lit(base_url), F.col("record_id")).alias("dataset_url"))
    listed = rows.select(*columns)
    return listed.orderBy(*profile, "group_slug", "dataset_id", "field_name") if ordered else listed


def choice_lists(issues: DataFrame, schema: Config, lookup: str | None = None) -> DataFrame:
    """Allowed values per group, for its fields with issues that have a list.

    Fields are numbered from 1 in name order, values from 1 in schema order. The
    window sees distinct fields only, so a group is never larger than a schema.
    ``lookup`` is "constant" or "join", see ``operators.config``.
    """
    profile = ["profile"] if "profile" in issues.columns else []
    fields = issues.select(*profile, "group_slug", "field")
    if is_joined(schema, lookup):
        scoped, table = with_scope(fields.distinct(), schema_table(issues, schema))
        lists = table.where(F.size("permissible") > 0).select("_scope", F.col("name").alias("field"), F.col("permissible").alias("values"))
        listed = scoped.join(lists, ["_scope", "field"]).drop("_scope")
    else:
        facets = [r for r in schema_facets(schema) if r["permissible"]]
        find = scoped_lookup(
            ((r["profile"], (r["name"],), r["permissible"]) for r in facets), f"array<{VALUE}>", profiles_of(facets)
        )
        limited = fields.where(find(F.col("field")).isNotNull()).distinct()
        listed = limited.withColumn("values", find(F.col("field")))
    by_group = Window.partitionBy(*profile, "group_slug").orderBy("field")
    return (
        listed.withColumn("col_no", F.dense_rank().over(by_group))
        .select(*profile, "group_slug", "field", "col_no", F.posexplode("values").alias("pos", "v"))
        .select(
            *profile,
            "group_slug",
            "field",
            "col_no",
            (F.col("pos") + 1).alias("row_no"),
            F.col("v.kind").alias("kind"),
            F.col("v.text").alias("value"),
        )
    )
