"""Quality checks on harmonized bodies, and their aggregates.

The checks are row-local: each adds an array column, so all of them run in the
scan of the documents. Only the aggregates shuffle, after partial aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.functions.rows import rows_where, unfold
from docalign.functions.text import group_slug, is_blank, java_pattern, matches_whole
from docalign.operators.config import Config, Rows, constant_rows, is_joined, profiles_of, scoped_lookup
from docalign.operators.joins import attach_schema
from docalign.operators.membership import nonpermissible_by_join, regex_by_join
from docalign.operators.schema import permissible_lookups

NONPERMISSIBLE, MISSING, REGEX = "non_permissible", "missing_required", "regex_violations"
ISSUE_TYPES = (NONPERMISSIBLE, MISSING, REGEX)


def schema_facets(schema: Config) -> Rows:
    """What the checks use of each field: list, strict requirement, pattern.

    A pattern that is empty or invalid does not count; an empty list does, and
    makes every value non-standard.
    """
    return [
        {
            "profile": r["profile"],
            "name": r["name"],
            "permissible": r["permissible"],
            "required": r["required_strict"],
            "pattern": java_pattern(r["regex"]) if r["regex"] else None,
        }
        for r in sorted(constant_rows(schema), key=lambda r: r["pos"])
    ]


def _issue(field: Column, value: Column) -> Column:
    return F.struct(field.alias("field"), value.alias("value"))


def _printed(cells: Column) -> Column:
    """Cells, each with the text Python prints for its value: costly, so only for those that are asked for."""
    def one(c: Column) -> Column:
        printed = C.python_text(c["kind"], c["text"])
        return F.struct(
            c["field"].alias("field"), c["kind"].alias("kind"), c["text"].alias("text"), printed.alias("printed")
        )

    return F.transform(cells, one)


def find_nonpermissible(
    documents: DataFrame, schema: Config, body: str = "modified_metadata", into: str = NONPERMISSIBLE, lookup: str | None = None
) -> DataFrame:
    """Values that are not on their field's list, neither as text nor by value.

    Only null is skipped; '' is a value like any other.
    """
    if is_joined(schema, lookup):
        return nonpermissible_by_join(documents, schema, body, into)
    limited, member = permissible_lookups(schema_facets(schema), by_text=True)

    def wrong(c: Column) -> Column:
        return ~member(c["field"], F.lit(""), c["printed"]) & ~member(c["field"], c["kind"], c["text"])

    asked = F.filter(F.col(body), lambda c: (c["kind"] != "null") & limited(c["field"]))
    found = F.transform(F.filter(_printed(asked), wrong), lambda c: _issue(c["field"], c["printed"]))
    return documents.withColumn(into, found)


def find_missing_required(
    documents: DataFrame, schema: Config, body: str = "modified_metadata", into: str = MISSING, lookup: str | None = None
) -> DataFrame:
    """Required fields that are absent, null, blank or empty, with a marker."""
    if is_joined(schema, lookup):
        documents, attached = attach_schema(documents, schema)
        added = [attached]
        needed = F.transform(F.filter(F.col(attached), lambda f: f["required_strict"]), lambda f: f["name"])
    else:
        facets = schema_facets(schema)
        required: dict[str | None, list[str]] = {r["profile"]: [] for r in facets}
        for r in facets:
            if r["required"]:
                required[r["profile"]].append(r["name"])
        needed = scoped_lookup(
            ((p, ("",), names) for p, names in required.items()), "array<string>", profiles_of(facets)
        )(F.lit(""))
        added = []
    context = F.struct(
        C.by_name(F.col(body)).alias("by_name"),
        F.coalesce(needed, F.array().cast("array<string>")).alias("required"),
    )

    def marker(c: Column) -> Column:
        return (
            F.when(c.isNull(), F.lit("MISSING_FIELD"))
            .when(c["kind"] == "null", F.lit("null"))
            .when((c["kind"] == "string") & is_blank(c["text"]), F.lit(""))
            .when((c["kind"] == "array") & (c["text"] == "[]"), F.lit("[]"))
            .when((c["kind"] == "object") & (c["text"] == "{}"), F.lit("{}"))
        )

    def one(x: Column, field: Column) -> Column:
        mark = marker(F.try_element_at(x["by_name"], field))
        return F.when(mark.isNotNull(), _issue(field, mark))

    found = C.let(
        context, lambda x: F.array_compact(F.transform(x["required"], lambda f: one(x, f)))
    )
    return documents.withColumn(into, F.when(F.col(body).isNotNull(), found)).drop(*added)


def find_regex_violations(
    documents: DataFrame, schema: Config, body: str = "modified_metadata", into: str = REGEX, lookup: str | None = None
) -> DataFrame:
    """Values that their field's pattern does not cover; blanks are skipped.

    As constants, every distinct pattern is compiled once per task; joined, patterns are
    data, of any number (``membership``; ``uncheckable_patterns`` names those left out).
    """
    if is_joined(schema, lookup):
        return regex_by_join(documents, schema, body, into)
    facets = schema_facets(schema)
    patterns = sorted({r["pattern"] for r in facets if r["pattern"]})
    number = {p: i for i, p in enumerate(patterns)}
    find = scoped_lookup(
        ((r["profile"], (r["name"],), number[r["pattern"]]) for r in facets if r["pattern"]),
        "int",
        profiles_of(facets),
    )
    if not patterns:
        none = F.array().cast("array<struct<field:string,value:string>>")
        return documents.withColumn(into, none)

    def broken(c: Column) -> Column:
        text, which = c["printed"], find(c["field"])
        first = F.when(which == 0, ~matches_whole(text, patterns[0]))
        case = reduce(
            lambda w, i: w.when(which == i, ~matches_whole(text, patterns[i])), range(1, len(patterns)), first
        )
        return F.coalesce(case & ~is_blank(text), F.lit(False))

    asked = F.filter(F.col(body), lambda c: (c["kind"] != "null") & find(c["field"]).isNotNull())
    found = F.transform(F.filter(_printed(asked), broken), lambda c: _issue(c["field"], c["printed"]))
    return documents.withColumn(into, found)


def check_quality(
    documents: DataFrame, schema: Config, body: str = "modified_metadata", lookup: str | None = None
) -> DataFrame:
    """All three checks, one array column each.

    With a schema that is joined, documents are scanned several times: hand in a table that
    was written, not a plan that computes them.
    """
    checked = find_nonpermissible(documents, schema, body, lookup=lookup)
    checked = find_missing_required(checked, schema, body, lookup=lookup)
    return find_regex_violations(checked, schema, body, lookup=lookup)


def with_group(documents: DataFrame) -> DataFrame:
    """Fill the head fields used for grouping, and add ``group_slug``."""
    filled = documents
    for name, default in (
        ("record_id", "UNKNOWN"),
        ("group_name", "Unknown Group"),
        ("dataset_type", "Unknown"),
    ):
        filled = filled.withColumn(name, F.coalesce(name, F.lit(default)))
    return filled.withColumn("group_slug", group_slug(F.col("group_name"), F.col("dataset_type")))


def countable(documents: DataFrame) -> Column:
    """False for documents whose group or type is JSON null: no group can be named for them.

    They are left out of all aggregates. An absent group or type has a default.
    """
    if "head" not in documents.columns:
        return F.lit(True)
    nulls = F.filter("head", lambda c: c["field"].isin("group_name", "dataset_type") & (c["kind"] == "null"))
    return F.coalesce(F.size(nulls) == 0, F.lit(True))


def _profile(rows: DataFrame) -> list[str]:
    return ["profile"] if "profile" in rows.columns else []


def issue_rows(checked: DataFrame) -> DataFrame:
    """One row per issue: group, document, type, field and value."""
    def tagged(issue_type: str) -> Column:
        kind = F.lit(issue_type).alias("issue_type")
        return F.transform(
            F.col(issue_type), lambda i: F.struct(kind, i["field"].alias("field"), i["value"].alias("value"))
        )

    head = [*_profile(checked), "group_slug", "group_name", "dataset_type", "record_id"]
    issues = F.when(countable(checked), F.concat(*[tagged(t) for t in ISSUE_TYPES]))
    return unfold(with_group(checked), head, issues, "_issue").select(*head, "_issue.*")


def merge_issues(checked: DataFrame, into: str = "merged_issues") -> DataFrame:
    """The three checks of a document as one set of (field, value)."""
    return checked.withColumn(into, F.array_distinct(F.concat(*ISSUE_TYPES)))


def nonstandard_values(checked: DataFrame) -> DataFrame:
    """Distinct (field, value) over all documents: one exchange.

    The values of a field stay rows. One list per field would put all values of
    a free-text field into one task.
    """
    merged = merge_issues(checked)
    profile = _profile(merged)
    return (
        unfold(merged, profile, F.when(countable(merged), F.col("merged_issues")), "i")
        .select(*profile, "i.field", "i.value")
        .distinct()
    )


def quality_counts(checked: DataFrame) -> DataFrame:
    """Documents, documents per kind of issue, and distinct values.

    One scan: each document gives one counter row and its merged issues. The
    first aggregate finds the distinct values, the second adds everything up.
    """
    profile = _profile(checked)
    counters = ["documents", *ISSUE_TYPES]
    zero = {c: F.lit(0).cast("bigint") for c in counters}
    flags = {"documents": F.lit(1).cast("bigint")} | {
        t: (F.size(t) > 0).cast("bigint") for t in ISSUE_TYPES
    }

    def row(field: Column, value: Column, values: dict[str, Column]) -> Column:
        return F.struct(field.alias("field"), value.alias("value"), *[v.alias(k) for k, v in values.items()])

    none = F.lit(None).cast("string")
    merged = F.transform("merged_issues", lambda i: row(i["field"], i["value"], zero))
    both = F.concat(F.array(row(none, none, flags)), merged)
    rows = unfold(merge_issues(checked), profile, F.when(countable(checked), both), "r").select(*profile, "r.*")
    return (
        rows.groupBy(*profile, "field", "value")
        .agg(*[F.sum(c).alias(c) for c in counters])
        .groupBy(*profile)
        .agg(
            F.sum("documents").alias("documents_processed"),
            F.sum(NONPERMISSIBLE).alias("documents_with_non_standard_values"),
            F.sum(MISSING).alias("documents_with_missing_required_values"),
            F.sum(REGEX).alias("documents_with_invalid_patterns"),
            F.count("field").alias("total_values"),
        )
    )


def group_summary(checked: DataFrame, first_by: str = "record_id") -> DataFrame:
    """Per group the distinct documents with each kind of issue.

    Groups without issues stay, with zeros. The spelling of a group is that of
    its first document by ``first_by``. Documents without issues give up their
    id before the first exchange, so only those with issues are shuffled one by
    one; both exchanges carry partial aggregates.
    """
    grouped = with_group(checked)
    profile = _profile(grouped)
    any_issue = reduce(lambda a, b: a | b, [F.size(t) > 0 for t in ISSUE_TYPES])
    flagged = grouped.select(
        *profile,
        "group_slug",
        F.when(any_issue, F.col("record_id")).alias("record_id"),
        *[(F.size(t) > 0).alias(t) for t in ISSUE_TYPES],
        F.struct(F.col(first_by).alias("at"), "group_name", "dataset_type").alias("first"),
        *([countable(grouped).alias("counts")] if "head" in grouped.columns else []),
    )
    if "head" in grouped.columns:
        flagged = rows_where(flagged, F.col("counts")).drop("counts")
    per_document = flagged.groupBy(*profile, "group_slug", "record_id").agg(
        *[F.max(t).alias(t) for t in ISSUE_TYPES], F.min("first").alias("first")
    )
    return (
        per_document.groupBy(*profile, "group_slug")
        .agg(
            F.min("first").alias("first"),
            *[F.count_if(F.col(t) & F.col("record_id").isNotNull()).alias(t) for t in ISSUE_TYPES],
            F.count("record_id").alias("total"),
        )
        .select(
            *profile,
            "group_slug",
            "first.group_name",
            "first.dataset_type",
            F.col(NONPERMISSIBLE).alias("datasets_with_non_standard_values"),
            F.col(MISSING).alias("datasets_with_missing_required_values"),
            F.col(REGEX).alias("datasets_with_invalid_input_patterns"),
            F.col("total").alias("total_datasets_with_issues"),
        )
    )
