"""The registered queries: every operator on documents from the given tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as X
from docalign.functions.cells import json_object, json_value, parse_cells
from docalign.functions.rows import unfold
from docalign.operators import diff, fields, membership, quality, report, review, rules, schema, values
from docalign.operators.nested_diff import apply_patch, diff_nested
from docalign.plans.harmonize import harmonize, log_entries, output_documents, run_summary
from docalign.sources import config as readers
from docalign.sources import documents as docs
from docalign.sources import quarantine as apart
from docalign.sources.quality import write_quality_run
from docalign.sources.value_lists import write_value_lists
from docalign.streaming import outcomes


def _cells(rows: DataFrame, body: str = "modified_metadata", *more: str) -> DataFrame:
    """A body as rows ``id, pos, field, value_json``."""
    return unfold(rows, ["id", *more], body, "c", "pos").select(
        "id", *more, "pos", F.col("c.field").alias("field"), json_value(F.col("c.kind"), F.col("c.text")).alias("value_json")
    )


def _values(items: Column) -> Column:
    """Values as a JSON array text."""
    texts = F.transform(items, lambda v: json_value(v["kind"], v["text"]))
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def _orders(spark, folder):
    return X.order_documents(spark, folder)


def _renamed(spark, folder):
    return fields.rename_fields(_orders(spark, folder), X.FIELD_MAP, body="metadata")


def _standardized(spark, folder):
    return values.standardize_values(_renamed(spark, folder), X.VALUE_MAP)


def _harmonized(spark, folder):
    return harmonize(_orders(spark, folder), X.RULES, X.FIELD_MAP, X.VALUE_MAP, X.SCHEMA)


def _checked(spark, folder):
    return quality.check_quality(_harmonized(spark, folder), X.SCHEMA)


# --- transformation -----------------------------------------------------------------


def harmonize_orders(spark, folder):
    return _cells(_harmonized(spark, folder))


def harmonize_profiles(spark, folder):
    done = harmonize(
        X.profile_documents(spark, folder),
        X.PROFILE_RULES,
        X.PROFILE_FIELD_MAP,
        X.PROFILE_VALUE_MAP,
        X.PROFILE_SCHEMA,
    )
    return _cells(done, "modified_metadata", "profile")


def harmonize_profiles_joined(spark, folder):
    """Maps by join; an id that is null and documents that are repeated change nothing."""
    documents = X.profile_documents(spark, folder)
    done = harmonize(
        documents.withColumn("key", F.lit(None).cast("long")).unionByName(documents.withColumn("key", F.lit(1).cast("long"))),
        X.PROFILE_RULES,
        X.PROFILE_FIELD_MAP,
        X.PROFILE_VALUE_MAP,
        X.PROFILE_SCHEMA,
        lookup="join",
    )
    return _cells(done.where("key is null"), "modified_metadata", "profile")


def conform_orders_joined(spark, folder):
    return _cells(schema.conform_to_schema(_standardized(spark, folder), X.SCHEMA, lookup="join"))


def missing_before_conform_joined(spark, folder):
    found = quality.find_missing_required(_renamed(spark, folder), X.SCHEMA, lookup="join")
    return _issues(found, quality.MISSING)


def conform_catalog(spark, folder):
    """Every part by a schema of its own: as many profiles as parts."""
    catalog = _catalog(spark, readers.schema_entries(X.schema_files(spark, folder)))
    return _cells(schema.conform_to_schema(_parts(spark, folder), catalog, body="metadata"))


def _written(spark, rows):
    """Rows that several joins read, computed once: in the shared folder (a local one only where none is set)."""
    at = f"{spark.conf.get('spark.checkpoint.dir', None) or tempfile.mkdtemp(prefix='written-')}/written-{uuid.uuid4().hex}"
    rows.write.parquet(at)
    return spark.read.schema(rows.schema).parquet(at)


def _catalog(spark, rows):
    """A catalog with as many profiles as documents. The size of a small file says nothing about the
    texts parsed out of it, so that Spark would broadcast them through the driver: both sides are sorted."""
    return _written(spark, rows).hint("merge")


def _parts(spark, folder):
    return _written(spark, X.part_documents(spark, folder))


def _part_rules(spark, folder):
    return _catalog(spark, readers.rule_entries(X.part_rules(spark, folder)))


def _part_schemas(spark, folder):
    return _catalog(spark, readers.schema_entries(X.part_schemas(spark, folder)))


def rules_catalog(spark, folder):
    """Every part by rules of its own and by the shared ones; no rule is in the plan."""
    return _cells(rules.apply_rules(_parts(spark, folder), _part_rules(spark, folder)))


def fired_rules_catalog(spark, folder):
    fired = rules.fired_rules(_parts(spark, folder), _part_rules(spark, folder))
    return fired.select("id", "rule_no", "source_file", "updates")


def rule_coverage_catalog(spark, folder):
    return report.rule_coverage(_parts(spark, folder).drop("profile"), _part_rules(spark, folder))


def apply_rules_orders_joined(spark, folder):
    return _cells(rules.apply_rules(_orders(spark, folder), X.RULES, lookup="join"))


def nonpermissible_catalog(spark, folder):
    found = quality.find_nonpermissible(_parts(spark, folder), _part_schemas(spark, folder), body="metadata")
    return _issues(found, quality.NONPERMISSIBLE)


def validate_catalog(spark, folder):
    done = schema.validate_values(_parts(spark, folder), _part_schemas(spark, folder), body="metadata")
    return unfold(done, ["id"], F.arrays_zip("metadata", "valid"), "v").select(
        "id", F.col("v.metadata.field").alias("field"), F.col("v.valid").alias("valid")
    )


def facets_catalog(spark, folder):
    done = schema.attach_schema_facets(_parts(spark, folder), _part_schemas(spark, folder), body="metadata")
    return unfold(done, ["id"], "facets", "f").select(
        "id", "f.field", "f.required", json_value(F.col("f.default_kind"), F.col("f.default_text")).alias("default_json")
    )


def patterns_catalog(spark, folder):
    """Violations of patterns that are data, and the patterns that cannot be checked."""
    schemas = _part_schemas(spark, folder)
    found = quality.find_regex_violations(_parts(spark, folder), schemas, body="metadata")
    broken = _issues(found, quality.REGEX).select("id", "field", "value", F.lit("violation").alias("result"))
    left_out = membership.uncheckable_patterns(schemas)
    return broken.unionByName(
        left_out.select(
            F.substring_index("profile", "-", -1).cast("bigint").alias("id"), "field", F.col("regex").alias("value"),
            F.lit("not checkable").alias("result"),
        )
    )


def choice_lists_catalog(spark, folder):
    schemas = _part_schemas(spark, folder)
    checked = quality.check_quality(_parts(spark, folder), schemas, body="metadata")
    return review.choice_lists(quality.issue_rows(checked), schemas)


def group_summary_catalog(spark, folder):
    """All three checks by join, summed up over all profiles."""
    checked = quality.check_quality(_parts(spark, folder), _part_schemas(spark, folder), body="metadata")
    return quality.group_summary(checked.drop("profile"))


def _harmonized_table(spark, folder):
    """What the joined checks scan several times: written once, with the columns that they read."""
    return _written(spark, _harmonized(spark, folder).select("id", "modified_metadata"))


def regex_violations_joined(spark, folder):
    return _issues(quality.find_regex_violations(_harmonized_table(spark, folder), X.SCHEMA, lookup="join"), quality.REGEX)


def nonpermissible_joined(spark, folder):
    return _issues(quality.find_nonpermissible(_harmonized_table(spark, folder), X.SCHEMA, lookup="join"), quality.NONPERMISSIBLE)


def rename_fields_orders_joined(spark, folder):
    return _cells(fields.rename_fields(_orders(spark, folder), X.FIELD_MAP, body="metadata", lookup="join"))


def standardize_values_orders_joined(spark, folder):
    return _cells(values.standardize_values(_renamed(spark, folder), X.VALUE_MAP, lookup="join"))


def unmapped_values_joined(spark, folder):
    return values.unmapped_values(_renamed(spark, folder), X.VALUE_MAP, lookup="join")


def harmonize_without_phases(spark, folder):
    """No phase given: the body comes out as it went in."""
    return _cells(harmonize(_orders(spark, folder)))


def apply_rules_orders(spark, folder):
    return _cells(rules.apply_rules(_orders(spark, folder), X.RULES))


def applied_rule_log(spark, folder):
    done = rules.apply_rules(_orders(spark, folder), X.RULES)
    return unfold(done, ["id"], "applied_rules", "a").select(
        "id", "a.rule_no", "a.field", json_value(F.col("a.kind"), F.col("a.text")).alias("value_json")
    )


def rule_coverage(spark, folder):
    return report.rule_coverage(_orders(spark, folder), X.RULES)


def rename_fields_orders(spark, folder):
    return _cells(_renamed(spark, folder))


def rename_log(spark, folder):
    done = unfold(_renamed(spark, folder), ["id"], "field_mappings", "m", "pos")
    return done.select("id", "pos", "m.legacy", "m.target")


def standardize_values_orders(spark, folder):
    return _cells(_standardized(spark, folder))


def value_mapping_log(spark, folder):
    return unfold(_standardized(spark, folder), ["id"], "value_mappings", "m").select(
        "id", "m.field", "m.old", json_value(F.col("m.kind"), F.col("m.text")).alias("new_json")
    )


def ambiguous_log(spark, folder):
    return unfold(_standardized(spark, folder), ["id"], "ambiguous_mappings", "m").select(
        "id", "m.field", json_value(F.col("m.kind"), F.col("m.text")).alias("value_json"),
        _values(F.col("m.options")).alias("options_json"),
    )


def conform_orders(spark, folder):
    return _cells(schema.conform_to_schema(_standardized(spark, folder), X.SCHEMA))


def excluded_orders(spark, folder):
    return _cells(_harmonized(spark, folder), "excluded_data")


def diff_orders(spark, folder):
    done = diff.diff_documents(_harmonized(spark, folder))
    return unfold(done, ["id"], "json_patch", "p", "seq").select(
        "id", "seq", "p.op", "p.path",
        F.when(F.col("p.op") != "remove", json_value(F.col("p.kind"), F.col("p.text"))).alias("value_json"),
    )


def _changed(spark, folder):
    texts = X.changed_events(spark, folder)
    return texts.select("id", parse_cells(F.col("old")).alias("metadata"), parse_cells(F.col("new")).alias("modified_metadata"))


def nested_diff(spark, folder):
    """Operations inside nested values, in the order in which they apply."""
    return unfold(diff_nested(_changed(spark, folder)), ["id"], "json_patch", "p", "seq").select(
        "id", "seq", "p.op", "p.path",
        F.when(F.col("p.op") != "remove", json_value(F.col("p.kind"), F.col("p.text"))).alias("value_json"),
    )


def nested_patch_applied(spark, folder):
    """The old body after the patch, which is the new body."""
    patched = apply_patch(diff_nested(_changed(spark, folder)).drop("modified_metadata"))
    return patched.select("id", json_object(F.col("modified_metadata")).alias("body"))


def output_json_orders(spark, folder):
    """Whole output documents as JSON text, with diff and log."""
    done = output_documents(_harmonized(spark, folder))
    return done.select("id", docs.document_json(done).alias("document"))


# --- documents from JSON text ---------------------------------------------------------


def props_documents(spark, folder):
    parsed = docs.parse_documents(X.event_texts(spark, folder))
    done = harmonize(parsed, field_map=X.EVENT_FIELD_MAP, value_map=X.EVENT_VALUE_MAP)
    return _cells(done, "modified_metadata", "uuid", "group_name")


def parsed_bodies(spark, folder):
    """Good bodies of the damaged texts, rendered again."""
    good, _ = docs.split_valid(docs.parse_documents(X.broken_texts(spark, folder)))
    return good.select("id", json_object(F.col("metadata")).alias("body"))


def output_json_events(spark, folder):
    """Output documents of parsed texts: unknown keys stay, in input order."""
    done = output_documents(
        harmonize(
            docs.parse_documents(X.event_texts(spark, folder)),
            field_map=X.EVENT_FIELD_MAP, value_map=X.EVENT_VALUE_MAP,
        )
    )
    return done.select("id", docs.document_json(done).alias("document"))


def dead_letters(spark, folder):
    _, failed = docs.split_valid(docs.parse_documents(X.broken_texts(spark, folder)))
    return failed.groupBy("status", "error").agg(F.count("*").alias("n"))


def run_totals(spark, folder):
    parsed = docs.parse_documents(X.broken_texts(spark, folder))
    done = harmonize(parsed, field_map=X.EVENT_FIELD_MAP, value_map=X.EVENT_VALUE_MAP)
    return run_summary(docs.file_outcomes(done, log_entries()))


def _files_a_batch(spark, files: int) -> int:
    """Several batches, of whole rounds of all cores where there are files enough: a batch costs planning and small jobs."""
    cores = spark.sparkContext.defaultParallelism
    return max(4, cores * min(4, files // (2 * cores)))


def _streamed(spark, folder):
    """The damaged texts through a stream of several batches; the path of what it wrote."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="stream-")
    root = f"{shared}/stream-{uuid.uuid4().hex}"
    texts = X.broken_texts(spark, folder)
    texts.write.parquet(f"{root}/in")
    files = len(spark.read.schema(texts.schema).parquet(f"{root}/in").inputFiles())
    reader = spark.readStream.schema(texts.schema).option("maxFilesPerTrigger", _files_a_batch(spark, files))
    arriving = reader.parquet(f"{root}/in")
    done = harmonize(docs.parse_documents(arriving), field_map=X.EVENT_FIELD_MAP, value_map=X.EVENT_VALUE_MAP)
    outcomes.write_outcome_stream(output_documents(done), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


def stream_totals(spark, folder):
    """Counts of all batches of a stream: the same as of one run over the table."""
    return outcomes.read_totals(spark, _streamed(spark, folder))


def stream_dead_letters(spark, folder):
    failed = outcomes.read_dead_letters(spark, _streamed(spark, folder))
    return failed.groupBy("status", "error").agg(F.count("*").alias("n"))


# --- broken config files ------------------------------------------------------------------


def config_errors(spark, folder):
    return apart.config_errors(X.broken_catalogs(spark, folder))


def _whole_catalogs(files):
    """The catalogs of the files that can be read."""
    left = {kind: apart.whole_files(rows, kind) for kind, rows in files.items()}
    return {
        apart.RULES: readers.rule_entries(left[apart.RULES]),
        apart.FIELD_MAP: fields.merge_field_maps(readers.field_map_entries(left[apart.FIELD_MAP])),
        apart.VALUE_MAP: values.normalize_value_map(readers.value_map_entries(left[apart.VALUE_MAP])),
        apart.SCHEMA: readers.schema_entries(left[apart.SCHEMA]),
    }


def _told(spark, folder, files, catalogs):
    """Parsed documents, with those of broken config files as errors. The files are checked once for both passes over them."""
    errors = _written(spark, apart.config_errors(files))
    return apart.quarantine(docs.parse_documents(X.supplier_texts(spark, folder)), errors, catalogs)


def config_dead_letters(spark, folder):
    """Documents of broken config files fail with that file as the reason, no others do.

    The documents are read once, so they are not written; neither are catalogs that no document needs for that.
    """
    files = X.broken_catalogs(spark, folder)
    told = docs.file_outcomes(_told(spark, folder, files, _whole_catalogs(files)), None, F.col("profile"))
    return told.groupBy("profile", "status", "error").agg(F.count("*").alias("n"))


def config_survivors(spark, folder):
    """What the whole config files make of the documents that are left."""
    files = X.broken_catalogs(spark, folder)
    # What several joins read is computed once: catalogs and documents.
    catalogs = {kind: _written(spark, rows) for kind, rows in _whole_catalogs(files).items()}
    good, _ = docs.split_valid(_written(spark, _told(spark, folder, files, catalogs)))
    field_map = catalogs[apart.FIELD_MAP].select("profile", "legacy", "target")
    done = harmonize(good, catalogs[apart.RULES], field_map, catalogs[apart.VALUE_MAP], catalogs[apart.SCHEMA])
    return _cells(done, "modified_metadata", "profile")


# --- config catalogs --------------------------------------------------------------------


def _crosswalk(spark, folder):
    return readers.crosswalk_cells(X.crosswalk_files(spark, folder))


def crosswalk_rows(spark, folder):
    return _crosswalk(spark, folder)


def crosswalk_map(spark, folder):
    return fields.crosswalk_to_field_map(_crosswalk(spark, folder)).select(
        "profile", "legacy", "target", "place.source_file", "place.row_no", "place.col_no"
    )


def crosswalk_unmapped(spark, folder):
    return fields.unmapped_legacy_fields(_crosswalk(spark, folder))


def mapping_matrix(spark, folder):
    return report.field_mapping_matrix(_crosswalk(spark, folder), X.VERSION_LABELS)


def merged_field_map(spark, folder):
    entries = readers.field_map_entries(X.field_map_files(spark, folder))
    return fields.merge_field_maps(entries).select("profile", "legacy", "target")


def value_map_table(spark, folder):
    entries = readers.value_map_entries(X.value_map_files(spark, folder))
    return values.normalize_value_map(entries).select(
        "profile", "field", "legacy_key", "is_list", _values(F.col("options")).alias("options_json")
    )


def rule_table(spark, folder):
    return readers.rule_entries(X.rule_files(spark, folder)).drop("part")


def schema_table(spark, folder):
    found = readers.schema_entries(X.schema_files(spark, folder))
    return found.select(
        "profile", "pos", "name", "description", "type", "required", "required_strict", "regex",
        json_value(F.col("default_value.kind"), F.col("default_value.text")).alias("default_json"),
        _values(F.col("permissible")).alias("permissible_json"),
    )


def template_schema(spark, folder):
    children = schema.children_of_templates(X.template_files(spark, folder))
    return schema.template_to_schema(children).select(
        "profile", "pos", "name", "description", "type", "regex",
        json_value(F.col("required.kind"), F.col("required.text")).alias("required_json"),
        json_value(F.col("default_value.kind"), F.col("default_value.text")).alias("default_json"),
        _values(F.col("permissible")).alias("permissible_json"),
    )


# --- lookups and quality -------------------------------------------------------------------


def unmapped_values(spark, folder):
    return values.unmapped_values(_renamed(spark, folder), X.VALUE_MAP)


def validate_values(spark, folder):
    done = schema.validate_values(_harmonized(spark, folder), X.SCHEMA)
    return unfold(done, ["id"], F.arrays_zip("modified_metadata", "valid"), "v").select(
        "id", F.col("v.modified_metadata.field").alias("field"), F.col("v.valid").alias("valid")
    )


def schema_facets(spark, folder):
    done = schema.attach_schema_facets(_renamed(spark, folder), X.SCHEMA)
    return unfold(done, ["id"], "facets", "f").select(
        "id", "f.field", "f.required", json_value(F.col("f.default_kind"), F.col("f.default_text")).alias("default_json")
    )


def _issues(checked: DataFrame, kind: str) -> DataFrame:
    return unfold(checked, ["id"], kind, "i").select("id", "i.field", "i.value")


def nonpermissible(spark, folder):
    return _issues(quality.find_nonpermissible(_harmonized(spark, folder), X.SCHEMA), quality.NONPERMISSIBLE)


def missing_required(spark, folder):
    return _issues(quality.find_missing_required(_harmonized(spark, folder), X.SCHEMA), quality.MISSING)


def missing_before_conform(spark, folder):
    """The same check on bodies that may lack a required field."""
    return _issues(quality.find_missing_required(_renamed(spark, folder), X.SCHEMA), quality.MISSING)


def regex_violations(spark, folder):
    return _issues(quality.find_regex_violations(_harmonized(spark, folder), X.SCHEMA), quality.REGEX)


def merged_issues(spark, folder):
    merged = quality.merge_issues(_checked(spark, folder))
    return _issues(merged, "merged_issues")


def nonstandard_values(spark, folder):
    return quality.nonstandard_values(_checked(spark, folder))


def quality_counts(spark, folder):
    return quality.quality_counts(_checked(spark, folder))


def group_summary(spark, folder):
    return quality.group_summary(_checked(spark, folder))


def _quality_run(spark, folder):
    """All review tables as one run in the shared folder (a local one only where none is set)."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="runs-")
    return write_quality_run(_checked(spark, folder), X.SCHEMA, f"{shared}/quality-{uuid.uuid4().hex}", X.BASE_URL, X.HINTS)


def quality_run(spark, folder):
    """The group summary of a written run, read back."""
    return _quality_run(spark, folder).table("summary")


def quality_run_review(spark, folder):
    """A review list of a written run, read back."""
    return _quality_run(spark, folder).table("review_regex_violations")


def _value_lists(spark, found):
    """Values as JSON fragments of a written run, in the shared folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="runs-")
    return write_value_lists(found, f"{shared}/values-{uuid.uuid4().hex}").table("fragments")


def nonstandard_json(spark, folder):
    """The non-standard values as one JSON document, value by value."""
    return _value_lists(spark, quality.nonstandard_values(_checked(spark, folder))).select("ordinal", "text")


def nonstandard_json_catalog(spark, folder):
    """A document for each brand of parts; one field has most of the values."""
    parts = _parts(spark, folder)
    checked = quality.check_quality(parts, _part_schemas(spark, folder), body="metadata")
    found = quality.issue_rows(checked).select(F.col("group_name").alias("profile"), "field", "value")
    ids = parts.select(F.col("group_name").alias("profile"), F.lit("id").alias("field"), F.col("record_id").alias("value"))
    return _value_lists(spark, found.unionByName(ids)).select("profile", "ordinal", "text")


def issue_rows(spark, folder):
    return quality.issue_rows(_checked(spark, folder))


def _review(spark, folder, kind):
    issues = quality.issue_rows(_checked(spark, folder))
    return review.review_rows(issues, kind, X.BASE_URL, X.HINTS)


def review_nonstandard(spark, folder):
    return _review(spark, folder, quality.NONPERMISSIBLE)


def review_missing(spark, folder):
    return _review(spark, folder, quality.MISSING)


def review_pattern(spark, folder):
    return _review(spark, folder, quality.REGEX)


def choice_lists(spark, folder):
    return review.choice_lists(quality.issue_rows(_checked(spark, folder)), X.SCHEMA)


def value_mapping_catalog(spark, folder):
    return report.value_mapping_catalog(_harmonized(spark, folder))


def report_counts(spark, folder):
    catalog = report.value_mapping_catalog(
        harmonize(X.profile_documents(spark, folder), X.PROFILE_RULES, X.PROFILE_FIELD_MAP, X.PROFILE_VALUE_MAP)
    )
    return report.report_counts(_crosswalk(spark, folder), catalog, X.PROFILE_RULES)


ALL = [
    harmonize_orders, harmonize_profiles, harmonize_without_phases, apply_rules_orders, applied_rule_log,
    rule_coverage, rename_fields_orders, rename_log, standardize_values_orders, value_mapping_log,
    ambiguous_log, conform_orders, excluded_orders, diff_orders, output_json_orders, props_documents,
    parsed_bodies, output_json_events, dead_letters, run_totals, crosswalk_rows, crosswalk_map,
    crosswalk_unmapped, mapping_matrix, merged_field_map, value_map_table, rule_table, schema_table,
    template_schema, unmapped_values, validate_values, schema_facets, nonpermissible, missing_required,
    missing_before_conform, regex_violations, merged_issues, nonstandard_values, quality_counts,
    group_summary, issue_rows, review_nonstandard, review_missing, review_pattern, choice_lists,
    value_mapping_catalog, report_counts, harmonize_profiles_joined, rename_fields_orders_joined,
    standardize_values_orders_joined, unmapped_values_joined, conform_orders_joined, missing_before_conform_joined,
    conform_catalog, rules_catalog, fired_rules_catalog, rule_coverage_catalog, apply_rules_orders_joined,
    nonpermissible_catalog, validate_catalog, facets_catalog, patterns_catalog, choice_lists_catalog, group_summary_catalog,
    regex_violations_joined, nonpermissible_joined, nested_diff, nested_patch_applied,
    quality_run, quality_run_review, stream_totals, stream_dead_letters, nonstandard_json, nonstandard_json_catalog,
    config_errors, config_dead_letters, config_survivors,
]


def queries():
    return {q.__name__: q for q in ALL}
