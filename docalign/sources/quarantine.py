"""Broken config files set apart, so that they stop their own profile and no other.

The readers of ``sources.config`` raise an error for a file that is broken. Here the files of a
catalog are checked first: ``config_errors`` gives a row for each broken one, ``whole_files``
the others, which the readers then take, and ``quarantine`` makes dead letters of the
documents that would follow a broken file, with that file as the reason.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.operators.joins import fresh
from docalign.operators.rule_index import Network
from docalign.sources.config import _array_text, crosswalk_is_whole
from docalign.sources.documents import _one_value

CROSSWALK, FIELD_MAP, VALUE_MAP, RULES, SCHEMA = "crosswalk", "field map", "value map", "rules", "schema"
#: Where a document has several reasons, the kind that comes first here is named.
KINDS = (CROSSWALK, FIELD_MAP, VALUE_MAP, RULES, SCHEMA)


def _rules_error(text: str) -> str | None:
    """What is wrong with the first broken rule of an array, null for nothing."""
    try:
        rules = json.loads(text)
    except (ValueError, RecursionError):
        return "invalid JSON"
    for no, rule in enumerate(rules, 1):
        if not isinstance(rule, dict) or not {"when", "then"} <= rule.keys():
            return f"rule {no} must be an object with 'when' and 'then'"
        if not isinstance(rule["when"], dict) or not isinstance(rule["then"], dict):
            return f"rule {no}: 'when' and 'then' must be objects"
        try:
            Network(rule["when"])
        except ValueError as error:
            return f"rule {no}: {error}"
        except RecursionError:
            return f"rule {no} is nested too deep"
    return None


def _with_rules_error(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rule files with the ``problem`` of their rules, where they had none."""
    for batch in batches:
        problems = pa.array(
            [p or _rules_error(t) for p, t in zip(batch["problem"].to_pylist(), batch["content"].to_pylist())], pa.string()
        )
        yield batch.set_column(batch.schema.get_field_index("problem"), "problem", problems)


def _problem(kind: str) -> Column:
    """What is wrong with the ``content`` of a file, null for nothing."""
    if kind == CROSSWALK:
        return F.when(~crosswalk_is_whole(), F.lit("a crosswalk needs a header, a row and two columns"))
    not_json = F.col("content").isNull() | ~_one_value(F.col("content"))
    if kind in (FIELD_MAP, VALUE_MAP):
        shape = F.when(C.parse_cells(F.col("content")).isNull(), F.lit(f"a {kind} must be a JSON object"))
    elif kind in (RULES, SCHEMA):
        name = "rule file" if kind == RULES else "target schema"
        shape = F.when(_array_text().isNull(), F.lit(f"a {name} must be a JSON array"))
    else:
        raise ValueError(f"no kind of config file: {kind}")
    return F.when(not_json, F.lit("invalid JSON")).otherwise(shape)


def checked_files(files: DataFrame, kind: str) -> DataFrame:
    """The files with ``problem``: what a reader of this ``kind`` would raise, null for a whole file.

    An empty or null content is no JSON. One pass over the files and no exchange; rules go
    through Python, where nested conditions are followed.
    """
    checked = files.withColumn("problem", _problem(kind))
    if kind != RULES:
        return checked
    return checked.mapInArrow(_with_rules_error, checked.schema)


def config_errors(files: Mapping[str, DataFrame]) -> DataFrame:
    """``kind, profile, source_file, problem`` for each broken file of catalogs by kind."""
    parts = [
        checked_files(rows, kind)
        .where(F.col("problem").isNotNull())
        .select(F.lit(kind).alias("kind"), "profile", "source_file", "problem")
        for kind, rows in files.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def whole_files(files: DataFrame, kind: str) -> DataFrame:
    """The files that can be read, also those of profiles that lose another one."""
    return checked_files(files, kind).where(F.col("problem").isNull()).drop("problem")


def quarantine(documents: DataFrame, errors: DataFrame, catalogs: Mapping[str, DataFrame]) -> DataFrame:
    """Documents with an ``error`` where a config file that they follow is broken.

    ``errors`` are rows of ``config_errors``; ``catalogs`` gives by kind what was read from the
    whole files (any rows with ``profile``). A broken file of a profile stops the documents of
    that profile. A broken file without a profile stops the documents that follow the shared rows of
    its kind: those without a profile, and those whose profile the catalog does not name. An
    ``error`` that a document has stays; its own files come before shared ones, then kinds in
    the order of ``KINDS``, then the smallest file name. All other columns stay as they are.

    One row per profile is joined with the documents, without a broadcast hint. Of the shared
    files at most one row per kind comes to the driver.
    """
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    reason = F.concat_ws(" ", F.lit("config:"), "kind", F.concat(F.coalesce("source_file", F.lit("?")), F.lit(":")), "problem")
    reasons = errors.select("profile", "kind", rank.alias("rank"), F.struct("source_file", "problem").alias("at"), reason.alias("reason"))
    shared = (
        reasons.where(F.col("profile").isNull()).groupBy("kind", "rank").agg(F.min_by("reason", "at").alias("reason")).collect()
    )
    parts = [
        reasons.where(F.col("profile").isNotNull()).select(
            "profile", F.struct("rank", "at", "reason").alias("own"), F.lit(None).cast("string").alias("named")
        )
    ]
    # Which profiles a catalog names matters only where a shared file of its kind is broken.
    for row in shared:
        if row["kind"] in catalogs:
            named = catalogs[row["kind"]].where(F.col("profile").isNotNull()).select("profile").distinct()
            none = F.lit(None).cast(parts[0].schema["own"].dataType)
            parts.append(named.select("profile", none.alias("own"), F.lit(row["kind"]).alias("named")))
    before = F.col("error") if "error" in documents.columns else F.lit(None).cast("string")
    own, named = fresh([*documents.columns, "error"], "_own", "_named")
    if "profile" in documents.columns:
        by_profile = reduce(DataFrame.unionByName, parts).groupBy("profile").agg(
            F.min("own")["reason"].alias(own), F.collect_set("named").alias(named)
        )
        joined = documents.join(by_profile, "profile", "left").select(*documents.columns, own, named)
    else:
        joined = documents.withColumn(own, F.lit(None).cast("string")).withColumn(named, F.lit(None).cast("array<string>"))
    general = [
        F.when(~F.coalesce(F.array_contains(named, row["kind"]), F.lit(False)), F.lit(row["reason"]))
        for row in sorted(shared, key=lambda row: row["rank"])
    ]
    return joined.withColumn("error", F.coalesce(before, F.col(own), *general)).drop(own, named)
