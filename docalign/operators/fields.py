"""Renaming: crosswalks, field maps, and the rename itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.functions.text import strip
from docalign.operators.config import (
    Config, constant_rows, distinct_keys, is_joined, joined_table, named_profiles, scoped_lookup,
)
from docalign.operators.joins import attach_matches, fresh


def crosswalk_to_field_map(crosswalk: DataFrame) -> DataFrame:
    """``profile, legacy, target`` from unpivoted crosswalk rows.

    Both names are trimmed and must not be empty. If a legacy name is listed
    twice, the last one in reading order wins, at the place of the first.
    """
    place = F.struct("source_file", "row_no", "col_no")
    return (
        _trimmed(crosswalk)
        .where((F.col("target") != "") & (F.col("legacy") != ""))
        .groupBy("profile", "legacy")
        .agg(F.max_by("target", place).alias("target"), F.min(place).alias("place"))
        .select("profile", "legacy", "target", "place")
    )


def unmapped_legacy_fields(crosswalk: DataFrame) -> DataFrame:
    """Legacy names that the crosswalk lists without any target."""
    # One aggregate answers both "listed" and "has a target": no anti join.
    return (
        _trimmed(crosswalk)
        .where(F.col("legacy") != "")
        .groupBy("profile", "legacy")
        .agg(F.max(F.col("target") != "").alias("has_target"))
        .where(~F.col("has_target"))
        .select("profile", "legacy")
    )


def _trimmed(crosswalk: DataFrame) -> DataFrame:
    return crosswalk.withColumn("target", F.coalesce(strip(F.col("target")), F.lit(""))).withColumn(
        "legacy", F.coalesce(strip(F.col("legacy")), F.lit(""))
    )


def merge_field_maps(entries: DataFrame) -> DataFrame:
    """Several field map files as one map; the first mapping of a name wins."""
    place = F.struct("source_file", "pos")
    # The struct around the target keeps a null target that comes first.
    return (
        entries.groupBy("profile", "legacy")
        .agg(F.min_by(F.struct("target"), place).alias("first"), F.min(place).alias("place"))
        .select("profile", "legacy", "first.target", "place")
    )


def rename_fields(
    documents: DataFrame,
    field_map: Config,
    body: str = "modified_metadata",
    into: str = "modified_metadata",
    log: str = "field_mappings",
    lookup: str | None = None,
) -> DataFrame:
    """Rename the fields of the body.

    Several legacy fields may lead to one name. A mapped field is then dropped
    if the name is taken; a field without a mapping keeps its own name and
    overwrites what is there, in its place. So for every name the unmapped cell
    counts if there is one, else the first mapped one, at the place of the first
    of all: that needs no running state. ``log`` gets the renames made.

    The map lists a legacy name once (see ``merge_field_maps``); ``lookup`` is
    "constant" or "join", see ``operators.config``.
    """
    if is_joined(field_map, lookup):
        table = joined_table(documents, field_map, "profile string, legacy string, target string")
        documents, match = attach_matches(documents, table, body, {"legacy": lambda c: c["field"]}, "target")
        entries = F.zip_with(F.col(body), F.col(match), _entry)
        added = [match]
    else:
        rows = distinct_keys(constant_rows(field_map), "legacy")
        find = scoped_lookup(
            # A null target is no mapping, but its row names the profile.
            ((r["profile"], (r["legacy"],), r["target"]) for r in rows if r["target"] is not None),
            "string",
            named_profiles(documents, rows),
        )
        entries = F.transform(F.col(body), lambda c: _entry(c, find(c["field"])))
        added = []
    [name] = fresh([*documents.columns, into, log], "_renamed")
    renamed = F.col(name)
    clear = F.size(F.array_distinct(F.transform(renamed, _key))) == F.size(renamed)
    kept = F.when(clear, renamed).otherwise(_resolved(renamed))
    moved = F.filter(F.when(clear, renamed).otherwise(_firsts(renamed)), lambda k: k["target"] != k["field"])
    return (
        documents.withColumn(name, entries)
        .withColumn(into, F.transform(kept, lambda k: C.cell(_key(k), k["kind"], k["text"])))
        .withColumn(
            log,
            F.transform(moved, lambda k: F.struct(k["field"].alias("legacy"), k["target"].alias("target"))),
        )
        .drop(name, *added)
    )


def _entry(cell: Column, target: Column) -> Column:
    """A cell with the target of its field, null for none."""
    return F.struct(
        target.alias("target"), cell["field"].alias("field"), cell["kind"].alias("kind"), cell["text"].alias("text")
    )


def _key(entry: Column) -> Column:
    return F.coalesce(entry["target"], entry["field"])


def _by_key(entries: Column, choose: Callable[[Column], Column]) -> Column:
    """One entry per name, for bodies in which names meet."""
    return C.let(
        entries,
        lambda all_: F.transform(
            F.array_distinct(F.transform(all_, _key)),
            lambda key: choose(F.filter(all_, lambda k: _key(k) == key)),
        ),
    )


def _firsts(entries: Column) -> Column:
    return _by_key(entries, lambda same: F.get(same, F.lit(0)))


def _resolved(entries: Column) -> Column:
    # Field names are unique, so at most one entry keeps its name unmapped.
    return _by_key(
        entries,
        lambda same: F.coalesce(
            F.get(F.filter(same, lambda k: k["target"].isNull()), F.lit(0)), F.get(same, F.lit(0))
        ),
    )
