"""Standardizing values: value maps, the lookup, and what it leaves open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.functions.rows import unfold
from docalign.operators.config import (
    Config, Rows, constant_rows, distinct_keys, is_joined, joined_table, named_profiles, scoped_lookup,
)
from docalign.operators.joins import attach_matches, fresh, with_scope

MAP_ROW = f"profile string, field string, legacy_key string, is_list boolean, options array<{C.VALUE}>"
TARGET = f"struct<is_list:boolean,options:array<{C.VALUE}>>"


def normalize_value_map(entries: DataFrame) -> DataFrame:
    """``profile, field, legacy_key, is_list, options`` from file members.

    A member that is an object names its field and replaces every earlier map
    of that field; any other member is one more key for the field named by the
    file. A later key wins. A field whose map is empty gets one row with a null
    key.
    """
    place = F.struct("source_file", "pos")
    nested = F.col("kind") == "object"
    placed = entries.select(
        "profile",
        F.when(nested, F.col("key")).otherwise(F.col("stem")).alias("field"),
        place.alias("place"),
        nested.alias("nested"),
        "key",
        "kind",
        "text",
    )
    fields = placed.groupBy("profile", "field").agg(
        F.max(F.when(F.col("nested"), F.col("place"))).alias("replaced_at")
    )
    inner = F.when(F.col("nested"), C.parse_cells(F.col("text"))).otherwise(
        F.array(C.cell(F.col("key"), F.col("kind"), F.col("text")))
    )
    pairs = (
        unfold(placed, ["profile", "field", "place"], inner, "c")
        .groupBy("profile", "field", F.col("c.field").alias("legacy_key"))
        .agg(F.max_by(F.struct("c.kind", "c.text"), "place").alias("target"), F.max("place").alias("place"))
    )
    # The fields are the small side and the right one: a field with millions of keys
    # is split on the left. Fields without a live key follow by a union.
    left, right = pairs.alias("p"), fields.alias("f")
    same = (F.col("f.profile").eqNullSafe(F.col("p.profile"))) & (F.col("f.field") == F.col("p.field"))
    live = F.col("f.replaced_at").isNull() | (F.col("p.place") >= F.col("f.replaced_at"))
    is_list = F.coalesce(F.col("p.target.kind") == "array", F.lit(False))
    options = F.when(is_list, C.parse_values(F.col("p.target.text"))).otherwise(F.array(F.col("p.target")))
    found = left.join(right, same & live).select(
        "p.profile", "p.field", "p.legacy_key", is_list.alias("is_list"), options.alias("options")
    )
    # The place of the last key says whether any key is live: no second pass over the keys.
    last = pairs.groupBy("profile", "field").agg(F.max("place").alias("last")).alias("l")
    same = (F.col("f.profile").eqNullSafe(F.col("l.profile"))) & (F.col("f.field") == F.col("l.field"))
    none_live = F.col("l.last").isNull() | (F.col("l.last") < F.col("f.replaced_at"))
    empty = right.join(last, same, "left").where(none_live).select(
        "f.profile", "f.field", F.lit(None).cast("string").alias("legacy_key"), F.lit(False).alias("is_list"),
        F.array().cast(f"array<{C.VALUE}>").alias("options"),
    )
    return found.unionByName(empty)


def standardize_values(
    documents: DataFrame,
    value_map: Config,
    body: str = "modified_metadata",
    into: str = "modified_metadata",
    log: str = "value_mappings",
    ambiguous_log: str = "ambiguous_mappings",
    lookup: str | None = None,
) -> DataFrame:
    """Replace values that the map knows by field and text.

    A null never matches. One target (also a list of one) replaces the value, an
    empty list does so as ``[]``; several targets leave it and are logged for a
    decision. A field with an empty map counts for its profile. ``lookup`` is
    "constant" or "join", see ``operators.config``.
    """
    if is_joined(value_map, lookup):
        table = joined_table(documents, value_map, MAP_ROW).withColumn("target", F.struct("is_list", "options"))
        keys = {"field": lambda c: c["field"], "legacy_key": _key}
        documents, match = attach_matches(documents, table, body, keys, "target")
        added = [match]
        matches = F.zip_with(
            F.col(body), F.col(match), lambda c, h: F.struct(c.alias("cell"), _key(c).alias("old"), h.alias("hit"))
        )
    else:
        find = _value_lookup(documents, constant_rows(value_map))
        with_keys = F.transform(F.col(body), lambda c: F.struct(c.alias("cell"), _key(c).alias("old")))
        matches = F.transform(
            with_keys,
            lambda k: F.struct(
                k["cell"].alias("cell"), k["old"].alias("old"), find(k["cell"]["field"], k["old"]).alias("hit")
            ),
        )
        added = []
    [name] = fresh([*documents.columns, into, log, ambiguous_log], "_matched")
    matched = F.col(name)
    several = lambda m: m["hit"]["is_list"] & (F.size(m["hit"]["options"]) > 1)
    replaced = F.filter(matched, lambda m: m["hit"].isNotNull() & ~several(m))
    open_ones = F.filter(matched, lambda m: m["hit"].isNotNull() & several(m))

    def logged(m: Column) -> Column:
        new = _new_cell(m)
        return F.struct(
            m["cell"]["field"].alias("field"), m["old"].alias("old"), new["kind"].alias("kind"), new["text"].alias("text")
        )

    def left_open(m: Column) -> Column:
        cell = m["cell"]
        return F.struct(
            cell["field"].alias("field"),
            cell["kind"].alias("kind"),
            cell["text"].alias("text"),
            m["hit"]["options"].alias("options"),
        )

    return (
        documents.withColumn(name, matches)
        .withColumn(
            into,
            F.transform(
                matched, lambda m: F.when(m["hit"].isNull() | several(m), m["cell"]).otherwise(_new_cell(m))
            ),
        )
        .withColumn(log, F.transform(replaced, logged))
        .withColumn(ambiguous_log, F.transform(open_ones, left_open))
        .drop(name, *added)
    )


def _key(cell: Column) -> Column:
    """The text by which a value is looked up."""
    return C.python_text(cell["kind"], cell["text"])


def _new_cell(m: Column) -> Column:
    only = F.get(m["hit"]["options"], F.lit(0))
    return F.when(
        only.isNull(), C.cell(m["cell"]["field"], F.lit("array"), F.lit("[]"))
    ).otherwise(C.cell(m["cell"]["field"], only["kind"], only["text"]))


def _value_lookup(documents: DataFrame, rows: Rows):
    """Function of (field, text) to the target."""
    distinct_keys([r for r in rows if r["legacy_key"] is not None], "field", "legacy_key")
    return scoped_lookup(
        (
            (r["profile"], (r["field"], r["legacy_key"]), {"is_list": r["is_list"], "options": r["options"]})
            for r in rows
            if r["legacy_key"] is not None
        ),
        TARGET,
        named_profiles(documents, rows),
    )


def unmapped_values(
    documents: DataFrame,
    value_map: Config,
    body: str = "modified_metadata",
    lookup: str | None = None,
) -> DataFrame:
    """How often each value occurs that its field's map does not cover.

    ``profile, field, value, n``. Only fields with a map count, an empty map
    included; nulls have no text to look up. One exchange, after the counts
    have been combined on each side of it.
    """
    profile = ["profile"] if "profile" in documents.columns else []
    texts = unfold(documents, profile, body, "c").select(
        *profile, F.col("c.field").alias("field"), C.python_text(F.col("c.kind"), F.col("c.text")).alias("value")
    ).where(F.col("value").isNotNull())
    if is_joined(value_map, lookup):
        counted = texts.groupBy(*profile, "field", "value").agg(F.count("*").alias("n"))
        return _not_covered(counted, joined_table(documents, value_map, MAP_ROW))
    rows = constant_rows(value_map)
    find = _value_lookup(documents, rows)
    has_map = scoped_lookup(
        ((r["profile"], (r["field"],), True) for r in rows), "boolean", named_profiles(documents, rows)
    )
    return (
        texts.where(
            F.coalesce(has_map(F.col("field")), F.lit(False))
            & find(F.col("field"), F.col("value")).isNull()
        )
        .groupBy(*profile, "field", "value")
        .agg(F.count("*").alias("n"))
    )


def _not_covered(counted: DataFrame, value_map: DataFrame) -> DataFrame:
    """Counts of values whose field has a map, but not for them."""
    counted, value_map = with_scope(counted, value_map)
    fields = value_map.select("_scope", "field").distinct()
    keys = value_map.where(F.col("legacy_key").isNotNull()).select("_scope", "field", F.col("legacy_key").alias("value"))
    return (
        counted.join(fields, ["_scope", "field"], "left_semi")
        .join(keys, ["_scope", "field", "value"], "left_anti")
        .drop("_scope")
    )
