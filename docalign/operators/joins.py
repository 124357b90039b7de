"""Lookups in config tables by join."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.functions.rows import unfold
from docalign.operators.config import DUPLICATE, Config, joined_table


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with underscores before it until no column has it."""
    used = {c.lower() for c in taken}
    found = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        found.append(name)
    return found


def attach_matches(
    documents: DataFrame,
    table: DataFrame,
    body: str,
    keys: dict[str, Callable[[Column], Column]],
    value: str,
) -> tuple[DataFrame, str]:
    """Left join every cell of ``body`` with ``table`` and bring the hits home.

    ``keys`` gives, per key column of the table, the value of a cell. The result is
    the documents with a column of hits aligned with the cells, and the name of that
    column, which no column of the documents had. Rows of the table without a key name
    their profile, but match nothing.

    What a cell hits depends on the profile, the field and the text only. So a document
    is found again by a hash of its profile and body: equal bodies have equal hits, and
    no column needs to be unique. The hash has 128 bits.

    No side is broadcast by hint. A cell value or a body shared by very many documents
    skews a join on its document side, which adaptive execution splits; hits of equal
    bodies are merged before the exchange.
    """
    out, scope, h1, h2, found_at = fresh(documents.columns, "_match", "_scope", "_h1", "_h2", "_found")
    scoped, table = with_scope(documents, table, scope)
    scoped = with_body_hash(scoped, body, scope, h1, h2)
    usable = table
    for k in keys:
        usable = usable.where(F.col(k).isNotNull())
    # One row per key; a second one is an error, as in a constant.
    usable = usable.groupBy(scope, *keys).agg(F.any_value(value).alias("_value"), F.count("*").alias("_n"))
    problem = F.raise_error(F.concat_ws(" ", F.lit(f"{DUPLICATE}:"), scope, *keys))
    usable = usable.withColumn("_value", F.when(F.col("_n") > 1, problem).otherwise(F.col("_value"))).drop("_n")
    cells = unfold(scoped, [h1, h2, scope], body, "_cell", "_pos").select(
        h1, h2, scope, "_pos", *[fn(F.col("_cell")).alias(k) for k, fn in keys.items()]
    )
    found = cells.join(usable, [scope, *keys])
    # A group is one body, so it is never larger than its own cells.
    hits = found.groupBy(h1, h2).agg(F.map_from_entries(F.collect_set(F.struct("_pos", "_value"))).alias(found_at))
    aligned = F.transform(F.col(body), lambda c, i: F.try_element_at(F.col(found_at), i))
    with_hits = scoped.join(hits, [h1, h2], "left").withColumn(out, aligned)
    return with_hits.drop(found_at, h1, h2, scope), out


def with_body_hash(documents: DataFrame, body: str, scope: str, h1: str, h2: str) -> DataFrame:
    """Two hashes of a document's scope and body, by which its hits come home."""
    return documents.withColumn(h1, F.xxhash64(scope, body)).withColumn(h2, F.xxhash64(body, scope))


def flag_cells(documents: DataFrame, cells: DataFrame, verdicts: DataFrame, home: list[str], keys: list[str], into: str) -> DataFrame:
    """Bring home which cells have a verdict: ``into`` gets their places, null for none.

    ``cells`` are rows of the documents' cells with the columns ``home`` (hashes of a body),
    ``_pos`` and ``keys``; ``verdicts`` are distinct keys. Only cells with a verdict go to
    the second exchange.
    """
    hits = cells.join(verdicts, keys, "left_semi").groupBy(*home).agg(F.collect_set("_pos").alias(into))
    return documents.join(hits, home, "left")


def with_scope(rows: DataFrame, table: DataFrame, scope: str = "_scope") -> tuple[DataFrame, DataFrame]:
    """Both sides with ``scope``: the part of the table that a row follows, '' for the shared one.

    ``rows`` are documents, or counts by profile, not cells: the join below has one row
    per profile that the table names.
    """
    scoped_table = table.withColumn(scope, F.coalesce("profile", F.lit(""))).drop("profile")
    if "profile" not in rows.columns:
        shared = table.where(F.col("profile").isNull()).withColumn(scope, F.lit("")).drop("profile")
        return rows.withColumn(scope, F.lit("")), shared
    named = table.where(F.col("profile").isNotNull()).select("profile", F.col("profile").alias(scope)).distinct()
    scoped = rows.join(named, "profile", "left").withColumn(scope, F.coalesce(scope, F.lit("")))
    return scoped, scoped_table


SCHEMA_ROW = (
    "profile string, pos int, name string, required boolean, required_strict boolean, "
    "default_value struct<kind:string,text:string>"
)


def attach_schema(documents: DataFrame, schema: Config) -> tuple[DataFrame, str]:
    """Each document with the schema it follows, as one array in the order of the fields, and that column's name.

    ``array<struct<pos, name, required, required_strict, default_value>>``, null where the
    document's profile has no schema. One row per profile is joined, so a catalog of any
    number of profiles stays out of the plan; a group of it is one schema.
    """
    if not isinstance(schema, DataFrame):
        names = [part.split()[0] for part in SCHEMA_ROW.split(", ")]
        schema = [{n: r[n] for n in names} for r in schema]
    out, scope = fresh(documents.columns, "_schema", "_scope")
    scoped, table = with_scope(documents, joined_table(documents, schema, SCHEMA_ROW), scope)
    field = F.struct("pos", "name", "required", "required_strict", "default_value")
    per_profile = table.groupBy(scope).agg(F.array_sort(F.collect_list(field)).alias(out))
    return scoped.join(per_profile, scope, "left").drop(scope), out
