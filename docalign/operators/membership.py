"""Checks of cells against target schemas of any size, by join.

The distinct values of the documents are compared with the schema, not each cell: values
by profile, field, kind and text against the listed ones, texts against the pattern of their
field. Only cells whose value failed are then sought among the documents' cells, and the
documents get the places of these cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.functions.patterns import translate
from docalign.functions.rows import unfold
from docalign.functions.text import is_blank
from docalign.operators.config import Config, joined_table
from docalign.operators.joins import flag_cells, fresh, with_body_hash, with_scope
from docalign.operators.listed import printed_value, same_values

SCHEMA_PARTS = {
    "profile": "string", "pos": "int", "name": "string", "required": "boolean",
    "default_value": "struct<kind:string,text:string>", "regex": "string", "permissible": f"array<{C.VALUE}>",
}
#: Parts of the values of one pattern, so that a pattern that most values have is not one task.
SALTS = 32


def schema_table(documents: DataFrame, schema: Config) -> DataFrame:
    """A target schema, list or DataFrame, as a DataFrame of what the checks use."""
    if not isinstance(schema, DataFrame):
        schema = [{n: r[n] for n in SCHEMA_PARTS} for r in schema]
    table = joined_table(documents, schema, ", ".join(f"{n} {t}" for n, t in SCHEMA_PARTS.items()))
    return table.select(*SCHEMA_PARTS)


def listed_values(table: DataFrame, scope: str) -> DataFrame:
    """``scope, field, kind, text``: every form of every listed value.

    Equal values of another kind count (1, 1.0 and true); under an empty kind stands the text
    Python would print.
    """

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for at, name, values in zip(*(c.to_pylist() for c in batch.columns)):
                for value in values:
                    found += [(at, name, v["kind"], v["text"] or "") for v in same_values(value)]
                    found.append((at, name, "", printed_value(value)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.string()) for i in range(4)], [scope, "field", "kind", "text"]
            )

    lists = table.where(F.col("permissible").isNotNull()).select(scope, "name", "permissible")
    # One value a row, so that no list of a field is one task's memory.
    single = lists.select(scope, "name", F.explode("permissible").alias("v")).select(scope, "name", F.array("v").alias("permissible"))
    return single.mapInArrow(forms, f"`{scope}` string, field string, kind string, text string").distinct()


class _Cells:
    """The cells of documents beside the schema that each follows."""

    def __init__(self, documents: DataFrame, schema: Config, body: str) -> None:
        self.body = body
        self.places, self.scope, h1, h2 = fresh(documents.columns, "_places", "_scope", "_h1", "_h2")
        self.home = [h1, h2]
        scoped, self.table = with_scope(documents, schema_table(documents, schema), self.scope)
        self.documents = with_body_hash(scoped, body, self.scope, h1, h2)
        cell = F.col("_cell")
        self.rows = unfold(self.documents, [h1, h2, self.scope], body, "_cell", "_pos").select(
            h1, h2, self.scope, "_pos", cell["field"].alias("field"), cell["kind"].alias("kind"),
            F.coalesce(cell["text"], F.lit("")).alias("text"), C.python_text(cell["kind"], cell["text"]).alias("printed"),
        )

    def flagged(self, verdicts: DataFrame, keys: list[str]) -> DataFrame:
        """The documents with ``places``: where the cells with a verdict stand."""
        return flag_cells(self.documents, self.rows, verdicts, self.home, [self.scope, *keys], self.places)

    def done(self, documents: DataFrame) -> DataFrame:
        return documents.drop(self.places, self.scope, *self.home)

    def issues(self) -> Column:
        """The flagged cells as ``array<struct<field, value>>``."""
        wrong = F.filter(F.col(self.body), lambda c, i: F.coalesce(F.array_contains(self.places, i), F.lit(False)))
        return F.transform(
            wrong, lambda c: F.struct(c["field"].alias("field"), C.python_text(c["kind"], c["text"]).alias("value"))
        )

    def unlisted(self, by_text: bool) -> DataFrame:
        """Distinct values of fields with a list that are not on it."""
        limited = self.table.where(F.col("permissible").isNotNull()).select(self.scope, F.col("name").alias("field")).distinct()
        keys = [self.scope, "field", "kind", "text"]
        values = self.rows.where(F.col("kind") != "null") if by_text else self.rows
        values = values.select(*keys, "printed").distinct().join(limited, [self.scope, "field"], "left_semi")
        listed = listed_values(self.table, self.scope)
        wrong = values.join(listed.where(F.col("kind") != ""), keys, "left_anti")
        if by_text:
            texts = listed.where(F.col("kind") == "").select(self.scope, "field", F.col("text").alias("printed"))
            wrong = wrong.join(texts, [self.scope, "field", "printed"], "left_anti")
        return wrong.select(*keys)


def nonpermissible_by_join(documents: DataFrame, schema: Config, body: str, into: str) -> DataFrame:
    cells = _Cells(documents, schema, body)
    found = cells.flagged(cells.unlisted(by_text=True), ["field", "kind", "text"])
    return cells.done(found.withColumn(into, cells.issues()))


def valid_by_join(documents: DataFrame, schema: Config, body: str, into: str) -> DataFrame:
    cells = _Cells(documents, schema, body)
    found = cells.flagged(cells.unlisted(by_text=False), ["field", "kind", "text"])
    ok = F.transform(F.col(body), lambda c, i: ~F.coalesce(F.array_contains(cells.places, i), F.lit(False)))
    return cells.done(found.withColumn(into, ok))


# --- patterns ---------------------------------------------------------------------------------


def pattern_table(table: DataFrame) -> DataFrame:
    """``regex, pattern`` of the distinct patterns: ``pattern`` is the engine's form, null for none.

    Each is translated once, wherever it stands, and the engine itself says whether it takes it.
    """

    def translated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [translate(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["regex", "pattern"])

    distinct = table.where(F.col("regex") != "").select("regex").distinct()
    found = distinct.mapInArrow(translated, "regex string, pattern string")
    whole = F.concat(F.lit(r"\A(?:"), F.col("pattern"), F.lit(r")\z"))
    taken = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), whole)
    return found.select("regex", F.when(taken.isNotNull(), whole).alias("pattern"))


def uncheckable_patterns(schema: DataFrame) -> DataFrame:
    """``profile, field, regex`` of patterns that are invalid or have no counterpart in the engine."""
    patterns = pattern_table(schema)
    return (
        schema.where(F.col("regex") != "").select("profile", F.col("name").alias("field"), "regex")
        .join(patterns.where(F.col("pattern").isNull()).select("regex"), "regex").select("profile", "field", "regex")
    )


def regex_by_join(documents: DataFrame, schema: Config, body: str, into: str) -> DataFrame:
    """Distinct (pattern, text) pairs are brought together by pattern, in ``SALTS`` parts each."""
    cells = _Cells(documents, schema, body)
    fields = (
        cells.table.where(F.col("regex") != "").select(cells.scope, F.col("name").alias("field"), "regex")
        .join(pattern_table(cells.table), "regex").where(F.col("pattern").isNotNull()).drop("regex")
    )
    keys = [cells.scope, "field", "printed"]
    texts = cells.rows.where((F.col("kind") != "null") & ~is_blank(F.col("printed"))).select(*keys).distinct()
    asked = texts.join(fields, [cells.scope, "field"])
    tested = (
        asked.select("pattern", "printed").distinct()
        .withColumn("salt", F.pmod(F.xxhash64("printed"), F.lit(SALTS)))
        .repartition("pattern", "salt").sortWithinPartitions("pattern")
        # Not deterministic, so the sort stays: in order of patterns, each is compiled once in a partition.
        .where(F.spark_partition_id() >= 0)
    )
    broken = tested.where(F.call_function("regexp_extract", F.col("printed"), F.col("pattern"), F.lit(0)) != F.col("printed")).select("pattern", "printed")
    wrong = asked.join(broken, ["pattern", "printed"], "left_semi").select(*keys)
    found = cells.flagged(wrong, ["field", "printed"])
    return cells.done(found.withColumn(into, cells.issues()))
