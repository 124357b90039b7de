"""Readers for crosswalks, field maps, value maps, rules and target schemas.

Every reader is a text scan followed by a function on ``(profile, source_file,
stem, content)`` rows, so a catalog of any size, kept in files or in a table,
goes through the same expressions. Files are taken in path order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.functions.rows import rows_where, unfold
from docalign.operators.fields import merge_field_maps
from docalign.operators.values import normalize_value_map
from docalign.sources.files import scan_text


def _checked(array: Column, ok: Column, message: str) -> Column:
    """``array``, or an error that names the file."""
    text = F.concat(F.lit(f"{message}: "), F.coalesce("source_file", F.lit("?")))
    return F.when(ok, array).otherwise(F.raise_error(text))


def _array_text() -> Column:
    """The content if it is one JSON array and nothing else, else null.

    As the only member of an object it goes through the strict parser of documents, which
    keeps its text. The first character tells an array from a string; whatever does not start
    like an array takes the way through the kinds of values.
    """
    text = F.concat(F.lit('{"x":'), F.col("content"), F.lit("}"))
    raw = C.only_member(text, "x")
    starts = F.col("content").rlike(r"\A[ \t\n\r]*\[")
    by_kind = C.let(
        C.parse_cells(text),
        lambda c: F.when((F.size(c) == 1) & (c[0]["field"] == "x") & (c[0]["kind"] == "array"), c[0]["text"]),
    )
    return F.when(starts & raw.startswith("["), raw).otherwise(by_kind)


# --- crosswalks ---------------------------------------------------------------


def read_crosswalk(spark: SparkSession, path: str | list[str], profile: str | None = None) -> DataFrame:
    """Crosswalk CSV files as unpivoted rows, see ``crosswalk_cells``."""
    return crosswalk_cells(scan_text(spark.read, path, "*.csv", profile=profile))


def crosswalk_cells(files: DataFrame) -> DataFrame:
    """``profile, source_file, row_no, col_no, schema_version, target, legacy``.

    Column 1 of the CSV is the target, every further column holds the legacy
    name in one older schema version. Rows may be ragged; numbering starts at 1
    and leaves out the header. Cells are kept as they are, blanks included.
    """
    shaped = files.select("profile", "source_file", _crosswalk_lines().alias("rows"))
    data = F.slice("rows", F.lit(2), F.size("rows"))
    checked = unfold(
        shaped,
        ["profile", "source_file", F.get("rows", F.lit(0)).alias("header")],
        _checked(data, _enough(F.col("rows")), "a crosswalk needs a header, a row and two columns"),
        "row",
        "row_pos",
    )
    return checked.select(
        "profile",
        "source_file",
        (F.col("row_pos") + 1).alias("row_no"),
        "header",
        F.get("row", F.lit(0)).alias("target"),
        # A row with a target only stays, as one row without a legacy name.
        F.posexplode_outer(F.slice("row", F.lit(2), F.size("row"))).alias("col_pos", "legacy"),
    ).withColumn("col_no", F.coalesce(F.col("col_pos") + 1, F.lit(1))).select(
        "profile",
        "source_file",
        "row_no",
        "col_no",
        F.get("header", F.col("col_no")).alias("schema_version"),
        "target",
        "legacy",
    )


def crosswalk_is_whole() -> Column:
    """Whether the content has a header of two columns and a row."""
    return F.coalesce(_enough(_crosswalk_lines()), F.lit(False))


def _enough(rows: Column) -> Column:
    return C.let(rows, lambda r: (F.size(r) >= 2) & (F.size(F.get(r, F.lit(0))) >= 2))


def _crosswalk_lines() -> Column:
    """The content as an array of rows, each an array of fields."""
    # A quote opens a quoted field at the start of a field only; what stands behind the
    # closing quote belongs to the field as it is. Blank lines are no rows.
    field = r'(?:"(?:[^"]++|"")*+(?:"[^,\r\n]*+|\z)|[^",\r\n][^,\r\n]*+|)'
    line = rf"{field}(?:,{field})*+"
    item = rf",({field})"
    quoted = r'(?s)\A"((?:[^"]++|"")*+)"?(.*)\z'

    def unquoted(text: Column) -> Column:
        inner = F.replace(F.regexp_extract(text, quoted, 1), F.lit('""'), F.lit('"'))
        return F.when(text.startswith('"'), F.concat(inner, F.regexp_extract(text, quoted, 2))).otherwise(text)

    lines = F.filter(F.regexp_extract_all("content", F.lit(line), F.lit(0)), lambda text: text != "")
    return F.transform(
        lines,
        lambda text: F.transform(
            F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(item), F.lit(1)), unquoted
        ),
    )


# --- field maps ---------------------------------------------------------------


def read_field_map(spark: SparkSession, path: str, profile: str | None = None) -> DataFrame:
    """One field map file; it must be a ``.json`` file with an object."""
    if not path.lower().endswith(".json"):
        raise ValueError(f"a field map must be a JSON file: {path}")
    return field_map_entries(scan_text(spark.read, path, None, profile=profile))


def read_field_maps(spark: SparkSession, path: str, profile: str | None = None) -> DataFrame:
    """All field map files of a folder as one map; the first mapping of a name wins."""
    entries = field_map_entries(scan_text(spark.read, path, "*.json", profile=profile))
    return merge_field_maps(entries).select("profile", "legacy", "target")


def field_map_entries(files: DataFrame) -> DataFrame:
    """``profile, source_file, pos, legacy, target``; a target may be null."""
    cells = C.parse_cells(F.col("content"))
    parsed = files.select("profile", "source_file", cells.alias("cells"))
    members = _checked(F.col("cells"), F.col("cells").isNotNull(), "a field map must be a JSON object")
    return unfold(parsed, ["profile", "source_file"], members, "c", "pos").select(
        "profile", "source_file", "pos", F.col("c.field").alias("legacy"), F.col("c.text").alias("target")
    )


# --- value maps ---------------------------------------------------------------


def read_value_maps(spark: SparkSession, path: str, profile: str | None = None) -> DataFrame:
    """Value map files of a folder, merged by ``normalize_value_map``."""
    return normalize_value_map(value_map_entries(scan_text(spark.read, path, "*.json", profile=profile)))


def value_map_entries(files: DataFrame) -> DataFrame:
    """Top-level members of value map files.

    ``profile, source_file, stem, pos, key, kind, text`` where ``text`` of a
    nested map is its JSON.
    """
    cells = C.parse_cells(F.col("content"))
    parsed = files.select("profile", "source_file", "stem", cells.alias("cells"))
    members = _checked(F.col("cells"), F.col("cells").isNotNull(), "a value map must be a JSON object")
    return unfold(parsed, ["profile", "source_file", "stem"], members, "c", "pos").select(
        "profile", "source_file", "stem", "pos", F.col("c.field").alias("key"), "c.kind", "c.text"
    )


# --- rules --------------------------------------------------------------------


def read_rules(
    spark: SparkSession,
    folder: str | None = None,
    file: str | None = None,
    profile: str | None = None,
) -> DataFrame:
    """Rules of a folder, searched with its subfolders, then those of a file."""
    parts = []
    if folder is not None:
        parts.append(scan_text(spark.read, folder, "*.json", recursive=True, profile=profile).withColumn("part", F.lit(0)))
    if file is not None:
        parts.append(scan_text(spark.read, file, None, profile=profile).withColumn("part", F.lit(1)))
    if not parts:
        raise ValueError("give a folder or a file of rules")
    files = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rule_entries(files)


def rule_entries(files: DataFrame) -> DataFrame:
    """``profile, part, source_file, pos, when, then``, the last two as JSON.

    Each file holds an array of rules. They apply in the order of ``part``,
    ``source_file`` and ``pos``.
    """
    listed = F.from_json(_array_text(), "array<struct<when:string,then:string>>")
    parsed = files.select(
        "profile",
        "source_file",
        (F.col("part") if "part" in files.columns else F.lit(0)).alias("part"),
        listed.alias("rules"),
    )
    is_list = F.col("rules").isNotNull()
    found = _checked(F.col("rules"), is_list, "a rule file must hold a JSON array")
    return unfold(parsed, ["profile", "part", "source_file"], found, "r", "pos").select("profile", "part", "source_file", "pos", F.col("r.when").alias("when"), F.col("r.then").alias("then"))


# --- target schemas -------------------------------------------------------------


def read_target_schema(spark: SparkSession, path: str, profile: str | None = None) -> DataFrame:
    """A target schema file as rows, see ``schema_entries``."""
    pattern = None if path.lower().endswith(".json") else "*.json"
    return schema_entries(scan_text(spark.read, path, pattern, profile=profile))


def schema_entries(files: DataFrame) -> DataFrame:
    """Field definitions of target schema files.

    ``profile, pos, name, description, type, required, required_strict, regex,
    default_value, permissible``. Entries that are no object or have no name are
    left out; a repeated name keeps its first place and its last definition.
    ``required_strict`` is true only for a literal ``true``.
    """
    parsed = files.select("profile", "source_file", F.from_json(_array_text(), "array<string>").alias("items"))
    is_list = F.col("items").isNotNull()
    found = _checked(F.col("items"), is_list, "a target schema must be a JSON array")
    cells = unfold(parsed, ["profile", "source_file"], found, "item", "pos").select(
        "profile", "source_file", "pos", C.parse_cells(F.col("item")).alias("c")
    )
    named = rows_where(cells, C.cell_of(F.col("c"), "name")["text"] != "")
    fields = named.select(
        "profile",
        F.struct("source_file", "pos").alias("place"),
        C.cell_of(F.col("c"), "name")["text"].alias("name"),
        definition(F.col("c")).alias("definition"),
    )
    # Aggregates instead of a window: both are combined before the shuffle.
    return (
        fields.groupBy("profile", "name")
        .agg(F.min("place.pos").alias("pos"), F.max_by("definition", "place").alias("d"))
        .select("profile", "pos", "name", "d.*")
    )


def definition(cells: Column) -> Column:
    """The attributes of one field definition, with their defaults."""
    def member(name: str) -> Column:
        return C.cell_of(cells, name)

    required = member("required")
    default = member("default_value")
    permissible = member("permissible_values")
    return F.struct(
        F.coalesce(member("description")["text"], F.lit("")).alias("description"),
        F.coalesce(member("type")["text"], F.lit("text")).alias("type"),
        C.is_true(required).alias("required"),
        F.coalesce((required["kind"] == "boolean") & (required["text"] == "true"), F.lit(False)).alias(
            "required_strict"
        ),
        member("regex")["text"].alias("regex"),
        F.struct(
            F.coalesce(default["kind"], F.lit("null")).alias("kind"), default["text"].alias("text")
        ).alias("default_value"),
        F.when(permissible["kind"] == "array", C.parse_values(permissible["text"])).alias("permissible"),
    )
