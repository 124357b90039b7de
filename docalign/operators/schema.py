"""Target schemas: making them from templates, and conforming bodies to them."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.functions.lookup import constant_lookup
from docalign.functions.rows import rows_where, unfold
from docalign.operators.config import Config, Rows, constant_rows, is_joined, profiles_of, scoped_lookup
from docalign.operators.joins import attach_matches, attach_schema
from docalign.operators.listed import printed_value, same_values
from docalign.operators.membership import schema_table, valid_by_join

# Template field types and the types they become.
TEMPLATE_TYPES = {
    "text-field": "text",
    "link-field": "text",
    "controlled-term-field": "categorical",
    "numeric-field": "number",
    "radio-field": "categorical",
    "checkbox-field": "categorical",
    "date-field": "text",
    "datetime-field": "text",
    "email-field": "text",
    "url-field": "text",
}


def template_to_schema(children: DataFrame) -> DataFrame:
    """Target schema rows from the parsed fields of templates.

    ``children`` has ``profile``, ``pos`` and ``field``, the field as cells. A
    field with neither name nor key is left out. ``required`` and
    ``permissible`` come out as values (``struct<kind, text>``).
    """
    def member(name: str) -> Column:
        return C.cell_of(F.col("field"), name)

    # One column per step: each is parsed once, though it is used several times.
    members = children.select(
        "profile",
        "pos",
        F.coalesce(_nonempty(member("name")), _nonempty(member("key"))).alias("name"),
        member("description").alias("description"),
        F.coalesce(member("type")["text"], F.lit("")).alias("source_type"),
        member("configuration")["text"].alias("configuration"),
        member("regex")["text"].alias("regex"),
        member("default").alias("default"),
        member("values").alias("values"),
    )
    has_choices = F.col("source_type").isin("controlled-term-field", "radio-field", "checkbox-field") & (
        F.col("values.kind") == "array"
    )
    parsed = (
        rows_where(members, F.col("name").isNotNull())
        .withColumn("required", C.cell_of(C.parse_cells(F.col("configuration")), "required"))
        .withColumn("described", F.when(F.col("default.kind") == "object", C.parse_cells(F.col("default.text"))))
        .withColumn("choices", F.when(has_choices, C.parse_values(F.col("values.text"))))
        .withColumn("choices", F.transform("choices", _with_labels))
        .withColumn("choices", F.array_compact(F.transform("choices", _permissible)))
    )
    type_of = constant_lookup((((k,), v) for k, v in TEMPLATE_TYPES.items()), "string")
    no_value = _value(F.lit("null"), F.lit(None).cast("string"))
    return parsed.select(
        "profile",
        "pos",
        "name",
        F.when(F.col("description").isNull(), F.lit("")).otherwise(F.col("description.text")).alias("description"),
        F.coalesce(type_of(F.col("source_type")), F.lit("text")).alias("type"),
        F.when(F.col("required").isNull(), _value(F.lit("boolean"), F.lit("false")))
        .otherwise(_value(F.col("required.kind"), F.col("required.text")))
        .alias("required"),
        "regex",
        F.coalesce(_default(), no_value).alias("default_value"),
        F.when(F.size("choices") > 0, F.col("choices")).alias("permissible"),
    )


def _value(kind: Column, text: Column) -> Column:
    return F.struct(kind.alias("kind"), text.alias("text"))


def _nonempty(cell: Column) -> Column:
    return F.when((cell["kind"] == "string") & (cell["text"] != ""), cell["text"])


def _default() -> Column:
    """A default: as it is, or the label or value of a described one."""
    def of(cell: Column) -> Column:
        return F.when(cell.isNotNull(), _value(cell["kind"], cell["text"]))

    label, value = C.cell_of(F.col("described"), "label"), C.cell_of(F.col("described"), "value")
    labelled = (F.col("source_type") == "controlled-term-field") & C.is_true(label)
    described = F.when(labelled, of(label)).otherwise(of(value))
    return F.when(F.col("default.kind") == "object", described).otherwise(of(F.col("default")))


def _with_labels(choice: Column) -> Column:
    """A choice and, if it is an object, its label: null counts as none."""
    def pick(cells: Column) -> Column:
        label = F.get(F.filter(cells, lambda c: (c["field"] == "label") & (c["kind"] != "null")), F.lit(0))
        term = F.get(F.filter(cells, lambda c: (c["field"] == "termLabel") & (c["kind"] != "null")), F.lit(0))
        return F.coalesce(label, term)

    label = F.when(choice["kind"] == "object", C.let(C.parse_cells(choice["text"]), pick))
    return F.struct(choice.alias("choice"), label.alias("label"))


def _permissible(x: Column) -> Column:
    """The value a choice stands for; a label of digits becomes an integer."""
    label, choice = x["label"], x["choice"]
    digits = (label["kind"] == "string") & label["text"].rlike(r"\A\p{Nd}+\z")
    return (
        F.when(choice["kind"].isin("string", "integer", "float", "boolean"), choice)
        .when(label.isNull(), F.lit(None))
        .when(digits, _value(F.lit("integer"), _integer_text(label["text"])))
        .otherwise(_value(label["kind"], label["text"]))
    )


def _integer_text(digits: Column) -> Column:
    """Digits without leading zeros; digits of other scripts become ASCII."""
    # Every script's digits are ten code points in a row, as Python counts digits.
    numbers = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
    ascii_digits = F.translate(digits, "".join(numbers), "".join(str(unicodedata.decimal(n)) for n in numbers))
    return F.regexp_replace(ascii_digits, r"\A0+(?=.)", "")


def children_of_templates(templates: DataFrame) -> DataFrame:
    """Template JSON texts (``profile, content``) as rows of their fields."""
    children = C.cell_of(C.parse_cells(F.col("content")), "children")["text"]
    listed = templates.select("profile", children.alias("children"))
    parsed = (
        unfold(listed, ["profile"], F.from_json("children", "array<string>"), "text", "pos")
        .withColumn("field", C.parse_cells(F.col("text")))
        .drop("text")
    )
    return rows_where(parsed, F.col("field").isNotNull())


# --- conforming -----------------------------------------------------------------


def conform_to_schema(
    documents: DataFrame,
    schema: Config,
    body: str = "modified_metadata",
    into: str = "modified_metadata",
    log: str = "excluded_data",
    lookup: str | None = None,
) -> DataFrame:
    """Exactly the schema's fields, in schema order.

    A field that is there is kept, also as null or ''; only an absent one gets
    the default. What the schema does not know goes to ``log``. A document of a
    profile without a schema stays as it is. ``lookup`` is "constant" or "join", see
    ``operators.config``.
    """
    if is_joined(schema, lookup):
        documents, attached = attach_schema(documents, schema)
        followed, added = F.col(attached), [attached]
        default = lambda f: C.cell(f["name"], f["default_value"]["kind"], f["default_value"]["text"])
        fields = F.transform(followed, default)
        names = F.transform(followed, lambda f: f["name"])
        known = lambda field: F.coalesce(F.array_contains(names, field), F.lit(True))
    else:
        rows = constant_rows(schema)
        if not rows:
            return documents.withColumn(log, F.col(body)).withColumn(into, C.no_cells())
        fields = _schema_of_row(rows)
        known = _fields_of_row(rows)
        added = []
    context = F.struct(
        F.col(body).alias("cells"), C.by_name(F.col(body)).alias("by_name"), fields.alias("fields")
    )

    def conformed(x: Column) -> Column:
        return F.when(x["fields"].isNull(), x["cells"]).otherwise(
            F.transform(x["fields"], lambda f: F.coalesce(F.try_element_at(x["by_name"], f["field"]), f))
        )

    excluded = F.filter(F.col(body), lambda c: ~F.coalesce(known(c["field"]), F.lit(False)))
    return documents.withColumn(log, excluded).withColumn(into, C.let(context, conformed)).drop(*added)


def _schema_of_row(rows: Rows) -> Column:
    """The schema that the row follows, as cells that hold the defaults."""
    fields: dict[str | None, list[dict]] = {}
    for r in sorted(rows, key=lambda r: r["pos"]):
        fields.setdefault(r["profile"], []).append({"field": r["name"], **r["default_value"]})
    return scoped_lookup(((p, ("",), f) for p, f in fields.items()), C.CELLS, profiles_of(rows))(F.lit(""))


def _fields_of_row(rows: Rows):
    """Function of a field: is it in the schema that the row follows?"""
    if all(r["profile"] is not None for r in rows):
        # Without a schema nothing is excluded.
        no_schema = ~F.coalesce(F.col("profile").isin(*profiles_of(rows)), F.lit(False))
    else:
        no_schema = F.lit(False)
    known = scoped_lookup(((r["profile"], (r["name"],), True) for r in rows), "boolean", profiles_of(rows))
    return lambda field: no_schema | known(field)


# --- lookups per cell --------------------------------------------------------------


def validate_values(
    documents: DataFrame, schema: Config, body: str = "modified_metadata", into: str = "valid", lookup: str | None = None
) -> DataFrame:
    """One boolean per cell: is the value among the permissible ones?

    Fields that are unknown or have no list are valid. Values are compared with
    their types, so the text "1" is not the number 1. ``lookup`` is "constant" or
    "join", see ``operators.config``.
    """
    if is_joined(schema, lookup):
        return valid_by_join(documents, schema, body, into)
    rows = constant_rows(schema)
    limited, member = permissible_lookups(rows)

    def ok(c: Column) -> Column:
        return ~limited(c["field"]) | member(c["field"], c["kind"], F.coalesce(c["text"], F.lit("")))

    return documents.withColumn(into, F.transform(F.col(body), ok))


def permissible_lookups(rows: Rows, by_text: bool = False):
    """Functions: has a field a list, and is a value on it.

    Values are looked up by kind and text, and with ``by_text`` also by an empty
    kind and the text Python would print for them.
    """
    profiles = profiles_of(rows)
    with_list = [r for r in rows if r["permissible"] is not None]
    pairs = []
    for r in with_list:
        for value in r["permissible"]:
            for v in same_values(value):
                pairs.append((r["profile"], (r["name"], v["kind"], v["text"] or ""), True))
            if by_text:
                pairs.append((r["profile"], (r["name"], "", printed_value(value)), True))
    has = scoped_lookup(((r["profile"], (r["name"],), True) for r in with_list), "boolean", profiles)
    on = scoped_lookup(pairs, "boolean", profiles)
    return (
        lambda field: F.coalesce(has(field), F.lit(False)),
        lambda field, kind, text: F.coalesce(on(field, kind, text), F.lit(False)),
    )


def attach_schema_facets(
    documents: DataFrame, schema: Config, body: str = "modified_metadata", into: str = "facets", lookup: str | None = None
) -> DataFrame:
    """Per cell whether its field is required, and the field's default.

    ``array<struct<field, kind, text, required, default_kind, default_text>>``;
    an unknown field is not required and has a null default. ``lookup`` is "constant"
    or "join", see ``operators.config``.
    """
    if is_joined(schema, lookup):
        default = F.col("default_value")
        facets = F.struct("required", default["kind"].alias("default_kind"), default["text"].alias("default_text"))
        table = schema_table(documents, schema).withColumn("facet", facets)
        documents, match = attach_matches(documents, table, body, {"name": lambda c: c["field"]}, "facet")
        return documents.withColumn(into, F.zip_with(F.col(body), F.col(match), _with_facet)).drop(match)
    rows = constant_rows(schema)
    facet = scoped_lookup(
        (
            (
                r["profile"],
                (r["name"],),
                {
                    "required": r["required"],
                    "default_kind": r["default_value"]["kind"],
                    "default_text": r["default_value"]["text"],
                },
            )
            for r in rows
        ),
        "struct<required:boolean,default_kind:string,default_text:string>",
        profiles_of(rows),
    )

    return documents.withColumn(into, F.transform(F.col(body), lambda c: _with_facet(c, facet(c["field"]))))


def _with_facet(c: Column, found: Column) -> Column:
    return F.struct(
        c["field"].alias("field"),
        c["kind"].alias("kind"),
        c["text"].alias("text"),
        F.coalesce(found["required"], F.lit(False)).alias("required"),
        F.coalesce(found["default_kind"], F.lit("null")).alias("default_kind"),
        found["default_text"].alias("default_text"),
    )
