"""Ordered cells: how an open document body is held in a column.

A body is ``array<struct<field, kind, text>>`` in document order. ``kind`` is
the JSON kind; ``text`` is the content of a string, the text of a number or
boolean, compact JSON for nested values, and null for JSON null. A field that
is absent has no cell, so absent, null and '' stay apart. Two values are equal
when kind and text are.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE = "struct<kind:string,text:string>"
CELL = "struct<field:string,kind:string,text:string>"
CELLS = f"array<{CELL}>"

# Spark also reads quotes of the wrong sort; plain JSON does not have them.
_STRICT = {"allowSingleQuotes": "false"}
_NUMBER = r"\A-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?\z"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``.

    Without it, the optimizer may copy ``value`` into a lambda, where it is
    evaluated once per array element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def cell(field: Column, kind: Column, text: Column) -> Column:
    return F.struct(field.alias("field"), kind.alias("kind"), text.alias("text"))


def no_cells() -> Column:
    return F.array().cast(CELLS)


def names(cells: Column) -> Column:
    return cells["field"]


def cell_of(cells: Column, field: str) -> Column:
    """The cell of ``field``, null when it is absent."""
    return F.get(cells, F.array_position(names(cells), F.lit(field)).cast("int") - 1)


def by_name(cells: Column) -> Column:
    """The cells as a map, for lookups inside lambdas."""
    return F.map_from_arrays(names(cells), cells)


def is_true(cell: Column) -> Column:
    """Whether a value counts as true: not absent, null, false, zero or empty."""
    full_text = (cell["kind"] == "string") & (cell["text"] != "")
    other = ~cell["kind"].isin("string", "null") & ~cell["text"].isin(
        "false", "0", "0.0", "-0.0", "[]", "{}"
    )
    return F.coalesce(full_text | other, F.lit(False))


# --- values on the driver -------------------------------------------------


def value_of(value: Any) -> dict[str, str | None]:
    """Kind and text of a Python value that came from JSON."""
    if value is None:
        return {"kind": "null", "text": None}
    if isinstance(value, bool):
        return {"kind": "boolean", "text": "true" if value else "false"}
    if isinstance(value, int):
        return {"kind": "integer", "text": str(value)}
    if isinstance(value, float):
        return {"kind": "float", "text": repr(value)}
    if isinstance(value, str):
        return {"kind": "string", "text": value}
    kind = "array" if isinstance(value, list) else "object"
    return {"kind": kind, "text": json.dumps(value, ensure_ascii=False, separators=(",", ":"))}


def equal_values(value: Any) -> list[dict[str, str | None]]:
    """All values that are equal to ``value``: 1, 1.0 and true are the same."""
    found = [value_of(value)]
    if isinstance(value, (bool, int, float)):
        if value == value and abs(value) != float("inf") and value == int(value):
            found.append(value_of(int(value)))
            if float(int(value)) == int(value):
                found.append(value_of(float(value)))
        if value == 0:
            found += [value_of(0.0), value_of(-0.0)]
        if value in (0, 1):
            found.append(value_of(bool(value)))
    return [v for i, v in enumerate(found) if v not in found[:i]]


# --- reading ----------------------------------------------------------------


def float_text(number: Column) -> Column:
    """A double as Python writes it: 1e-05, 12345678.9, 1e+16."""
    plain = number.cast("string")
    mantissa = F.substring_index(plain, "E", 1)
    power = F.substring_index(plain, "E", -1).cast("int")
    sign = F.when(mantissa.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(mantissa, r"^-|\.0$|\.", "")
    whole = F.rpad(digits, power + 1, "0")
    fraction = F.substring(digits, power + 2, F.length(digits))
    large = F.concat(
        F.substring(whole, F.lit(1), power + 1),
        F.lit("."),
        F.when(fraction == "", F.lit("0")).otherwise(fraction),
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    scientific = F.concat(
        F.regexp_replace(F.regexp_replace(mantissa, r"\.0$", ""), "^-", ""),
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), F.lit("0")),
    )
    return (
        F.when(~plain.contains("E"), plain)
        .when((power >= 0) & (power < 16), F.concat(sign, large))
        .when((power < 0) & (power >= -4), F.concat(sign, small))
        .otherwise(F.concat(sign, scientific))
    )


def _classify(field: Column, value: Column, kind: Column, raw: Column) -> Column:
    """One cell from a variant, its type, and its raw text where that is needed.

    Nested values are told by their type; printing them only to look at them would cost most
    of the parse.
    """
    number = F.variant_get(value, "$", "double")
    digits_only = F.coalesce(raw.rlike(r"\A-?\d+\z"), kind == "BIGINT")
    return (
        F.when(kind == "STRING", cell(field, F.lit("string"), F.variant_get(value, "$", "string")))
        .when(kind == "VOID", cell(field, F.lit("null"), F.lit(None).cast("string")))
        .when(kind == "BOOLEAN", cell(field, F.lit("boolean"), F.to_json(value)))
        .when(kind.startswith("OBJECT"), cell(field, F.lit("object"), raw))
        .when(kind.startswith("ARRAY"), cell(field, F.lit("array"), raw))
        .when(digits_only, cell(field, F.lit("integer"), F.coalesce(raw, F.to_json(value))))
        # A number that is not finite prints as a string.
        .when(F.to_json(value).startswith('"'), cell(field, F.lit("string"), F.variant_get(value, "$", "string")))
        .otherwise(cell(field, F.lit("float"), float_text(number)))
    )


def _one_object(text: Column, value_type: str) -> Column:
    """``text`` as a map when it is exactly one JSON object, else null.

    ``from_json`` ignores whatever follows the first value. The empty object
    added behind it must come out as the second and last one.
    """
    wrapped = F.concat(F.lit("["), text, F.lit(",{}]"))
    parsed = F.from_json(wrapped, f"array<map<string,{value_type}>>", _STRICT)
    first, second = F.lit(0), F.lit(1)
    return let(parsed, lambda p: F.when((F.size(p) == 2) & (F.size(F.get(p, second)) == 0), F.get(p, first)))


def _last_wins(cells: Column) -> Column:
    """A repeated JSON key keeps its first place and its last value."""
    return let(
        cells,
        lambda c: F.when(
            F.size(F.array_distinct(names(c))) == F.size(c), c
        ).otherwise(
            F.transform(
                F.array_distinct(names(c)),
                lambda n: F.element_at(F.filter(c, lambda x: x["field"] == n), -1),
            )
        ),
    )


def _by_look(field: Column, raw: Column) -> Column:
    """One cell from raw text alone, which does not tell "1" from 1."""
    kind = (
        F.when(raw.isNull(), F.lit("null"))
        .when(raw.isin("true", "false"), F.lit("boolean"))
        .when(raw.rlike(r"\A-?\d+\z"), F.lit("integer"))
        .when(raw.rlike(_NUMBER), F.lit("float"))
        .when(raw.startswith("{"), F.lit("object"))
        .when(raw.startswith("["), F.lit("array"))
        .otherwise(F.lit("string"))
    )
    return cell(field, kind, raw)


def parse_cells(text: Column, raws: Column | None = None) -> Column:
    """Cells of a JSON object text, in document order; null if it is none.

    ``raws`` are the entries of its raw texts, where the caller has parsed them already.
    """
    if raws is None:
        raws = F.map_entries(_one_object(text, "string"))
    needs_raw = r"\A(?:OBJECT|ARRAY|DOUBLE|DECIMAL\((?:19|[23]\d))"
    typed = F.transform(
        F.map_entries(_one_object(text, "variant")),
        lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value"), F.schema_of_variant(x["value"]).alias("type")),
    )
    with_raw = let(
        typed,
        lambda e: F.struct(
            e.alias("entries"),
            # A second parse keeps nested text and long numbers as written. It
            # also stands in where a nested object repeats a key, which a
            # variant cannot hold.
            F.when(
                e.isNull() | F.exists(e, lambda x: x["type"].rlike(needs_raw)),
                raws,
            ).alias("raws"),
        ),
    )
    cells = let(
        with_raw,
        lambda p: F.coalesce(
            F.transform(
                p["entries"], lambda e, i: _classify(e["key"], e["value"], e["type"], F.get(p["raws"], i)["value"])
            ),
            F.transform(p["raws"], lambda e: _by_look(e["key"], e["value"])),
        ),
    )
    return _last_wins(cells)


def only_member(text: Column, name: str) -> Column:
    """The raw text of the only member of an object text; null if it is no such object."""
    return let(
        F.map_entries(_one_object(text, "string")),
        lambda e: F.when((F.size(e) == 1) & (F.get(e, F.lit(0))["key"] == name), F.get(e, F.lit(0))["value"]),
    )


def parse_head(text: Column, body: str) -> Column:
    """Cells of a whole document, in which ``body`` keeps its raw text.

    The raw texts suffice unless one of them could be a string as well as
    something else: most documents are spared a parse of their kinds.
    """
    def unclear(e: Column) -> Column:
        look = e["value"].rlike(rf"(?s)\A(?:true|false|[\[{{].*)\z|{_NUMBER}")
        return (e["key"] != body) & F.coalesce(look, F.lit(False))

    quoted_body = text.rlike(rf'"{body}"\s*:\s*"')
    entries = F.map_entries(_one_object(text, "string"))
    return let(
        entries,
        lambda raws: F.when(
            quoted_body | F.exists(raws, unclear), parse_cells(text, raws)
        ).otherwise(_last_wins(F.transform(raws, lambda e: _by_look(e["key"], e["value"])))),
    )


def parse_values(text: Column) -> Column:
    """A JSON array as ``array<struct<kind, text>>``; null if it is none."""
    def one(x: Column, raw: Column) -> Column:
        made = _classify(F.lit(""), x["value"], x["type"], raw)
        return let(made, lambda m: F.struct(m["kind"].alias("kind"), m["text"].alias("text")))

    # Both parses stand outside of the lambda, which would repeat them for each value.
    typed = F.transform(
        F.from_json(text, "array<variant>", _STRICT),
        lambda v: F.struct(v.alias("value"), F.schema_of_variant(v).alias("type")),
    )
    both = F.struct(typed.alias("values"), F.from_json(text, "array<string>", _STRICT).alias("raws"))
    return let(both, lambda b: F.transform(b["values"], lambda x, i: one(x, F.get(b["raws"], i))))


# --- writing ----------------------------------------------------------------


def escaped(text: Column) -> Column:
    """The inside of a JSON string literal; only rare texts need the escape."""
    inside = F.to_json(F.array(text))
    return F.when(
        text.rlike(r'["\\\x00-\x1f]'), F.substring(inside, F.lit(3), F.length(inside) - 4)
    ).otherwise(text)


def json_string(text: Column) -> Column:
    """A JSON string literal; characters outside ASCII stay as they are."""
    return F.concat(F.lit('"'), escaped(text), F.lit('"'))


def json_value(kind: Column, text: Column) -> Column:
    """The JSON literal of a value."""
    return (
        F.when(kind == "string", json_string(text))
        .when(kind == "null", F.lit("null"))
        .otherwise(text)
    )


def json_member(name: Column, value: Column) -> Column:
    """Pieces of an object member; ``value`` has ``kind`` and ``text``.

    Rendering collects pieces in arrays and joins them once: inside a lambda
    that is far cheaper than building up strings.
    """
    start = [F.lit(',"'), escaped(name), F.lit('"')]
    return (
        F.when(value["kind"] == "string", F.array(*start, F.lit(':"'), escaped(value["text"]), F.lit('"')))
        .when(value["kind"] == "null", F.array(*start, F.lit(":null")))
        .otherwise(F.array(*start, F.lit(":"), value["text"]))
    )


def json_item(value: Column) -> Column:
    """Pieces of an array item."""
    return (
        F.when(value["kind"] == "string", F.array(F.lit(',"'), escaped(value["text"]), F.lit('"')))
        .when(value["kind"] == "null", F.array(F.lit(",null")))
        .otherwise(F.array(F.lit(","), value["text"]))
    )


def enclosed(items: Column, left: str, right: str) -> Column:
    """Join arrays of pieces, each of which starts with a comma."""
    joined = F.array_join(F.flatten(items), "")
    return F.concat(F.lit(left), F.substring(joined, 2, 2**31 - 1), F.lit(right))


#: A JSON string, and what follows the key of a value's kind: its JSON literal as one of three
#: groups. A nested text counts if nothing in it was escaped.
QUOTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
KIND_AND_TEXT = rf'(?:"string","text":({QUOTED})|"(null)"|"(?!string"|null")[^"\\]*+","text":"([^"\\]*+)")'


def printed_whole(items: Column, pattern: str, replacement: str, left: str, brackets: str, piecewise: Column) -> Column:
    """An array of structs as JSON text of another layout.

    The engine prints the array, which escapes all of its texts, and one replacement lays the
    items out. Quotes inside of texts are escaped, so the names in a pattern are met only where
    they are names. What the pattern does not cover, told by the text ``left`` that stays, is
    rendered ``piecewise``, item by item.
    """
    def laid_out(t: Column) -> Column:
        inside = F.substring(t, F.lit(2), F.length(t) - 2)
        return F.when(t.contains(left), piecewise).otherwise(F.concat(F.lit(brackets[0]), inside, F.lit(brackets[1])))

    return let(F.regexp_replace(F.to_json(items), F.lit(pattern), F.lit(replacement)), laid_out)


def json_object(cells: Column) -> Column:
    """Cells as JSON object text, in their order."""
    piecewise = enclosed(F.transform(cells, lambda c: json_member(c["field"], c)), "{", "}")
    return printed_whole(cells, rf'\{{"field":({QUOTED}),"kind":{KIND_AND_TEXT}\}}', "$1:$2$3$4", '{"', "{}", piecewise)


def json_array(values: Column) -> Column:
    """Values (``kind``, ``text``) as JSON array text."""
    return enclosed(F.transform(values, json_item), "[", "]")


def _nested_text(text: Column) -> Column:
    """Compact JSON as Python prints it: ['a', 1, None]."""
    token = r'"(?:[^"\\]|\\.)*+"|[\[\]{},:]|[^\s\[\]{},:"]++'

    def one(t: Column) -> Column:
        content = F.variant_get(F.try_parse_json(t), "$", "string")
        escaped = F.replace(content, F.lit("\\"), F.lit("\\\\"))
        for char, code in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            escaped = F.replace(escaped, F.lit(char), F.lit(code))
        quoted = F.when(
            content.contains("'") & ~content.contains('"'),
            F.concat(F.lit('"'), escaped, F.lit('"')),
        ).otherwise(F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")))
        return (
            F.when(t.startswith('"'), quoted)
            .when(t == ",", F.lit(", "))
            .when(t == ":", F.lit(": "))
            .when(t == "true", F.lit("True"))
            .when(t == "false", F.lit("False"))
            .when(t == "null", F.lit("None"))
            .when(t.rlike(r"[.eE]"), float_text(t.cast("double")))
            .otherwise(t)
        )

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(token), F.lit(0)), one), "")


def python_text(kind: Column, text: Column) -> Column:
    """``str(value)`` as a lookup key; null for JSON null."""
    return (
        F.when(kind == "boolean", F.when(text == "true", F.lit("True")).otherwise(F.lit("False")))
        .when(kind.isin("array", "object"), _nested_text(text))
        .otherwise(text)
    )
