"""The difference of two bodies down into nested values, and its inverse.

Changed fields whose values are both objects or both arrays become rows, one for each pair of
values; a pair is replaced by rows of its members, level by level, until single values are
left. Members of objects meet by name. Elements of arrays are aligned by a longest common
subsequence; what stands between two aligned elements is paired in order, the rest is removed
or added.

Operations come in an order in which they can be applied one after the other: replacements
first and removals next, the last one first, both at the places of the old body; then
additions, the first one first, at the places of the new body.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.functions.rows import unfold
from docalign.operators.joins import fresh

OPERATION = "struct<op:string,path:string,kind:string,text:string>"
# A pair or an operation: places in both bodies as parts (".name" or "#index", padded so that it sorts), values before and after.
ITEM = "struct<op:string,old_at:array<string>,new_at:array<string>,kind:string,old:string,text:string>"
PADDED = 12


def diff_nested(
    documents: DataFrame, old: str = "metadata", new: str = "modified_metadata", into: str = "json_patch", depth: int = 4
) -> DataFrame:
    """Operations that turn ``old`` into ``new``, also inside nested values.

    ``array<struct<op, path, kind, text>>`` with ``add``, ``remove`` and ``replace``. Values
    nested deeper than ``depth`` levels are replaced whole. A document's rows come home by a
    hash of both bodies; documents without changed nested values send none.
    """
    h1, h2, items, inner = fresh(documents.columns, "_h1", "_h2", "_items", "_inner")
    hashed = documents.withColumn(h1, F.xxhash64(old, new)).withColumn(h2, F.xxhash64(new, old))
    top = F.struct(F.array().cast("array<string>").alias("old_at"), F.array().cast("array<string>").alias("new_at"))
    changed = hashed.withColumn(items, members(top, F.col(old), F.col(new)))
    pairs = F.filter(items, lambda x: x["op"] == "pair")
    rows = unfold(changed, [h1, h2], pairs, "x").distinct()
    for _ in range(depth):
        rows = unfold(_parsed(rows, h1, h2), [h1, h2], _one_level_down(), "x")
    rows = rows.where(F.col("x.op") != "same")
    home = rows.groupBy(h1, h2).agg(F.collect_list("x").alias(inner))
    here = F.filter(items, lambda x: ~x["op"].isin("pair", "same"))
    every = F.concat(here, F.coalesce(F.col(inner), F.slice(here, 1, 0)))
    done = changed.join(home, [h1, h2], "left").withColumn(into, F.when(F.col(items).isNotNull(), C.let(every, in_order)))
    return done.drop(h1, h2, items, inner)


def members(at: Column, old: Column, new: Column) -> Column:
    """Items of two lists of cells, by name."""
    both = F.struct(
        C.names(old).alias("old_names"), C.names(new).alias("new_names"), C.by_name(old).alias("old"), C.by_name(new).alias("new"),
    )

    def one(x: Column, name: Column) -> Column:
        part = F.concat(F.lit("."), name)
        return item(at, part, part, F.try_element_at(x["old"], name), F.try_element_at(x["new"], name))

    return C.let(both, lambda x: F.transform(F.array_union(x["old_names"], x["new_names"]), lambda n: one(x, n)))


def item(at: Column, old_part: Column, new_part: Column, before: Column, after: Column) -> Column:
    """What became of one value: nothing, one operation, or a pair to look into."""
    same = (before["kind"] == after["kind"]) & before["text"].eqNullSafe(after["text"])
    nested = (before["kind"] == after["kind"]) & after["kind"].isin("object", "array")
    op = (
        F.when(before.isNull(), F.lit("add")).when(after.isNull(), F.lit("remove"))
        .when(same, F.lit("same")).when(nested, F.lit("pair")).otherwise(F.lit("replace"))
    )
    return F.struct(
        op.alias("op"),
        F.concat(at["old_at"], F.array(old_part)).alias("old_at"),
        F.concat(at["new_at"], F.array(new_part)).alias("new_at"),
        after["kind"].alias("kind"),
        before["text"].alias("old"),
        after["text"].alias("text"),
    ).cast(ITEM)


def _parsed(rows: DataFrame, *keep: str) -> DataFrame:
    """The two values of each pair, parsed once: as cells or as elements."""
    x = F.col("x")
    when = lambda kind, parse, side: F.when((x["op"] == "pair") & (x["kind"] == kind), parse(x[side]))
    return rows.select(
        *keep, "x",
        when("object", C.parse_cells, "old").alias("old_cells"), when("object", C.parse_cells, "text").alias("new_cells"),
        when("array", C.parse_values, "old").alias("old_values"), when("array", C.parse_values, "text").alias("new_values"),
    )


def _one_level_down() -> Column:
    """A row's item as the items of its members; an operation as it is."""
    x = F.col("x")
    is_object, is_array = F.col("new_cells").isNotNull(), F.col("new_values").isNotNull()
    of_object = members(x, F.col("old_cells"), F.col("new_cells"))
    values = F.struct(F.col("old_values").alias("old"), F.col("new_values").alias("new"))
    texts = lambda side: F.transform(side, lambda v: F.concat(v["kind"], F.lit(":"), F.coalesce(v["text"], F.lit(""))))
    script = aligned()(texts("old_values"), texts("new_values"))
    # An element keeps its place in the old and in the new array.
    part = lambda i: F.concat(F.lit("#"), F.lpad(i.cast("string"), PADDED, "0"))
    context = F.struct(values.alias("v"), script.alias("script"))

    def element(c: Column, s: Column) -> Column:
        before = F.when(s["i"] >= 0, F.get(c["v"]["old"], s["i"]))
        after = F.when(s["j"] >= 0, F.get(c["v"]["new"], s["j"]))
        return item(x, part(F.greatest(s["i"], F.lit(0))), part(F.greatest(s["j"], F.lit(0))), before, after)

    of_array = C.let(context, lambda c: F.transform(c["script"], lambda s: element(c, s)))
    none = F.array().cast(f"array<{ITEM}>")
    inside = F.when(is_object, of_object).when(is_array, of_array)
    # A pair without any difference (members in another order) leaves a row that says so.
    same = F.array(F.struct(F.lit("same").alias("op"), *[x[n].alias(n) for n in ("old_at", "new_at", "kind", "old", "text")]).cast(ITEM))
    return F.when(is_object | is_array, C.let(F.coalesce(inside, none), lambda i: F.when(F.size(i) > 0, i).otherwise(same))).otherwise(F.array(x))


def aligned():
    """Function of two lists of texts: how they are aligned, without equal elements at equal texts."""

    @F.pandas_udf("array<struct<i:int,j:int>>")
    def script(old, new):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([None if a is None else [{"i": i, "j": j} for i, j in edit_script(list(a), list(b))] for a, b in zip(old, new)])

    return script


def edit_script(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Changed elements: ``(i, j)`` is paired, ``(i, -1)`` removed and ``(-1, j)`` added."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    found, i, j = [], start, start
    middle = [(i + start, j + start) for i, j in common(a[start : len(a) - end], b[start : len(b) - end])]
    for match_i, match_j in [*middle, (len(a) - end, len(b) - end)]:
        both = min(match_i - i, match_j - j)
        found += [(i + k, j + k) for k in range(both)]
        found += [(k, -1) for k in range(i + both, match_i)]
        found += [(-1, k) for k in range(j + both, match_j)]
        i, j = match_i + 1, match_j + 1
    return found


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence: longest increasing places of equal elements."""
    places: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    chains: list[tuple] = []
    for i, text in enumerate(a):
        for j in places.get(text, ()):
            at = bisect_left(ends, j)
            chain = (i, j, chains[at - 1] if at else None)
            if at == len(ends):
                ends.append(j)
                chains.append(chain)
            else:
                ends[at], chains[at] = j, chain
    found, chain = [], chains[-1] if chains else None
    while chain:
        found.append(chain[:2])
        chain = chain[2]
    return found[::-1]


def in_order(items: Column) -> Column:
    """Operations in the order in which they apply, with pointers."""
    def only(op: str, at: str) -> Column:
        chosen = F.filter(items, lambda x: x["op"].isin("replace", "pair") if op == "replace" else x["op"] == op)
        return F.transform(chosen, lambda x: F.struct(x[at].alias("at"), F.lit(op).alias("op"), x["kind"].alias("kind"), x["text"].alias("text")))

    ordered = F.concat(
        F.array_sort(only("replace", "old_at")), F.sort_array(only("remove", "old_at"), asc=False), F.array_sort(only("add", "new_at"))
    )
    none = F.lit(None).cast("string")
    return F.transform(
        ordered,
        lambda x: F.struct(
            x["op"].alias("op"), pointer(x["at"]).alias("path"),
            F.when(x["op"] == "remove", none).otherwise(x["kind"]).alias("kind"),
            F.when(x["op"] == "remove", none).otherwise(x["text"]).alias("text"),
        ),
    ).cast(f"array<{OPERATION}>")


def pointer(parts: Column) -> Column:
    """Parts as a JSON pointer."""
    def one(part: Column) -> Column:
        name = F.substring(part, F.lit(2), F.length(part))
        plain = F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        return F.concat(F.lit("/"), F.when(part.startswith("#"), name.cast("int").cast("string")).otherwise(plain))

    return F.array_join(F.transform(parts, one), "")


# --- the inverse --------------------------------------------------------------------------------


def apply_patch(documents: DataFrame, body: str = "metadata", patch: str = "json_patch", into: str = "modified_metadata") -> DataFrame:
    """The body after the operations ``add``, ``remove`` and ``replace`` of a patch, one after the other.

    An operation whose place does not exist fails, as the standard wants it.
    """
    value = lambda p: F.when(p["op"] != "remove", C.json_value(p["kind"], p["text"]))
    operations = F.to_json(F.transform(patch, lambda p: F.struct(p["op"].alias("op"), p["path"].alias("path"), value(p).alias("value"))))

    @F.pandas_udf("string")
    def patched(texts, patches):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([None if t is None or p is None else patched_text(t, json.loads(p)) for t, p in zip(texts, patches)])

    [text] = fresh([*documents.columns, into], "_text")
    done = documents.withColumn(text, patched(C.json_object(F.col(body)), operations))
    return done.withColumn(into, F.when(F.size(patch) == 0, F.col(body)).otherwise(C.parse_cells(F.col(text)))).drop(text)


class Number(str):
    """A number as it is written."""


def patched_text(text: str, operations: list[dict[str, Any]]) -> str:
    """JSON text after operations, whose values are JSON texts."""
    read = lambda t: json.loads(t, parse_int=Number, parse_float=Number)
    whole = read(text)
    for operation in operations:
        parts = [p.replace("~1", "/").replace("~0", "~") for p in operation["path"].split("/")[1:]]
        at = whole
        for part in parts[:-1]:
            at = at[int(part)] if isinstance(at, list) else at[part]
        key: Any = parts[-1]
        if isinstance(at, list):
            key = len(at) if key == "-" else int(key)
        if operation["op"] == "remove":
            del at[key]
        elif operation["op"] == "add" and isinstance(at, list):
            if key > len(at):
                raise IndexError(operation["path"])
            at.insert(key, read(operation["value"]))
        elif operation["op"] in ("add", "replace"):
            if operation["op"] == "replace":
                at[key]  # must be there
            at[key] = read(operation["value"])
        else:
            raise ValueError(f"unknown operation {operation['op']!r}")
    return _written(whole)


def _written(value: Any) -> str:
    if isinstance(value, Number):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_written(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_written, value)) + "]"
    return json.dumps(value, ensure_ascii=False)
