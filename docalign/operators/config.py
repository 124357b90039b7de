"""Config tables as operators take them.

Rows come as a list of dicts, or as a DataFrame of the same columns. A table is
looked up as a constant of the plan (``lookup="constant"``) or by a
join (``lookup="join"``). The caller chooses; without a choice a list is a
constant and a DataFrame is joined. The size of a table changes nothing, and both
ways give the same result: a key that is listed twice for a profile is an error.

Every table has a ``profile`` column. A document follows the rows of its own
profile; documents of a profile that the table does not name follow the rows
whose profile is null.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.functions.cells import value_of
from docalign.functions.lookup import constant_lookup

DUPLICATE = "a profile lists a key twice"

Rows = list[dict[str, Any]]
Config = Union[Rows, DataFrame]


def constant_rows(config: Config) -> Rows:
    """The rows as dicts on the driver, for a constant."""
    if not isinstance(config, DataFrame):
        return list(config)
    return [r.asDict(recursive=True) for r in config.collect()]


def is_joined(config: Config, lookup: str | None) -> bool:
    """Whether a map is looked up by a join; see above."""
    if lookup not in (None, "constant", "join"):
        raise ValueError(f"lookup is 'constant' or 'join', not {lookup!r}")
    return isinstance(config, DataFrame) if lookup is None else lookup == "join"


def joined_table(documents: DataFrame, config: Config, schema: str) -> DataFrame:
    """A config table as a DataFrame, for a join with the documents."""
    if isinstance(config, DataFrame):
        return config
    return documents.sparkSession.createDataFrame([dict(r) for r in config], schema)


def profiles_of(rows: Rows) -> list[str]:
    return sorted({r["profile"] for r in rows if r["profile"] is not None})


def scope(profiles: Sequence[str]) -> Column:
    """Which part of a config table a document follows; '' is the shared part."""
    if not profiles:
        return F.lit("")
    return F.when(F.col("profile").isin(*profiles), F.col("profile")).otherwise(F.lit(""))


def scoped_lookup(
    entries: Iterable[tuple[str | None, Sequence[str], Any]],
    value_type: str,
    profiles: Sequence[str],
) -> Callable[..., Column]:
    """Constant lookup of ``(profile, keys, value)`` entries by key columns."""
    if not profiles:
        return constant_lookup(((k, v) for p, k, v in entries if p is None), value_type)
    find = constant_lookup((((p or "", *k), v) for p, k, v in entries), value_type)
    return lambda *keys: find(scope(profiles), *keys)


def distinct_keys(rows: Rows, *keys: str) -> Rows:
    """The rows, if no profile lists a key twice; else an error."""
    seen = set()
    for r in rows:
        key = (r["profile"], *[r[k] for k in keys])
        if key in seen:
            raise ValueError(f"{DUPLICATE}: {key}")
        seen.add(key)
    return rows


def named_profiles(documents: DataFrame, rows: Rows) -> list[str]:
    """Profiles that a table names, for documents that have one."""
    return profiles_of(rows) if "profile" in documents.columns else []


def field_map(names: Mapping[str, str | None], profile: str | None = None) -> Rows:
    """Field map rows from a dict legacy -> target."""
    return [{"profile": profile, "legacy": k, "target": v} for k, v in names.items()]


def value_map(fields: Mapping[str, Mapping[str, Any]], profile: str | None = None) -> Rows:
    """Value map rows from a dict field -> legacy text -> value or choices.

    A field with an empty dict gets one row without a key.
    """
    rows: Rows = []
    for field, pairs in fields.items():
        for key, target in pairs.items():
            options = target if isinstance(target, list) else [target]
            rows.append(
                {
                    "profile": profile,
                    "field": field,
                    "legacy_key": key,
                    "is_list": isinstance(target, list),
                    "options": [value_of(o) for o in options],
                }
            )
        if not pairs:
            rows.append(
                {"profile": profile, "field": field, "legacy_key": None, "is_list": False, "options": []}
            )
    return rows


def target_schema(fields: Sequence[Any], profile: str | None = None) -> Rows:
    """Schema rows from a list of field definitions as they stand in a file."""
    rows: dict[str, dict[str, Any]] = {}
    for definition in fields:
        if not isinstance(definition, Mapping) or not definition.get("name"):
            continue
        allowed = definition.get("permissible_values")
        name = definition["name"]
        rows[name] = {
            "profile": profile,
            "pos": rows[name]["pos"] if name in rows else len(rows),
            "name": name,
            "description": definition.get("description", ""),
            "type": definition.get("type", "text"),
            "required": bool(definition.get("required", False)),
            "required_strict": definition.get("required") is True,
            "regex": definition.get("regex"),
            "default_value": value_of(definition.get("default_value")),
            "permissible": None if allowed is None else [value_of(v) for v in allowed],
        }
    return list(rows.values())


def rules(items: Sequence[Mapping[str, Any]], profile: str | None = None) -> Rows:
    """Rule rows from a list of rules as they stand in a file."""
    return [
        {
            "profile": profile,
            "part": 0,
            "source_file": "",
            "pos": i,
            "when": json.dumps(r["when"]),
            "then": json.dumps(r["then"]),
        }
        for i, r in enumerate(items)
    ]
