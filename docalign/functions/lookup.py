"""Constant lookup tables inside expressions.

A small config table becomes a literal of nested maps, one level per key. Where a
level has a map of more than ``SHORT`` keys, its maps are arrays of small ones, addressed
by a hash of the key. Catalyst folds it to a constant, so a lookup costs at most a hash
and a short scan per key, with neither a join nor a shuffle.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from docalign.functions.cells import let

#: Keys of a map up to which it is scanned as it is.
SHORT = 8


def constant_lookup(
    entries: Iterable[tuple[Sequence[str], Any]], value_type: str
) -> Callable[..., Column]:
    """Function from key columns to the value of these keys, null if unknown.

    All entries have the same number of keys. Of equal keys the last one counts.
    """
    flat = {tuple(keys): value for keys, value in entries}
    if not flat:
        return lambda *keys: F.lit(None).cast(value_type)
    depth = len(next(iter(flat)))
    tree: dict[str, Any] = {}
    for keys, value in flat.items():
        node = tree
        for key in keys[:-1]:
            node = node.setdefault(key, {})
        node[keys[-1]] = value
    short = _short_levels(tree, depth)
    column_type = value_type
    for is_short in reversed(short):
        column_type = f"map<string,{column_type}>" if is_short else f"array<map<string,{column_type}>>"
    table = F.from_json(F.lit(json.dumps(_laid_out(tree, short), ensure_ascii=False)), column_type)

    def find(*keys: Column) -> Column:
        found = table
        for level, (key, is_short) in enumerate(zip(keys, short, strict=True)):
            if is_short:
                found = F.try_element_at(found, key)
            elif level == 0:
                found = _in_bucket(found, key)
            else:
                found = _in_bucket_of(found, key)
        return found

    return find


def _short_levels(tree: dict[str, Any], depth: int) -> list[bool]:
    """For each level whether all of its maps are short."""
    short, nodes = [], [tree]
    for _ in range(depth):
        short.append(all(len(n) <= SHORT for n in nodes))
        nodes = [below for n in nodes for below in n.values()]
    return short


def _laid_out(node: dict[str, Any], short: list[bool]) -> Any:
    def below(value: Any) -> Any:
        return value if len(short) == 1 else _laid_out(value, short[1:])

    if short[0]:
        return {key: below(value) for key, value in node.items()}
    size = 1
    while size < len(node):
        size *= 2
    buckets: list[dict[str, Any]] = [{} for _ in range(size)]
    for key, value in node.items():
        buckets[zlib.crc32(key.encode()) % size][key] = below(value)
    return buckets


def _in_bucket(buckets: Column, key: Column) -> Column:
    slot = F.pmod(F.crc32(key.cast("binary")), F.size(buckets)).cast("int")
    return F.try_element_at(F.get(buckets, slot), key)


def _in_bucket_of(found: Column, key: Column) -> Column:
    """What was found so far is used twice: without ``let`` each level would double the work."""
    return let(found, lambda buckets: _in_bucket(buckets, key))


def constant_array(items: list[Any], item_type: str) -> Column:
    """A literal ``array<item_type>``."""
    return F.from_json(F.lit(json.dumps(items, ensure_ascii=False)), f"array<{item_type}>")
