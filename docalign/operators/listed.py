"""Forms of a listed value, on the driver or in a worker."""

from __future__ import annotations

import json

from docalign.functions import cells as C


def same_values(value: dict) -> list[dict]:
    """All equal values of a stored one (1, 1.0 and true are equal)."""
    if value["kind"] == "boolean":
        return C.equal_values(value["text"] == "true")
    if value["kind"] == "integer":
        return C.equal_values(int(value["text"]))
    if value["kind"] == "float":
        return C.equal_values(float(value["text"]))
    return [value]


def printed_value(value: dict) -> str:
    """``str()`` of a stored value."""
    if value["kind"] in ("string", "integer", "float"):
        return value["text"]
    return str(json.loads(value["text"] or "null"))
