"""Text helpers built from regular expressions and string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docalign.functions.patterns import translate

# Fixed value: the characters Python's str.strip() removes. Java's Unicode \s
# leaves out the four separators U+001C to U+001F.
SPACE = r"[\s\x1c-\x1f]"


def is_blank(text: Column) -> Column:
    """True when nothing but white space is in ``text`` (also for '')."""
    return text.rlike(rf"(?U)\A{SPACE}*\z")


def strip(text: Column) -> Column:
    """Remove all Unicode white space at both ends."""
    return F.regexp_replace(text, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def java_pattern(pattern: str) -> str | None:
    """A pattern written for Python, for ``rlike``; None when it cannot be checked."""
    return translate(pattern)


def matches_whole(text: Column, pattern: str) -> Column:
    """True when a translated pattern covers ``text`` from first to last character."""
    return text.rlike(rf"\A(?:{pattern})\z")


def group_slug(group_name: Column, dataset_type: Column) -> Column:
    """Grouping key: ``some-group-name-type``."""
    return F.concat(
        F.replace(F.lower(group_name), F.lit(" "), F.lit("-")),
        F.lit("-"),
        F.lower(dataset_type),
    )


def file_stem(name: Column) -> Column:
    """File name without its last extension (``.json`` alone is a stem)."""
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+\z", "")
