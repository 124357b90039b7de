"""Patterns written for Python, printed for the engine's regular expressions.

Python's own parser reads the pattern; the tree is printed with classes and anchors
spelled out, so that ``\\w``, ``\\s``, ``.`` and ``$`` mean the same as in Python. What has no
counterpart (a conditional group, a class the engine does not compile) gives None.
"""

from __future__ import annotations

import re
from re import _constants as K
from re import _parser as parser

# The characters of Python's classes.
WORD, DIGIT = r"\p{L}\p{N}_", r"\p{Nd}"
SPACE = r"\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ASCII = {"word": "a-zA-Z0-9_", "digit": "0-9", "space": r"\x09-\x0d\x20"}
UNICODE = {"word": WORD, "digit": DIGIT, "space": SPACE}
CATEGORIES = {
    K.CATEGORY_DIGIT: ("digit", False), K.CATEGORY_NOT_DIGIT: ("digit", True),
    K.CATEGORY_SPACE: ("space", False), K.CATEGORY_NOT_SPACE: ("space", True),
    K.CATEGORY_WORD: ("word", False), K.CATEGORY_NOT_WORD: ("word", True),
}


class Untranslatable(Exception):
    pass


def _char(code: int) -> str:
    return chr(code) if chr(code).isascii() and chr(code).isalnum() else f"\\x{{{code:x}}}"


class _Printer:
    def __init__(self, flags: int) -> None:
        self.flags = flags

    def category(self, code, flags: int) -> str:
        name, negated = CATEGORIES[code]
        return f"[{'^' if negated else ''}{(ASCII if flags & re.A else UNICODE)[name]}]"

    def sequence(self, items, flags: int) -> str:
        return "".join(self.item(op, value, flags) for op, value in items)

    def item(self, op, value, flags: int) -> str:
        if op is K.LITERAL:
            return _char(value)
        if op is K.NOT_LITERAL:
            return f"[^{_char(value)}]"
        if op is K.ANY:
            return r"(?s:.)" if flags & re.S else r"[^\n]"
        if op is K.IN:
            return self.members(value, flags)
        if op is K.BRANCH:
            return "(?:" + "|".join(self.sequence(v, flags) for v in value[1]) + ")"
        if op is K.SUBPATTERN:
            group, add, remove, inner = value
            within = (flags | add) & ~remove
            text = self.sequence(inner, within)
            if (within ^ flags) & re.I:
                text = f"(?iu:{text})" if within & re.I else f"(?-iu:{text})"
            return f"({text})" if group is not None else f"(?:{text})"
        if op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
            least, most, inner = value
            bound = f"{{{least},{'' if most == K.MAXREPEAT else most}}}"
            kind = {K.MAX_REPEAT: "", K.MIN_REPEAT: "?", K.POSSESSIVE_REPEAT: "+"}[op]
            return f"(?:{self.sequence(inner, flags)}){bound}{kind}"
        if op is K.ATOMIC_GROUP:
            return f"(?>{self.sequence(value, flags)})"
        if op is K.AT:
            return self.anchor(value, flags)
        if op in (K.ASSERT, K.ASSERT_NOT):
            direction, inner = value
            sign = "=" if op is K.ASSERT else "!"
            return f"(?{'' if direction > 0 else '<'}{sign}{self.sequence(inner, flags)})"
        if op is K.GROUPREF:
            return f"(?:\\{value})"
        raise Untranslatable(str(op))

    def members(self, items, flags: int) -> str:
        negated = items and items[0][0] is K.NEGATE
        parts, outside = [], []
        for op, value in items[1:] if negated else items:
            if op is K.LITERAL:
                parts.append(_char(value))
            elif op is K.RANGE:
                parts.append(f"{_char(value[0])}-{_char(value[1])}")
            elif op is K.CATEGORY:
                outside.append(self.category(value, flags))
            else:
                raise Untranslatable(str(op))
        inner = "".join(parts) + "".join(outside)
        return f"[^{inner}]" if negated else f"[{inner}]"

    def anchor(self, code, flags: int) -> str:
        word = (ASCII if flags & re.A else UNICODE)["word"]
        edge = f"(?:(?<=[{word}])(?![{word}])|(?<![{word}])(?=[{word}]))"
        multiline = flags & re.M
        known = {
            K.AT_BEGINNING: r"(?:(?<=\n)|\A)" if multiline else r"\A",
            K.AT_BEGINNING_STRING: r"\A",
            K.AT_END: r"(?=\n|\z)" if multiline else r"(?=\n?\z)",
            K.AT_END_STRING: r"\z",
            K.AT_BOUNDARY: edge,
            K.AT_NON_BOUNDARY: f"(?!{edge})",
        }
        if code not in known:
            raise Untranslatable(str(code))
        return known[code]


def translate(pattern: str) -> str | None:
    """The pattern in the engine's syntax; None if it is invalid in Python or has no counterpart."""
    try:
        re.compile(pattern)
        tree = parser.parse(pattern)
        printed = _Printer(tree.state.flags).sequence(tree, tree.state.flags)
    except (re.error, Untranslatable, OverflowError, RecursionError):
        return None
    if tree.state.flags & re.I:
        printed = f"(?iu:{printed})"
    return printed if _compiles(printed) else None


def _compiles(printed: str) -> bool:
    """Whether the engine takes the pattern, so that none can stop a running query."""
    from pyspark import SparkContext

    context = SparkContext._active_spark_context
    if context is None:
        return True
    try:
        context._jvm.java.util.regex.Pattern.compile(printed)
    except Exception:  # the engine's own error, whatever its class
        return False
    return True
