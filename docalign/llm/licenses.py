"""License scans: phrases, and license templates compiled into token automata.

A template is plain wording with two marks: ``[[ ... ]]`` encloses words that may be
left out, and ``{{a-b}}`` stands for any ``a`` to ``b`` words. A text matches where all
other words stand exactly, in order. Words are runs of a-z, 0-9 and characters beyond
ASCII, after A-Z are lower-cased, so case and punctuation do not count.

Defined cases: a null text counts as empty, with no words and no labels; null ids,
repeated rows and extra columns are passed through; an empty table gives none. Texts of
any length are scanned whole, in time linear in words times the length of a template.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docalign.llm.common import as_bytes

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Template wording by label: notices of common licenses, shortened to their operative sentences.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files [[the software]] to deal in the software without restriction "
    "including without limitation the rights to use copy modify merge publish distribute sublicense "
    "and or sell copies of the software",
    "isc": "permission to use copy modify and [[or]] distribute this software for any purpose with or without "
    "fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met",
    "mit-notice": "[[this {{1-3}} is]] released under the mit license",
    "apache-2.0": "licensed under the apache license version 2 0",
    "gpl-3.0": "[[this {{1-3}} is]] licensed under the gnu general public license version 3",
    "gpl-notice": "you can redistribute it and or modify it under the terms of the gnu general public license "
    "as published by the free software foundation either version {{1-2}} of the license or at your option any later version",
    "cc-by-4.0": "licensed under [[a creative commons]] cc by 4 0",
    "cc-by-nc-4.0": "licensed under [[a creative commons]] cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under [[a creative commons]] cc by sa 4 0",
    "cc0-1.0": "to the extent possible under law {{1-12}} waived all copyright and related or neighboring rights",
    "all-rights-reserved": "[[copyright {{0-8}}]] all rights reserved",
}

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "matches",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("label", T.StringType()),
                        T.StructField("first", T.LongType()),
                        T.StructField("end", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)

#: Every ASCII byte that is no word character becomes a space; bytes from 128 on stay.
_TO_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_TO_WORDS).split()


@dataclass
class Automaton:
    """States 0..n; ``steps[s]`` leads by word, ``any_word[s]`` by any word, ``free[s]`` by none."""

    label: str
    steps: list[tuple[bytes, int] | None] = field(default_factory=lambda: [None])
    any_word: list[int | None] = field(default_factory=lambda: [None])
    free: list[list[int]] = field(default_factory=lambda: [[]])

    def _state(self) -> int:
        self.steps.append(None)
        self.any_word.append(None)
        self.free.append([])
        return len(self.steps) - 1

    @property
    def last(self) -> int:
        return len(self.steps) - 1

    def closure(self, states: set[int]) -> set[int]:
        found, stack = set(states), list(states)
        while stack:
            for s in self.free[stack.pop()]:
                if s not in found:
                    found.add(s)
                    stack.append(s)
        return found

    def starts(self) -> set[bytes]:
        """Words that a match can begin with."""
        return {s[0] for x in self.closure({0}) if (s := self.steps[x])}

    def match(self, words: list[bytes], at: int) -> int | None:
        """End of the longest match that begins at a word; None if there is none."""
        states, end = self.closure({0}), None
        while states:
            if self.last in states:
                end = at
            if at == len(words):
                break
            word, after = words[at], set()
            for s in states:
                if (step := self.steps[s]) and step[0] == word:
                    after.add(step[1])
                if (to := self.any_word[s]) is not None:
                    after.add(to)
            states, at = self.closure(after), at + 1
        return end


def compile_template(label: str, wording: str) -> Automaton:
    """An automaton of a template; marks may stand inside ``[[ ]]`` but not nest in each other."""
    made, now, opened = Automaton(label), 0, []
    for part in re.findall(r"\[\[|\]\]|\{\{\d+-\d+\}\}|[^\s\[\]{}]+", wording):
        if part == "[[":
            opened.append(now)
        elif part == "]]":
            made.free[opened.pop()].append(now)
        elif part.startswith("{{"):
            least, most = map(int, part[2:-2].split("-"))
            held = []
            for k in range(most):
                if k >= least:
                    held.append(now)
                made.any_word[now] = to = made._state()
                now = to
            for s in held:
                made.free[s].append(now)
        else:
            to = made._state()
            made.steps[now] = (part.encode(), to)
            now = to
    if opened or made.last in made.closure({0}):
        raise ValueError(f"template {label}: an open mark, or nothing mandatory")
    return made


class Scanner:
    """Phrases and templates, ready for texts."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]) -> None:
        self.phrases = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]
        self.automata = [compile_template(k, w) for k, w in templates.items()]

    def phrase_places(self, joined: bytes) -> list[tuple[int, str]]:
        found = []
        for phrase, label in self.phrases:
            at, seen, counted = joined.find(phrase), 0, 0
            while at >= 0:
                counted += joined.count(b" ", seen, at)
                seen = at
                found.append((counted, label))
                at = joined.find(phrase, at + 1)
        return found

    def template_places(self, words: list[bytes], joined: bytes) -> list[tuple[str, int, int]]:
        """Matches, from left to right and without overlap for each template."""
        found = []
        for a in self.automata:
            begins = []
            for first in a.starts():
                needle, seen, counted = b" " + first + b" ", 0, 0
                at = joined.find(needle)
                while at >= 0:
                    counted += joined.count(b" ", seen, at)
                    seen = at
                    begins.append(counted)
                    at = joined.find(needle, at + 1)
            free = 0
            for at in sorted(begins):
                if at >= free and (end := a.match(words, at)) is not None:
                    found.append((a.label, at, end))
                    free = end
        return found

    def scan(self, text: bytes) -> dict:
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        base = self.phrase_places(joined)
        matches = self.template_places(words, joined)
        base_labels = {label for _, label in base}
        places = [p for p, _ in base]
        return {
            "n_words": len(words),
            "n_base": len(base),
            "first_word": min(places, default=None),
            "last_word": max(places, default=None),
            "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(base_labels | {m[0] for m in matches})),
            "score": 1.0 if matches else 0.5 if base else 0.0,
            "matches": [{"label": m[0], "first": m[1], "end": m[2]} for m in matches],
        }


def license_scan(
    documents: DataFrame,
    phrases: dict[str, str] | None = None,
    templates: dict[str, str] | None = None,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """For each row its ``keep`` columns, counts, labels, score and template matches.

    ``score`` is 1 if a whole template matches, 0.5 if only a phrase stands in the text,
    else 0. One pass over the table without a shuffle.
    """
    scan_args = (phrases or PHRASES, templates or TEMPLATES)
    needed = documents.select(*keep, text)
    schema = T.StructType([needed.schema[c] for c in keep] + RESULT.fields)

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*scan_args)
        for batch in batches:
            rows = [scanner.scan(t) for t in as_bytes(batch.column(len(keep)))]
            found = pa.RecordBatch.from_pylist(rows, schema=ARROW)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + found.columns, names=[*keep, *found.schema.names]
            )

    return needed.mapInArrow(scan_batches, schema)


ARROW = pa.schema(
    [
        ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("matches", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))),
    ]
)
