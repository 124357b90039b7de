"""Language identification against a plain version, and on held-out rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from docalign.llm import language

SCHEMA = "doc_id long, text string, lang string"


def plain_grams(text):
    words = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text).split()
    found = Counter()
    for w in words:
        padded = f" {w} "
        found.update(w)
        found.update(padded[i : i + 2] for i in range(len(padded) - 1))
        found.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return found


def plain_profile(counts, places):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:places]]


def plain_predictions(rows, places):
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1
    counts = {}
    for i, text, lang in rows:
        if i is not None and not out(i) and lang is not None and text is not None:
            counts.setdefault(lang, Counter()).update(plain_grams(text))
    model = {n: {g: p for p, g in enumerate(plain_profile(c, places))} for n, c in counts.items() if c}
    found = []
    for i, text, _ in rows:
        own = plain_profile(plain_grams(text or ""), places)
        if not own or not model:
            found.append((i, out(i), "und", 0.0))
            continue
        d = sorted((sum(abs(m[g] - p) if g in m else places for p, g in enumerate(own)), n) for n, m in model.items())
        second = d[1][0] if len(d) > 1 else places * len(own)
        found.append((i, out(i), d[0][1], (second - d[0][0]) / second if second else 0.0))
    return sorted(found, key=str)


def found(frame):
    return sorted(((r.doc_id, r.held_out, r.lang_pred, r.score) for r in frame.collect()), key=str)


def test_predictions(spark):
    rng = random.Random(3)
    kinds = {"en": "the of and ing tion", "de": "der die und ung ß", "el": "και το ΔΕΝ μια", "zh": "的一是在不了"}
    rows = []
    for i in range(300):
        lang = rng.choice(list(kinds))
        parts = kinds[lang].split() if lang != "zh" else list(kinds[lang])
        text = " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(0, 40)))
        rows.append((i, rng.choice([text, text.upper(), text + " 12, x²!İ"]), lang if i % 9 else None))
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(language.predict_held_out(table)) == plain_predictions(rows, language.PLACES)


def test_odd_rows(spark):
    rows = [
        (None, "no id", "en"), (1, None, "en"), (2, "", "en"), (3, "12 34 ?", "en"), (4, "word", "en"), (5, "wort", "de"), (5, "wort", "de"),
        (6, "mot " * 60_000, "fr"), (7, "é" * 5000, None), (9, "x", None), (12, "other words here", "en"), (15, "andere wörter", "de"),
    ]
    extra = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", score int, lang_pred int")
    assert found(language.predict_held_out(extra)) == plain_predictions(rows, language.PLACES)
    assert language.predict_held_out(spark.createDataFrame([], SCHEMA)).count() == 0
    only = spark.createDataFrame([(1, "words", None)], SCHEMA)
    assert found(language.predict_held_out(only)) == [(1, zlib.crc32(b"1") % 3 == 1, "und", 0.0)]


def test_long_texts_are_counted_whole(monkeypatch):
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(3000))
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    whole = language.text_counts(points)
    monkeypatch.setattr(language, "BLOCK", 100)
    parts = language.text_counts(points)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_held_out_accuracy(spark):
    from docalign.llm import queries

    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    judged = [r for r in queries.queries()["op11_language"](spark, folder).collect()]
    assert len(judged) == len(truth)
    held = [r for r in judged if r.held_out and truth[r.doc_id]]
    right = sum(r.lang_pred == truth[r.doc_id] for r in held)
    assert len(held) > 250 and right / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in judged)


def test_query_equals_plain(spark):
    from docalign.llm import queries

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()]
    assert found(queries.queries()["op11_language"](spark, folder)) == plain_predictions(rows, language.PLACES)
