"""Collocations against plain counts."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from docalign.llm import phrases

SCHEMA = "doc_id long, text string, lang string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least=30, share=80, most=2000):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().translate(lower)):
            words = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    key = (lang, *words[i : i + k])
                    f[key] = f.get(key, 0) + 1
    often = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    gone = set()
    for key, a in often.items():
        lang, words = key[0], key[1:]
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                sub = (lang, *words[i : i + k])
                if 100 * a >= share * often[sub]:
                    gone.add(sub)
    by_lang = {}
    for key, a in often.items():
        if key in gone:
            continue
        lang, words = key[0], key[1:]
        cuts = []
        for k in range(1, len(words)):
            left, right = f[(lang, *words[:k])], f[(lang, *words[k:])]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, b" ".join(words), left, right))
    out = []
    for lang, found in by_lang.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def corpus(seed, n):
    rng = random.Random(seed)
    few, many = ["the", "Of", "a", "b", "né", "x1"], [f"w{i}" for i in range(200)]
    passage = " ".join(f"p{i}" for i in range(40))
    rows = []
    for i in range(n):
        words = [rng.choice(few if rng.random() < 0.7 else many) for _ in range(rng.randint(0, 60))]
        text = " ".join(w + rng.choice(["", "", "", ".", ", ", "\n", "\t"]) for w in words)
        if i % 4 == 0:
            text += " " + passage + " " + " ".join(["again"] * rng.randint(0, 6))
        rows.append((i, text, rng.choice(["en", "de", None])))
    return rows


@pytest.mark.parametrize("least,most,numbered", [(2, 2000, 4_000_000), (2, 2000, 10), (5, 7, 4_000_000), (30, 2000, 0)])
def test_collocations(spark, least, most, numbered):
    rows = corpus(least, 400)
    table = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = found(phrases.collocations(table, least=least, most=most, numbered=numbered))
    assert got and got == plain(rows, least, most=most)


def test_paths_are_compacted(spark):
    rows = [(i, "only these words stand here in a row", "en") for i in range(5)] + [(9, "words stand apart", "en")]
    graph = phrases.PhraseGraph(spark.createDataFrame(rows, SCHEMA), least=2)
    paths = graph.named(graph.paths.withColumnRenamed("words", "gram")).collect()
    assert [(r.phrase, r.f) for r in paths] == [("only these words stand here in a row", 5)]


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", None), (None, "a b a b a b a b", None), (3, "x " * 30_000, "en"), (3, "x " * 30_000, "en"), (4, ".,;\n", "en"), (5, "y" * 50_000, "en")]
    extra = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", gram int, f int")
    assert found(phrases.collocations(extra, least=3)) == plain(rows, least=3)
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_blobs_hold_what_was_packed():
    rng = np.random.default_rng(1)
    for top, distinct, n in ((1 << 63, 3, 10), (1 << 63, 100_000, 120_000), (1 << 24, 50_000, 60_000), (9, 5, 0)):
        grams = rng.integers(0, top, distinct, dtype=np.uint64)[rng.integers(0, distinct, (n, 4))]
        counts = rng.integers(1, 1000, n)
        back = phrases.unpack(phrases.pack(grams, counts))
        assert (back[0] == grams).all() and (back[1] == counts).all()


def test_equal_hashes_are_noticed(spark, monkeypatch):
    """Two words of one hash give it two rows, wherever they stand."""
    hasher = phrases.Hasher(0)
    data = np.frombuffer(b"one two one", dtype=np.uint8)
    *_, hashes = hasher.words(data, np.array([0, 11]), ["en"], twice=True)
    assert hashes[0][0] == hashes[0][2] != hashes[0][1] and hashes[1][0] == hashes[1][2] != hashes[1][1]
    other = hasher.words(data, np.array([0, 11]), ["de"])[-1]
    assert not set(other[0].tolist()) & set(hashes[0].tolist())


def test_query(spark):
    from docalign.llm import queries

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()
    assert found(queries.queries()["op12_phrases"](spark, folder)) == plain([tuple(r) for r in docs])
