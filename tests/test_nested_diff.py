"""Differences inside nested values."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from docalign.functions.cells import parse_cells
from docalign.operators.nested_diff import apply_patch, common, diff_nested, edit_script, patched_text


def plain(texts):
    return [json.loads(t) for t in texts]


def pairs_of(spark, pairs):
    rows = [(i, json.dumps(a, ensure_ascii=False), json.dumps(b, ensure_ascii=False)) for i, (a, b) in enumerate(pairs)]
    texts = spark.createDataFrame(rows, "id int, a string, b string")
    return texts.select("id", parse_cells(F.col("a")).alias("metadata"), parse_cells(F.col("b")).alias("modified_metadata"))


def patches(frame):
    return {r.id: [(p.op, p.path, p.text) for p in r.json_patch] for r in frame.collect()}


def test_operations(spark):
    found = patches(diff_nested(pairs_of(spark, [
        ({"a": {"b": [1, 2, 3]}}, {"a": {"b": [1, 3]}}),
        ({"a": [1, 2, 3, 4, 5]}, {"a": [0, 2, 9, 4, 6, 7]}),
        ({"a": {"x": 1, "y": 2}}, {"a": {"y": 2, "x": 1}}),
        ({"a": [[1], [2]], "g": 1}, {"a": [[2], [1, 3]], "h": None}),
        ({"a/b": {"~": {"": 1}}}, {"a/b": {"~": {"": 2}}}),
        ({"a": {"b": 1}}, {"a": [1]}),
        ({}, {}),
    ])))
    assert found[0] == [("remove", "/a/b/1", None)]
    assert found[1] == [("replace", "/a/0", "0"), ("replace", "/a/2", "9"), ("replace", "/a/4", "6"), ("add", "/a/5", "7")]
    assert found[2] == found[6] == []
    assert sorted(found[3], key=str) == sorted([("remove", "/a/0", None), ("remove", "/g", None), ("add", "/a/1", "[1,3]"), ("add", "/h", None)], key=str)
    assert found[4] == [("replace", "/a~1b/~0/", "2")]
    assert found[5] == [("replace", "/a", "[1]")]


def test_deep_values_are_replaced_whole(spark):
    pairs = [({"a": {"b": {"c": {"d": 1}}}}, {"a": {"b": {"c": {"d": 2}}}})]
    assert patches(diff_nested(pairs_of(spark, pairs), depth=2))[0] == [("replace", "/a/b/c", '{"d":2}')]
    assert patches(diff_nested(pairs_of(spark, pairs), depth=0))[0] == [("replace", "/a", '{"b":{"c":{"d":2}}}')]
    assert patches(diff_nested(pairs_of(spark, pairs)))[0] == [("replace", "/a/b/c/d", "2")]


def grown(rng, depth):
    kind = rng.random()
    if depth and kind < 0.35:
        return {rng.choice(["k", "l/", "~m", "0", "ü"]): grown(rng, depth - 1) for _ in range(rng.randint(0, 4))}
    if depth and kind < 0.7:
        return [grown(rng, depth - 1) for _ in range(rng.randint(0, 6))]
    return rng.choice([0, 1, 1.5, "s", "", None, True, "é\n"])


def changed(rng, value):
    if rng.random() < 0.15:
        return grown(rng, 2)
    if isinstance(value, dict):
        return {k: changed(rng, v) for k, v in value.items() if rng.random() < 0.9} | ({"new": 1} if rng.random() < 0.2 else {})
    if isinstance(value, list):
        out = []
        for v in value:
            if rng.random() < 0.85:
                out.append(changed(rng, v) if rng.random() < 0.4 else v)
            if rng.random() < 0.15:
                out.append(grown(rng, 1))
        return out
    return value


@pytest.mark.parametrize("depth", [6, 1])
def test_a_patch_turns_old_into_new(spark, depth):
    rng = random.Random(depth)
    pairs = []
    for _ in range(150):
        old = {f: grown(rng, 4) for f in rng.sample(["a", "b", "c/d"], rng.randint(0, 3))}
        pairs.append((old, changed(rng, old) if rng.random() < 0.9 else {}))
    pairs = [(a, b if isinstance(b, dict) else {}) for a, b in pairs]
    frame = diff_nested(pairs_of(spark, pairs), depth=depth)
    for r in frame.select("id", F.to_json("json_patch").alias("p")).collect():
        old, new = pairs[r.id]
        operations = [
            {"op": p["op"], "path": p["path"], "value": json.dumps(p.get("text")) if p.get("kind") in ("string", "null") else p.get("text")}
            for p in json.loads(r.p)
        ]
        assert json.loads(patched_text(json.dumps(old), operations)) == new
    from docalign.functions.cells import json_object

    done = apply_patch(frame.drop("modified_metadata")).select("id", json_object(F.col("modified_metadata")).alias("t"))
    assert {r.id: json.loads(r.t) for r in done.collect()} == {i: b for i, (_, b) in enumerate(pairs)}


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found = common(a, b)
        assert len(found) == best[-1][-1] and all(a[i] == b[j] for i, j in found) and found == sorted(found)
        script = edit_script(a, b)
        kept = len(a) - sum(1 for i, _ in script if i >= 0)
        assert kept == len(b) - sum(1 for _, j in script if j >= 0)


def test_places_that_do_not_exist_fail():
    for op in ({"op": "replace", "path": "/b", "value": "1"}, {"op": "remove", "path": "/a/9"}, {"op": "add", "path": "/a/9", "value": "1"}, {"op": "move", "path": "/a"}):
        with pytest.raises((KeyError, IndexError, ValueError)):
            patched_text('{"a":[1]}', [op])


def test_own_columns_and_copies_stay(spark):
    frame = pairs_of(spark, [({"a": [1]}, {"a": [2]})] * 3 + [({"a": 1}, {"a": 1})])
    named = frame.withColumns({n: F.lit(n) for n in ("_h1", "_items", "x", "_inner")})
    done = diff_nested(named)
    assert done.count() == 4 and all(r["_h1"] == "_h1" and r["x"] == "x" for r in done.collect())
    assert [len(v) for _, v in sorted(patches(done).items())] == [1, 1, 1, 0]
