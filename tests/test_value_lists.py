"""Values as JSON documents in fragments, against plain Python."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docalign.sources.value_lists import read_value_lists, value_list_documents, write_value_list_files, write_value_lists


def plain(rows):
    """Profile to field to one value or the sorted values."""
    found = {}
    for profile, field, value in rows:
        if field is not None and value is not None:
            found.setdefault(profile, {}).setdefault(field, set()).add(value)
    return {
        p: {f: next(iter(v)) if len(v) == 1 else sorted(v) for f, v in sorted(fields.items())} for p, fields in found.items()
    }


@pytest.mark.parametrize("hot", [0.0, 0.9])
def test_documents_in_many_parts(spark, tmp_path, hot):
    rng = random.Random(7)
    rows = [("p" if rng.random() < hot else rng.choice(["p", "q", "é", None]),
             "f" if rng.random() < hot else rng.choice(["f", "g", 'h"', "\\", ""]),
             rng.choice(["", "\n", '"', "ü", "𝄞"]) if rng.random() < 0.05 else f"v{rng.randrange(3000)}") for _ in range(4000)]
    rows += [("lone", "x", "only"), ("p", None, "a"), ("p", "a", None)] + rows[:50]
    values = spark.createDataFrame(rows, "profile string, field string, value string").withColumn("part", F.lit(3))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run = write_value_lists(values, str(tmp_path / "run"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert run.table("values").select("part").distinct().count() > 4
    got = {r.profile: r.document for r in value_list_documents(run).collect()}
    wanted = plain(rows)
    assert {p: json.loads(t) for p, t in got.items()} == wanted
    assert [list(json.loads(t)) for t in got.values()] == [list(wanted[p]) for p in got]
    numbers = {}
    for r in read_value_lists(spark, str(tmp_path / "run")).collect():
        numbers.setdefault(r.profile, []).append(r.ordinal)
    assert all(sorted(n) == list(range(1, len(n) + 1)) for n in numbers.values())
    # Files of a profile, in the order of their names, are its document.
    write_value_list_files(run, str(tmp_path / "files"))
    text = "".join(f.read_text() for f in sorted(Path(tmp_path / "files" / "profile=p").glob("part-*")))
    assert json.loads(text) == wanted["p"]


def test_no_values_and_no_profiles(spark, tmp_path):
    empty = spark.createDataFrame([], "field string, value string")
    assert value_list_documents(write_value_lists(empty, str(tmp_path / "a"))).count() == 0
    one = spark.createDataFrame([("f", "v"), ("f", "v")], "field string, value string")
    assert value_list_documents(write_value_lists(one, str(tmp_path / "b"))).first().document == '{"f":"v"}'
