"""Broken config files stop the documents that follow them, and no others."""

from __future__ import annotations

import json

import pytest

from docalign.sources import quarantine as apart
from docalign.sources.config import rule_entries

FILES = "profile string, source_file string, stem string, content string"
RULE = '[{"when":{"__must__":[{"a":1}]},"then":{"b":2}}]'


def files(spark, *rows):
    return spark.createDataFrame([(p, f, "s", c) for p, f, c in rows], FILES)


@pytest.mark.parametrize(
    "kind, content, problem",
    [
        (apart.RULES, RULE, None),
        (apart.RULES, "[]", None),
        (apart.RULES, "", "invalid JSON"),
        (apart.RULES, None, "invalid JSON"),
        (apart.RULES, RULE + " x", "invalid JSON"),
        (apart.RULES, "{}", "a rule file must be a JSON array"),
        (apart.RULES, "[3]", "rule 1 must be an object with 'when' and 'then'"),
        (apart.RULES, '[{"when":{},"then":[]}]', "rule 1: 'when' and 'then' must be objects"),
        (apart.RULES, '[{"when":{"a":1},"then":{}}]', "rule 1: a condition has __must__ and __should__ only, not ['a']"),
        (apart.RULES, '[{"when":{"__should__":[{"__must__":[1]}]},"then":{}}]', "rule 1: __must__ must be an array of objects"),
        (apart.RULES, '[{"when":' + '{"__must__":[' * 400 + "{}" + "]}" * 400 + ',"then":{}}]', "rule 1 is nested too deep"),
        (apart.FIELD_MAP, '{"a":null}', None),
        (apart.FIELD_MAP, "{}", None),
        (apart.FIELD_MAP, "[]", "a field map must be a JSON object"),
        (apart.VALUE_MAP, '"x"', "a value map must be a JSON object"),
        (apart.SCHEMA, '["skipped"]', None),
        (apart.SCHEMA, "[", "invalid JSON"),
        (apart.SCHEMA, "{}", "a target schema must be a JSON array"),
        (apart.CROSSWALK, "t,v0\na,b", None),
        (apart.CROSSWALK, "t,v0\n", "a crosswalk needs a header, a row and two columns"),
        (apart.CROSSWALK, None, "a crosswalk needs a header, a row and two columns"),
    ],
)
def test_what_is_broken(spark, kind, content, problem):
    rows = files(spark, ("p", "f.json", content))
    assert apart.checked_files(rows, kind).first()["problem"] == problem
    assert apart.whole_files(rows, kind).columns == rows.columns
    assert apart.whole_files(rows, kind).count() == (problem is None)


def test_quarantine(spark):
    rules = files(spark, ("a", "2", "{}"), ("a", "1", "{"), ("b", "3", RULE), (None, "4", "[3]"), (None, "5", "{"))
    maps = files(spark, ("b", "6", "[]"), ("a", "0", "7"))
    errors = apart.config_errors({apart.RULES: rules, apart.FIELD_MAP: maps})
    assert errors.count() == 6
    catalog = {apart.RULES: rule_entries(apart.whole_files(rules, apart.RULES))}
    rows = [(1, "a", None, 9), (2, "b", "own", 9), (3, "b", None, 9), (4, "c", None, 9), (5, None, None, 9), (5, None, None, 9)]
    documents = spark.createDataFrame(rows, "id int, profile string, error string, _own int")
    done = apart.quarantine(documents, errors, catalog)
    assert done.columns == documents.columns
    shared = "config: rules 4: rule 1 must be an object with 'when' and 'then'"
    assert sorted((r.id, r.error, r["_own"]) for r in done.collect()) == [
        (1, "config: field map 0: a field map must be a JSON object", 9), (2, "own", 9),
        (3, "config: field map 6: a field map must be a JSON object", 9), (4, shared, 9), (5, shared, 9), (5, shared, 9),
    ]
    # Documents without profiles or errors, and no broken file at all.
    plain = documents.select("id").limit(1)
    assert apart.quarantine(plain, errors, {}).first()["error"] == shared
    none = apart.config_errors({apart.RULES: rules.where("content like '[{%'")})
    assert {r.error for r in apart.quarantine(documents, none, catalog).collect()} == {None, "own"}
    assert apart.quarantine(documents.limit(0), errors, catalog).count() == 0


def test_a_profile_with_its_own_rows_does_not_follow_a_broken_shared_file(spark):
    rules = files(spark, ("b", "3", RULE), ("e", "4", "[]"), (None, "5", json.dumps({})))
    catalog = {apart.RULES: rule_entries(apart.whole_files(rules, apart.RULES))}
    documents = spark.createDataFrame([("b",), ("e",)], "profile string")
    done = apart.quarantine(documents, apart.config_errors({apart.RULES: rules}), catalog)
    assert {r.profile: r.error is None for r in done.collect()} == {"b": True, "e": False}
