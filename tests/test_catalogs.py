"""Config tables of any size by join: the same results as constants, and as plain Python."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from docalign.operators import fields, quality, report, review, rules, schema, values
from docalign.operators.config import field_map, target_schema, value_map
from docalign.operators.config import rules as rule_rows
from docalign.operators.membership import uncheckable_patterns
from docalign.operators.rule_index import RULE_ROW, Network
from docalign.plans.harmonize import harmonize

VALUES = ["a", "b", 1, 1.0, True, 0, False, None, "1", [1], {"x": None}, -0.0, 10**20, 1e20]


def random_condition(rng, depth):
    def item():
        if depth and rng.random() < 0.5:
            return random_condition(rng, depth - 1) or {"__must__": []}
        return {rng.choice("xyz"): rng.choice(VALUES) for _ in range(rng.randint(0, 2))}

    found = {}
    for key in ("__must__", "__should__"):
        if rng.random() < 0.6:
            found[key] = [item() for _ in range(rng.randint(0, 3))]
    return found


def holds(when, body):
    if not any(k.startswith("__") for k in when) and when:
        return all(body.get(f) == v for f, v in when.items())
    must = all(holds(i, body) for i in when.get("__must__", []))
    return must and ("__should__" not in when or any(holds(i, body) for i in when["__should__"]))


def applied(items, body):
    """Plain Python: the body after all rules, and the numbers of those that fired."""
    out, fired = dict(body), []
    for no, r in enumerate(items, 1):
        if holds(r["when"], body):
            fired.append(no)
            out.update(r["then"])
    return out, fired


@pytest.mark.parametrize("seed", range(3))
def test_rules_by_join_on_random_conditions(bodies, values_of, seed):
    rng = random.Random(seed)
    items = [{"when": random_condition(rng, 3), "then": {rng.choice("xyzuv"): i}} for i in range(40)]
    data = [{f: rng.choice(VALUES) for f in rng.sample("xyz", rng.randint(0, 3))} for _ in range(60)]
    done = rules.apply_rules(bodies(*data), rule_rows(items), lookup="join")
    wanted = [applied(items, b) for b in data]
    assert [list(b.items()) for b in values_of(done)] == [list(w[0].items()) for w in wanted]
    log = {r.id: [a.rule_no for a in r.applied_rules] for r in done.collect()}
    assert [log[i] for i in range(len(data))] == [w[1] for w in wanted]


def test_conditions_deeper_than_a_level_of_groups_each():
    when = {"x": 1}
    for _ in range(60):
        when = {"__must__": [when, {"__should__": [{"y": 2}, {"__must__": [{"z": None}, when if _ < 3 else {"y": 3}]}]}]}
    network = Network({"__must__": [when]})
    assert all(a < b <= network.last for a, b, _ in network.edges)
    every = [(a, b) for a, b, _ in network.edges]
    assert network.reaches(every) and not network.reaches(every[:1])


def test_rules_of_two_profiles_and_shared_ones(bodies, values_of):
    shared = rule_rows([{"when": {}, "then": {"s": 1}}, {"when": {"__must__": [{"x": None}]}, "then": {"n": 1}}])
    own = rule_rows([{"when": {"__should__": [{"x": 1}, {"y": None}]}, "then": {"s": 2}}], profile="p") + rule_rows(
        [{"when": {}, "then": {"o": 1}}], profile="other"
    )
    for profile in ("p", "other", "unknown", None, ""):
        docs = bodies({"x": 1.0}, {"y": 5}, {}, profile=profile)
        constant = rules.apply_rules(docs, shared + own)
        joined = rules.apply_rules(docs, shared + own, lookup="join")
        assert values_of(constant) == values_of(joined)
        fired = [sorted(map(tuple, rules.fired_rules(docs, shared + own, lookup=x).collect())) for x in ("constant", "join")]
        assert fired[0] == fired[1]


def test_no_rules_and_malformed_ones(spark, bodies, values_of):
    none = spark.createDataFrame([], RULE_ROW)
    assert values_of(rules.apply_rules(bodies({"a": 1}), none)) == [{"a": 1}]
    for bad in ({"when": [], "then": {}}, {"when": {}, "then": 1}, {"when": {"__must__": [1]}, "then": {}}, {"when": {"a": 1}, "then": {}}):
        with pytest.raises(Exception, match="must be|has __must__"):
            rules.apply_rules(bodies({"a": 1}), rule_rows([bad]), lookup="join").collect()


def test_more_rules_than_fit_a_plan(spark, bodies, values_of):
    """A hundred and fifty thousand rules: one document in a hundred fires its own."""
    many = spark.range(150_000).select(
        F.lit(None).cast("string").alias("profile"), F.lit(0).alias("part"), F.lit("f").alias("source_file"), F.col("id").cast("int").alias("pos"),
        F.concat(F.lit('{"__must__":[{"x":'), F.col("id").cast("string"), F.lit('},{"y":"b"}]}')).alias("when"), F.lit('{"hit":true}').alias("then"),
    )
    data = [{"x": 100 * i, "y": "b" if i % 2 else "c"} for i in range(50)]
    assert values_of(rules.apply_rules(bodies(*data), many)) == [d | ({"hit": True} if i % 2 else {}) for i, d in enumerate(data)]


FIELDS = [
    {"name": "a", "permissible_values": ["x", 1, True, 2.0, None, "None", [1]], "regex": r"\w+", "required": True},
    {"name": "b", "permissible_values": []},
    {"name": "c", "regex": "("},
    {"name": "d", "regex": r"\d+$|yes", "default_value": 5},
    {"name": "e", "regex": "(?(1)a|b)"},
]


def odd_bodies():
    rng = random.Random(4)
    pool = ["x", "1", 1, 1.0, 2, 2.0, True, False, None, "None", "", " ", [1], "[1]", "yes\n", "12", "é", {"k": 1}]
    return [{f: rng.choice(pool) for f in rng.sample("abcdefg", rng.randint(0, 6))} for _ in range(80)]


def test_checks_by_join_agree_with_constants(bodies):
    docs = bodies(*odd_bodies())
    table = target_schema(FIELDS)
    for check, into in (
        (quality.find_nonpermissible, quality.NONPERMISSIBLE), (quality.find_regex_violations, quality.REGEX),
        (quality.find_missing_required, quality.MISSING), (schema.validate_values, "valid"), (schema.attach_schema_facets, "facets"),
    ):
        found = [
            sorted((r.id, str(r[into])) for r in check(docs, table, body="metadata", lookup=way).collect()) for way in ("constant", "join")
        ]
        assert found[0] == found[1], into


def test_patterns_that_cannot_be_checked_are_named(spark, bodies):
    docs = bodies({"c": "q"})
    from docalign.operators.membership import schema_table

    left = uncheckable_patterns(schema_table(docs, target_schema(FIELDS, profile="p"))).collect()
    assert sorted((r.profile, r.field, r.regex) for r in left) == [("p", "c", "("), ("p", "e", "(?(1)a|b)")]


NAMES = ("_schema", "_match_x", "_matched", "_scope", "_h1", "_h2", "_match", "_found", "_renamed", "_places", "_fired", "_own", "_hit", "scope")


def test_own_columns_of_any_name_stay(bodies):
    """Columns that operators might use themselves come through with their values."""
    docs = bodies({"a": "x", "b": 1}, {"c": "(", "d": "n"}).withColumns({n: F.lit(f"own {n}") for n in NAMES})
    table, names, maps = target_schema(FIELDS), field_map({"a": "z"}), value_map({"b": {"1": "one"}})
    ruled = rule_rows([{"when": {"__must__": [{"b": 1}]}, "then": {"b": 2}}])
    for way in ("constant", "join"):
        results = [
            harmonize(docs, ruled, names, maps, table, lookup=way), quality.check_quality(docs, table, body="metadata", lookup=way),
            fields.rename_fields(docs, names, body="metadata", lookup=way), values.standardize_values(docs, maps, body="metadata", lookup=way),
            schema.conform_to_schema(docs, table, body="metadata", lookup=way), schema.validate_values(docs, table, body="metadata", lookup=way),
            schema.attach_schema_facets(docs, table, body="metadata", lookup=way),
            quality.find_missing_required(docs, table, body="metadata", lookup=way),
            rules.apply_rules(docs, ruled, lookup=way), rules.fired_rules(docs, ruled, lookup=way),
        ]
        for done in results:
            assert len(set(done.columns)) == len(done.columns) and set(NAMES) <= set(done.columns)
            assert all(r[n] == f"own {n}" for r in done.collect() for n in NAMES)
            added = [c for c in done.columns if c.startswith("_") and c not in NAMES]
            assert not added


def test_coverage_and_choices_by_join(spark, bodies):
    ruled = rule_rows([{"when": {"__must__": [{"b": 1}]}, "then": {"b": 2}}, {"when": {}, "then": {"q": 1}}])
    docs = bodies(*odd_bodies()).withColumns({"record_id": F.col("id").cast("string"), "group_name": F.lit("G"), "dataset_type": F.lit("t")})
    found = [sorted(map(tuple, report.rule_coverage(docs, ruled, lookup=w).collect()), key=str) for w in ("constant", "join")]
    assert found[0] == found[1]
    checked = quality.check_quality(docs, target_schema(FIELDS), body="metadata")
    lists = [sorted(map(tuple, review.choice_lists(quality.issue_rows(checked), target_schema(FIELDS), lookup=w).collect()), key=str) for w in ("constant", "join")]
    assert lists[0] == lists[1] and lists[0]
    assert json.dumps(lists[0], default=str)
