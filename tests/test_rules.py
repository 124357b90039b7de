"""Conditional updates."""

import pytest

from docalign.operators.config import rules
from docalign.operators.rules import apply_rules, compile_condition, fired_rules


def _when(spark_bodies, values_of, when, *items):
    done = apply_rules(spark_bodies(*items), rules([{"when": when, "then": {"hit": 1}}]))
    return ["hit" in b for b in values_of(done)]


def test_must_should_and_both(bodies, values_of):
    items = [{"a": "1", "b": "2"}, {"a": "1"}, {"b": "2"}, {}]
    must = {"__must__": [{"a": "1"}, {"b": "2"}]}
    should = {"__should__": [{"a": "1"}, {"b": "2"}]}
    assert _when(bodies, values_of, must, *items) == [True, False, False, False]
    assert _when(bodies, values_of, should, *items) == [True, True, True, False]
    both = {"__must__": [{"a": "1"}], "__should__": [{"b": "2"}, {"b": "3"}]}
    assert _when(bodies, values_of, both, *items) == [True, False, False, False]


def test_nesting_and_several_fields_in_one_item(bodies, values_of):
    items = [{"a": "1", "b": "2", "c": "9"}, {"a": "1", "c": "3"}, {"a": "1", "b": "2"}, {"b": "2", "c": "3"}]
    nested = {"__must__": [{"a": "1"}, {"__should__": [{"__must__": [{"b": "2"}, {"c": "9"}]}, {"c": "3"}]}]}
    assert _when(bodies, values_of, nested, *items) == [True, True, False, False]
    assert _when(bodies, values_of, {"__should__": [{"a": "1", "b": "2"}]}, *items) == [True, False, True, False]


def test_empty_conditions(bodies, values_of):
    assert _when(bodies, values_of, {}, {}) == [True]
    assert _when(bodies, values_of, {"__must__": []}, {}) == [True]
    assert _when(bodies, values_of, {"__should__": []}, {}) == [False]
    assert _when(bodies, values_of, {"__should__": [{}]}, {}) == [True]


def test_equality_is_typed_and_exact(bodies, values_of):
    items = [{"a": 1}, {"a": 1.0}, {"a": True}, {"a": "1"}, {"a": None}, {}, {"a": "1 "}]
    assert _when(bodies, values_of, {"__must__": [{"a": 1}]}, *items) == [True, True, True, False, False, False, False]
    assert _when(bodies, values_of, {"__must__": [{"a": "1"}]}, *items) == [False] * 3 + [True] + [False] * 3
    assert _when(bodies, values_of, {"__must__": [{"a": None}]}, *items) == [False] * 4 + [True, True, False]
    lists = [{"a": ["x", "y"]}, {"a": ["x"]}]
    assert _when(bodies, values_of, {"__must__": [{"a": ["x", "y"]}]}, *lists) == [True, False]


def test_rules_see_the_original_and_the_last_one_wins(bodies, values_of):
    listed = [
        {"when": {"__must__": [{"a": "1"}]}, "then": {"a": "2", "z": "first", "n": None}},
        {"when": {"__must__": [{"a": "2"}]}, "then": {"chained": True}},
        {"when": {"__must__": [{"b": "x"}]}, "then": {"z": "second", "y": [1]}},
    ]
    done = values_of(apply_rules(bodies({"a": "1", "b": "x"}, {"b": "x"}, {}), rules(listed)))
    assert [list(d.items()) for d in done] == [
        [("a", "2"), ("b", "x"), ("z", "second"), ("n", None), ("y", [1])],
        [("b", "x"), ("z", "second"), ("y", [1])],
        [],
    ]


def test_rules_of_a_profile(bodies, values_of):
    mixed = rules([{"when": {}, "then": {"p": "east"}}], "east") + rules([{"when": {}, "then": {"p": "all"}}])
    assert values_of(apply_rules(bodies({}, profile="east"), mixed)) == [{"p": "east"}]
    assert values_of(apply_rules(bodies({}, profile="west"), mixed)) == [{"p": "all"}]


def test_fired_rules_tell_their_conditions(bodies):
    listed = rules([{"when": {"__must__": [{"a": "1"}]}, "then": {"b": "2"}}, {"when": {}, "then": {}}])
    rows = fired_rules(bodies({"a": "1"}, {}), listed).collect()
    assert sorted((r.id, r.rule_no, r.conditions) for r in rows) == [
        (0, 1, '{"__must__": [{"a": "1"}]}'), (0, 2, "{}"), (1, 2, "{}"),
    ]


@pytest.mark.parametrize(
    "when", [[], {"must": []}, {"__must__": {}}, {"__should__": ["x"]}, {"__must__": [{"__must__": [1]}]}]
)
def test_malformed_conditions_raise(when, spark):
    with pytest.raises(ValueError):
        compile_condition(when, None)
