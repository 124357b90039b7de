"""Renaming, standardizing, conforming, and the diff."""

import json

import pytest
from pyspark.sql import functions as F

from docalign.operators.config import field_map, target_schema, value_map
from docalign.operators.fields import rename_fields
from docalign.operators.schema import attach_schema_facets, conform_to_schema, validate_values
from docalign.operators.values import standardize_values, unmapped_values
from docalign.plans.harmonize import harmonize, output_documents


def _rename(bodies, values_of, names, *items):
    done = rename_fields(bodies(*items), field_map(names), body="metadata")
    logs = [{m.legacy: m.target for m in r.field_mappings} for r in done.orderBy("id").collect()]
    return [list(b.items()) for b in values_of(done)], logs


def _replay(item, names):
    """The rename, spelled out field by field."""
    out, log = {}, {}
    for field, value in item.items():
        target = names.get(field)
        if target is None:
            out[field] = value
        elif target not in out:
            out[target] = value
            if target != field:
                log[field] = target
    return list(out.items()), log


def test_rename_collisions(bodies, values_of):
    names = {"a": "t", "b": "t", "c": "t", "same": "same", "none": None}
    items = [
        {"a": 1, "b": 2, "x": 3},
        {"b": 2, "a": 1},
        {"a": 1, "t": 9, "b": 2},
        {"t": 9, "a": 1},
        {"same": 5, "none": 6, "c": None},
        {"x": 0, "c": 1, "t": None, "a": 2, "y": ""},
        {},
    ]
    found, logs = _rename(bodies, values_of, names, *items)
    assert found == [_replay(i, names)[0] for i in items]
    assert logs == [_replay(i, names)[1] for i in items]


VALUES = {
    "f": {"18": "n", "True": "yes", "35.0": 35, "None": "never", "": None, "['a', 'b']": "list"},
    "g": {"one": ["only"], "many": ["x", "y"], "no": [], "same": "same"},
    "e": {},
}


def test_standardize(bodies, values_of):
    items = [
        {"f": 18}, {"f": "18"}, {"f": True}, {"f": 35.0}, {"f": None}, {"f": ""}, {"f": ["a", "b"]}, {"f": "18 "},
        {"g": "one"}, {"g": "many"}, {"g": "no"}, {"g": "same"}, {"h": "one"},
    ]
    done = standardize_values(bodies(*items), value_map(VALUES), body="metadata")
    assert values_of(done) == [
        {"f": "n"}, {"f": "n"}, {"f": "yes"}, {"f": 35}, {"f": None}, {"f": None}, {"f": "list"}, {"f": "18 "},
        {"g": "only"}, {"g": "many"}, {"g": []}, {"g": "same"}, {"h": "one"},
    ]
    rows = done.orderBy("id").collect()
    assert [[(m.field, m.old, m.text) for m in r.value_mappings] for r in rows][3:6] == [
        [("f", "35.0", "35")], [], [("f", "", None)],
    ]
    assert [m.text for m in rows[11].value_mappings] == ["same"]
    assert [(m.field, m.text, [o.text for o in m.options]) for m in rows[9].ambiguous_mappings] == [
        ("g", "many", ["x", "y"])
    ]


MAP_SCHEMA = "profile string, field string, legacy_key string, is_list boolean, options array<struct<kind:string,text:string>>"


def test_maps_by_constant_and_by_join_give_the_same_result(bodies, values_of, spark):
    names = {"a": "t", "b": "t", "p": "f"}
    items = [{"a": 1, "b": 2, "t": 3}, {"p": "18", "g": "many"}, {"p": True}, {}, {"q": None, "g": "no"}, {"p": True}]
    fields = spark.createDataFrame([(None, k, v) for k, v in names.items()], "profile string, legacy string, target string")
    values = spark.createDataFrame(value_map(VALUES), MAP_SCHEMA)
    wanted = values_of(harmonize(bodies(*items), field_map=fields, value_map=values, lookup="constant"))
    assert values_of(harmonize(bodies(*items), field_map=fields, value_map=values)) == wanted
    assert values_of(harmonize(bodies(*items), field_map=field_map(names), value_map=value_map(VALUES), lookup="join")) == wanted
    for lookup in ("constant", "join"):
        found = unmapped_values(bodies({"f": "u", "e": 1, "z": 2}), values, "metadata", lookup).collect()
        assert {(r.field, r.value, r.n) for r in found} == {("f", "u", 1), ("e", "1", 1)}
    with pytest.raises(ValueError):
        harmonize(bodies(*items), field_map=fields, lookup="large")


@pytest.mark.parametrize("lookup", ["constant", "join"])
def test_map_rules_hold_for_both_lookups(bodies, values_of, lookup):
    # A profile whose map is empty follows its own map, not the shared one.
    rows = value_map({"f": {"a": "A"}}) + value_map({"f": {}}, profile="own")
    docs = bodies({"f": "a"}, profile="own").unionByName(bodies({"f": "a"}, {"f": "a"}, profile="other"))
    got = [r["f"] for r in values_of(standardize_values(docs, rows, body="metadata", lookup=lookup))]
    assert sorted(got) == ["A", "A", "a"]
    # Documents without a profile follow the shared part.
    assert values_of(standardize_values(docs.drop("profile"), rows, body="metadata", lookup=lookup))[0] == {"f": "A"}
    # A key that is listed twice is an error.
    with pytest.raises(Exception, match="lists a key twice"):
        standardize_values(docs, rows + value_map({"f": {"a": "B"}}), body="metadata", lookup=lookup).collect()
    with pytest.raises(Exception, match="lists a key twice"):
        rename_fields(docs, field_map({"f": "x"}) + field_map({"f": "y"}), body="metadata", lookup=lookup).collect()


SCHEMA = [
    {"name": "a", "required": True, "default_value": "d", "permissible_values": ["x", 1]},
    "skipped",
    {"description": "no name"},
    {"name": "b", "default_value": 2},
    {"name": "c"},
    {"name": "a", "required": False, "default_value": "later", "permissible_values": ["x", 1]},
]


def test_conform(bodies, values_of):
    items = [{"z": 1, "b": None, "c": ""}, {}, {"c": [1], "a": 0}]
    done = conform_to_schema(bodies(*items), target_schema(SCHEMA), body="metadata")
    assert [list(b.items()) for b in values_of(done)] == [
        [("a", "later"), ("b", None), ("c", "")],
        [("a", "later"), ("b", 2), ("c", None)],
        [("a", 0), ("b", 2), ("c", [1])],
    ]
    assert values_of(done, "excluded_data") == [{"z": 1}, {}, {}]


def test_no_schema_fields_empties_the_body(bodies, values_of):
    done = conform_to_schema(bodies({"a": 1}), [], body="metadata")
    assert (values_of(done), values_of(done, "excluded_data")) == ([{}], [{"a": 1}])


def test_validation_and_facets(bodies):
    items = [{"a": "x", "b": 9}, {"a": 1}, {"a": 1.0}, {"a": "1"}, {"a": None}, {"z": 1}]
    done = validate_values(bodies(*items), target_schema(SCHEMA), body="metadata").orderBy("id").collect()
    assert [r.valid for r in done] == [[True, True], [True], [True], [False], [False], [True]]
    facets = attach_schema_facets(bodies({"b": 1, "z": 1}), target_schema(SCHEMA), body="metadata").first().facets
    assert [(f.field, f.required, f.default_kind, f.default_text) for f in facets] == [
        ("b", False, "integer", "2"), ("z", False, "null", None),
    ]


def _apply(patch, old):
    for p in patch:
        key = p["path"][1:].replace("~1", "/").replace("~0", "~")
        if p["op"] == "remove":
            del old[key]
        else:
            assert (p["op"] == "replace") == (key in old)
            old[key] = p["value"]
    return old


def test_output_document(bodies):
    items = [{"a/b": 1, "c~d": 'q"', "keep": True}, {"p": "18", "g": "many", "n": None}, {}]
    done = output_documents(
        harmonize(
            bodies(*items),
            field_map=field_map({"p": "f", "a/b": "x/y"}),
            value_map=value_map(VALUES),
            schema=target_schema([{"name": n} for n in ("f", "g", "keep", "c~d", "x/y")]),
        )
    )
    from docalign.sources.documents import document_json

    texts = [r.t for r in done.orderBy("id").select(document_json(done).alias("t")).collect()]
    for text, item in zip(texts, items):
        found = json.loads(text)
        assert list(found) == ["metadata", "modified_metadata", "json_patch", "processing_log"]
        assert found["metadata"] == item
        assert list(found["modified_metadata"]) == ["f", "g", "keep", "c~d", "x/y"]
        assert _apply(found["json_patch"], dict(item)) == found["modified_metadata"]
        order = [(p["op"], p["path"]) for p in found["json_patch"]]
        assert order == sorted(order)
    log = json.loads(texts[1])["processing_log"]
    assert log == {
        "field_mappings": {"p": "f"},
        "value_mappings": {"f": {"18": "n"}},
        "ambiguous_mappings": [{"field": "g", "value": "many", "permissible_values": ["x", "y"]}],
        "excluded_data": {"n": None},
    }
    assert list(log) == ["field_mappings", "value_mappings", "ambiguous_mappings", "excluded_data"]


def test_phases_that_are_not_given_are_skipped(bodies, values_of):
    done = harmonize(bodies({"a": "1"}))
    assert values_of(done) == [{"a": "1"}]
    assert all(len(done.first()[c]) == 0 for c in ("field_mappings", "value_mappings", "excluded_data"))


def test_harmonize_has_no_exchange_and_any_partitioning_agrees(bodies, values_of):
    docs = bodies(*[{"p": str(i), "g": "one"} for i in range(20)])
    settings = dict(field_map=field_map({"p": "f"}), value_map=value_map(VALUES), schema=target_schema([{"name": "f"}]))
    done = harmonize(docs, **settings)
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()
    assert values_of(done) == values_of(harmonize(docs.repartition(7, F.rand(1)), **settings))


def test_a_value_shared_by_a_third_of_all_documents(spark, values_of):
    from docalign.sources.documents import table_to_documents

    value = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.col("id").cast("string")))
    docs = table_to_documents(spark.range(600).repartition(8, "id"), {"id": F.col("id")}, [("a", value), ("b", F.col("id"))])
    rows = value_map({"a": {"hot": "H", "v1": None, "v2": ["x", "y"]}, "b": {str(i): i + 1 for i in range(0, 600, 2)}})
    table = spark.createDataFrame(
        rows,
        "profile string, field string, legacy_key string, is_list boolean, options array<struct<kind:string,text:string>>",
    )
    wanted = values_of(standardize_values(docs, rows, body="metadata"))
    assert values_of(standardize_values(docs, table, body="metadata")) == wanted
    assert wanted[0] == {"a": "H", "b": 1} and wanted[1] == {"a": None, "b": 1} and wanted[2] == {"a": "v2", "b": 3}
