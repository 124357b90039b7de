"""Parsing and rendering of bodies."""

import json

from pyspark.sql import functions as F

from docalign.functions import cells as C

GOOD = {
    "text": "x",
    "whole float": 35.0,
    "number": 1,
    "yes": True,
    "nothing": None,
    "nested": {"z": 1, "a": [1, 2.5, None, "it's", 'say "hi"', "tab\t", True]},
    "long": 12345678901234567890,
    "thousand": 1e3,
    "small": 1e-05,
    "odd": 0.28800000000000003,
    "quote": 'é\n"q/\\',
    "wide": 12345678.9,
    "wider": 1e16,
    "tiny": -0.00012,
    "huge": 1.5e300,
    "list": ["I1", "I2"],
    "negative": -123456789012.5,
    "empty list": [],
    "empty object": {},
    "control": "a\u0001b",
    "looks like": "true",
    "": "no name",
}
BAD = [
    "", "  ", "null", "[1]", '"x"', "{bad", '{"a":01}', "{a:1}", "{'a':1}", '{"a":1} tail', '{"a":1}{"b":2}',
    '{"a":1},{"b":2}', '{"a":1}]', '{"a":1}}', '{"a":1', '{"a":1}] [{"b":1}',
]


def _parsed(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    frame = frame.withColumn("c", C.parse_cells(F.col("t")))
    return frame.select(
        "c",
        C.json_object(F.col("c")).alias("json"),
        F.transform("c", lambda c: C.python_text(c["kind"], c["text"])).alias("printed"),
    ).collect()


def test_round_trip_keeps_order_kinds_and_numbers(spark):
    row = _parsed(spark, [json.dumps(GOOD)])[0]
    assert row.json == json.dumps(GOOD, ensure_ascii=False, separators=(",", ":"))
    for cell, printed, (field, value) in zip(row.c, row.printed, GOOD.items()):
        assert cell.field == field
        assert printed == (None if value is None else str(value))


def test_only_one_json_object_is_accepted(spark):
    assert [r.c for r in _parsed(spark, [*BAD, None])] == [None] * (len(BAD) + 1)
    assert [r.json for r in _parsed(spark, ["{}", " { } "])] == ["{}", "{}"]


def test_repeated_keys(spark):
    rows = _parsed(spark, ['{"a":1,"b":5,"a":2}', '{"n":{"x":1,"x":2},"m":"t","f":1.5,"w":null}'])
    assert rows[0].json == '{"a":2,"b":5}'
    assert [(c.field, c.kind) for c in rows[1].c] == [
        ("n", "object"), ("m", "string"), ("f", "float"), ("w", "null"),
    ]


def test_equal_values_follow_number_equality():
    texts = lambda v: {(x["kind"], x["text"]) for x in C.equal_values(v)}
    assert texts(1) == {("integer", "1"), ("float", "1.0"), ("boolean", "true")}
    assert texts("1") == {("string", "1")}
    assert texts(False) == {("boolean", "false"), ("integer", "0"), ("float", "0.0"), ("float", "-0.0")}
    assert texts(2.5) == {("float", "2.5")}


def test_objects_are_printed_whole(spark, bodies):
    """Texts that look like the engine's own printing, escapes, nested values, and no piece-by-piece rendering of plain ones."""
    odd = [
        {"field": '{"field":"a","kind":"string","text":"b"}', 'k","kind':  'x","text":"y', "{": "{", '{"': '{"', "$1": "\\$2 \\"},
        {"kind": "null", "text": None, "n": 1, "m": -2.5, "t": True, "e": [], "o": {}, "deep": {"a": ["b", {"c": 1}]}},
        {"long": '\\"' * 20000, "é\n": " \u007f\u0001/"}, {"a": [1, 2]}, {},
    ]
    got = [r.t for r in bodies(*odd).orderBy("id").select(C.json_object(F.col("metadata")).alias("t")).collect()]
    assert got == [json.dumps(b, ensure_ascii=False, separators=(",", ":")) for b in odd]
    plain = spark.createDataFrame([([],)], f"c {C.CELLS}").select(C.json_object(F.col("c")).alias("t"))
    assert plain.first().t == "{}" and "regexp_replace" in plain._jdf.queryExecution().analyzed().toString()
