"""Quality checks, aggregates, review lists and reports."""

import re

from pyspark.sql import functions as F

from docalign.functions.text import is_blank, java_pattern, matches_whole, strip
from docalign.operators import quality as Q
from docalign.operators.config import field_map, rules, target_schema, value_map
from docalign.operators.report import field_mapping_matrix, report_counts, rule_coverage, value_mapping_catalog
from docalign.operators.review import choice_lists, review_rows
from docalign.plans.harmonize import harmonize

SCHEMA = target_schema(
    [
        {"name": "c", "required": True, "permissible_values": ["x", "5", 1, True, None]},
        {"name": "none", "permissible_values": []},
        {"name": "d", "required": True, "regex": r"\d{2}(?P<t>a)?"},
        {"name": "soft", "required": 1},
        {"name": "bad", "regex": "("},
    ]
)


def _found(frame, column):
    return [[(i.field, i.value) for i in r[column]] for r in frame.orderBy("id").collect()]


def test_nonpermissible(bodies):
    items = [
        {"c": "x"}, {"c": ""}, {"c": None}, {"c": 5}, {"c": 1.0}, {"c": "1"}, {"c": "True"}, {"c": "None"}, {"c": "X"},
        {"none": "a"}, {"none": None}, {"other": "a"}, {"c": ["a", 1]},
    ]
    done = Q.find_nonpermissible(bodies(*items), SCHEMA, body="metadata")
    assert _found(done, Q.NONPERMISSIBLE) == [
        [], [("c", "")], [], [], [], [], [], [], [("c", "X")], [("none", "a")], [], [], [("c", "['a', 1]")],
    ]


def test_missing_required(bodies):
    items = [{}, {"c": None, "d": "  \u001c"}, {"c": [], "d": {}}, {"c": 0, "d": False}, {"c": "a", "d": "b"}]
    done = Q.find_missing_required(bodies(*items), SCHEMA, body="metadata")
    assert _found(done, Q.MISSING) == [
        [("c", "MISSING_FIELD"), ("d", "MISSING_FIELD")],
        [("c", "null"), ("d", "")],
        [("c", "[]"), ("d", "{}")],
        [],
        [],
    ]


def test_regex_violations(bodies):
    items = [{"d": v} for v in ("12", "12a", "12\n", "123", " ", "", None, 12, "٣٤")] + [{"bad": "x"}, {}]
    done = Q.find_regex_violations(bodies(*items), SCHEMA, body="metadata")
    wanted = [
        [("d", str(i["d"]))]
        if i.get("d") is not None and str(i["d"]).strip() and not re.fullmatch(r"\d{2}(?P<t>a)?", str(i["d"]))
        else []
        for i in items
    ]
    assert _found(done, Q.REGEX) == wanted


def test_blank_and_strip_follow_unicode(spark):
    texts = ["", " ", " ", "\u001c", " \t\n", "a", " a　", "​"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = frame.select("t", is_blank(F.col("t")).alias("b"), strip(F.col("t")).alias("s")).collect()
    assert [(r.b, r.s) for r in rows] == [(r.t.strip() == "", r.t.strip()) for r in rows]


def test_patterns_for_java(spark):
    assert java_pattern("(") is None
    pattern = java_pattern(r"(?P<q>a)(?P=q)\Z")
    row = spark.range(1).select(matches_whole(F.lit("aa"), pattern).alias("m")).first()
    assert row.m


def _checked(bodies, spark):
    rows = [
        (0, "Some Group", "T", "D1", {"c": "X", "d": "1"}),
        (1, "SOME group", "T", "D1", {"c": "Y", "d": "12"}),
        (2, "Some Group", "T", "D2", {"c": "x", "d": "12"}),
        (3, "Clean", "T", "D3", {"c": "x", "d": "12"}),
        (4, None, None, None, {}),
    ]
    heads = spark.createDataFrame(
        [r[:4] for r in rows], "id int, group_name string, dataset_type string, record_id string"
    )
    docs = bodies(*[r[4] for r in rows]).drop("profile").join(heads, "id")
    return Q.check_quality(docs, SCHEMA, body="metadata")


def test_aggregates_and_review(bodies, spark):
    checked = _checked(bodies, spark)
    summary = {
        r.group_slug: tuple(r)[1:] for r in Q.group_summary(checked, first_by="id").collect()
    }
    assert summary == {
        "some-group-t": ("Some Group", "T", 1, 0, 1, 1),
        "clean-t": ("Clean", "T", 0, 0, 0, 0),
        "unknown-group-unknown": ("Unknown Group", "Unknown", 0, 1, 0, 1),
    }
    assert {tuple(r) for r in Q.nonstandard_values(checked).collect()} == {
        ("c", "X"), ("c", "Y"), ("d", "1"), ("c", "MISSING_FIELD"), ("d", "MISSING_FIELD"),
    }
    assert tuple(Q.quality_counts(checked).first()) == (5, 2, 1, 1, 5)
    issues = Q.issue_rows(checked)
    rows = review_rows(issues, Q.NONPERMISSIBLE, "http://x/", ordered=True).collect()
    assert [tuple(r) for r in rows] == [("some-group-t", "D1", "c", "X", "", "http://x/D1")]
    rows = review_rows(issues, Q.REGEX, "http://x/", {"d": "two digits"}).collect()
    assert [tuple(r) for r in rows] == [("some-group-t", "D1", "d", "1", "", "two digits", "http://x/D1")]
    assert review_rows(issues, Q.MISSING, "u").columns == [
        "group_slug", "dataset_id", "field_name", "new_value", "dataset_url",
    ]
    choices = {(r.group_slug, r.field, r.col_no, r.row_no, r.value) for r in choice_lists(issues, SCHEMA).collect()}
    assert {c for c in choices if c[0] == "some-group-t"} == {
        ("some-group-t", "c", 1, i, v) for i, v in enumerate(["x", "5", "1", "true", None], 1)
    }


def test_reports(bodies, spark):
    docs = bodies({"p": "18"}, {"p": "t"}, {"p": "z"}, profile="east").withColumn("group_name", F.lit("g"))
    maps = value_map({"f": {"18": 1, "t": True, "z": None}})
    done = harmonize(docs, field_map=field_map({"p": "f"}), value_map=maps)
    catalog = value_mapping_catalog(done)
    assert {tuple(r)[1:] for r in catalog.collect()} == {
        ("f", "18", "1", True), ("f", "t", "True", True), ("f", "z", "None", False),
    }
    crosswalk = spark.createDataFrame(
        [("east", "f", 1, 1, "v0", "p", "f"), ("east", "f", 1, 2, "v1", "", "f"), ("east", "f", 2, 1, "v0", "q", "g")],
        "profile string, source_file string, row_no int, col_no int, schema_version string, legacy string, target string",
    )
    listed = rules([{"when": {}, "then": {}}, {"when": {"__must__": [{"p": "t"}]}, "then": {"a": 1}}], "east")
    assert [tuple(r) for r in report_counts(crosswalk, catalog, listed).collect()] == [("east", 2, 3, 2)]
    labels = {(r.col_no, r.version_label) for r in field_mapping_matrix(crosswalk, {"v0": "Version 0"}).collect()}
    assert labels == {(1, "Version 0"), (2, "v1")}
    assert {tuple(r) for r in rule_coverage(docs, listed).collect()} == {("east", 1, "g", 3), ("east", 2, "g", 1)}


PATTERNS = [
    "a{,3}", "[[]x", "a{x", "x(?#c)", ".+", r"\s", "[a&&b]", r"\w", r"\d+", r"\S+", r"\W", r"\D", "[^a]", r"[\w-]+", "(?i)straße",
    "a|b", "(a|b)*c", "a+?b", "a*+b", "(?>a+)b", r"(a)\1", r"(?P<q>a)(?P=q)\Z", "^a$", r"\Aa\Z", r"a\b.b", "(?s).+", "(?m)^a$",
    "(?=a)a", "(?!a)b", "(?<=a)b", "a(?<!b)c", "(?:ab)?", "[a-c]{2}", r"\x41", r"\u00e9", "[]a]", r"[\]\[]", "{}", "a{1", "}", "[^\\n]+",
    r"LC-\d{3}", r"\d{4}-\d{2}-\d{2}", "(?a:\\w+)", "x*", "", "[[a]", r"\.", "#", " ", "a{2}{3}", "(?i:A)b", "[A-z]", "é",
]
TEXTS = [
    "", "a", "b", "ab", "aa", "aaa", "aaaa", "a{,3}", "[x", "a{x", "x", "a\rb", "\x1c", "&", "a&", "\u0301", "é", "É", "١٢", "²", "STRASSE",
    "straße", "STRAßE", "c", "abc", "aab", "a\n", "a\nb", "ac", "cc", "A", "]", "[", "{}", "a{1", "}", "LC-001", "LC-001\n", "2020-01-02", "_", "-",
    "\u2028", "\x85", "a b", "😀", "[a", ".", "#", " ", "aaaaaa", "Ab", "^", "\n",
]


def test_patterns_match_as_in_python(spark):
    import re

    texts = spark.createDataFrame([(t,) for t in TEXTS], "t string").coalesce(1)
    for pattern in PATTERNS:
        printed = java_pattern(pattern)
        try:
            wanted = [bool(re.fullmatch(pattern, t)) for t in TEXTS]
        except re.error:
            assert printed is None
            continue
        assert printed is not None, pattern
        got = [r.m for r in texts.select(matches_whole(F.col("t"), printed).alias("m")).collect()]
        assert [(t, g) for t, g in zip(TEXTS, got)] == [(t, w) for t, w in zip(TEXTS, wanted)], pattern


def test_documents_with_a_null_group_are_not_counted(spark):
    from docalign.sources.documents import parse_documents

    heads = ['"group_name":"G"', '"group_name":null', '"dataset_type":null', '"status":"x"']
    texts = [(i, "d", "d.json", f'{{"uuid":"{i}",{h},"metadata":{{"c":"no"}}}}') for i, h in enumerate(heads)]
    frame = spark.createDataFrame(texts, "id int, stem string, source_file string, content string")
    docs = parse_documents(frame).withColumn("modified_metadata", F.col("metadata"))
    checked = Q.check_quality(docs, SCHEMA)
    assert Q.quality_counts(checked).first().documents_processed == 2
    assert {r.group_slug for r in Q.group_summary(checked).collect()} == {"g-unknown", "unknown-group-unknown"}
    assert {r.group_slug for r in Q.issue_rows(checked).collect()} == {"g-unknown", "unknown-group-unknown"}


def test_patterns_without_a_counterpart_are_not_checked(spark):
    for pattern in ["(a)?(?(1)b|c)", "(", "(?<=a+)b"]:
        assert java_pattern(pattern) is None
