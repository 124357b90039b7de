"""Readers and sinks on files."""

import json

import pytest
from pyspark.sql import functions as F

from docalign.functions.cells import json_array, json_object
from docalign.operators.config import field_map, rules, target_schema
from docalign.operators.fields import crosswalk_to_field_map, merge_field_maps, unmapped_legacy_fields
from docalign.operators.quality import check_quality
from docalign.operators.rules import ordered_rules
from docalign.plans.harmonize import harmonize, log_entries, output_documents, run_summary
from docalign.sources.config import (
    read_crosswalk, read_field_map, read_field_maps, read_rules, read_target_schema, read_value_maps,
)
from docalign.sources.documents import (
    file_outcomes, read_documents, split_valid, write_document_lines, write_documents,
)
from docalign.sources.quality import write_quality
from docalign.streaming.documents import read_document_stream, write_document_stream

DOCUMENT = {
    "uuid": "1", "extra": [1, {"b": 2}], "record_id": "R1", "dataset_type": "T", "group_name": "G",
    "metadata": {"a": "é", "n": None}, "tail": 35.0,
}


def _write(folder, files):
    for name, content in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")


def test_documents_there_and_back(spark, tmp_path):
    _write(
        tmp_path / "in",
        {
            "good.json": json.dumps(DOCUMENT, indent=1, ensure_ascii=False),
            "second.json": {"uuid": "2", "dataset_type": "U", "metadata": {"a": "b"}},
            "no_body.json": {"uuid": "3"},
            "array.json": [1],
            "broken.json": "{",
            "null_body.json": {"metadata": None},
            "text_body.json": {"metadata": '{"a": 1}'},
            "ignored.txt": "{}",
            "below/ignored.json": {"metadata": {}},
        },
    )
    parsed = read_documents(spark, str(tmp_path / "in"))
    good, failed = split_valid(parsed)
    errors = {r.input_file.rsplit("/", 1)[1]: r.error for r in failed.collect()}
    assert errors == {
        "array.json": "input must contain a JSON object",
        "broken.json": "invalid JSON",
        "null_body.json": "metadata is not a JSON object",
        "text_body.json": "metadata is not a JSON object",
    }
    done = output_documents(harmonize(good, field_map=field_map({"a": "b"})))
    write_documents(done, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {r.dataset_type for r in back.select("dataset_type").collect()} == {"T", "U", "Unknown"}
    document = json.loads(back.where("dataset_type = 'T'").first().document)
    assert list(document) == [*DOCUMENT, "modified_metadata", "json_patch", "processing_log"]
    assert {k: document[k] for k in DOCUMENT} == DOCUMENT
    assert document["modified_metadata"] == {"b": "é", "n": None}
    assert '"tail":35.0' in back.where("dataset_type = 'T'").first().document
    assert "metadata" not in list(json.loads(back.where("dataset_type = 'Unknown'").first().document))
    write_document_lines(done, str(tmp_path / "lines"))
    lines = read_documents(spark, str(tmp_path / "lines"), one_per_file=False)
    assert lines.count() == 3 and lines.where("error is not null").count() == 0
    summary = run_summary(file_outcomes(harmonize(parsed, field_map=field_map({"a": "b"})), log_entries()))
    assert tuple(summary.first()) == (7, 3, 4, 3, 2)


def test_heads_that_need_their_kinds(spark, tmp_path):
    head = {"uuid": "12", "yes": "true", "num": 12, "list": "[1", "metadata": {"a": "1"}, "obj": '{"x": 1}\n'}
    _write(tmp_path, {"a.json": head})
    done = output_documents(harmonize(read_documents(spark, str(tmp_path)).drop("error")))
    write_document_lines(done, str(tmp_path / "out"))
    found = json.loads(spark.read.text(str(tmp_path / "out")).first().value)
    assert {k: found[k] for k in head} == head


def test_crosswalk(spark, tmp_path):
    text = (
        "target,v0,v1\r\npriority_level,order_priority,priority\nstatus_code,order_status,order_status\n"
        'amount,total,\n,note," note "\namount_alt,,total\n"with, comma","say ""x"""\n,next\nonly\n'
    )
    _write(tmp_path, {"c.csv": text})
    rows = read_crosswalk(spark, str(tmp_path), profile="p")
    fields = {r.legacy: r.target for r in crosswalk_to_field_map(rows).collect()}
    assert fields == {
        "order_priority": "priority_level", "priority": "priority_level", "order_status": "status_code",
        "total": "amount_alt", 'say "x"': "with, comma",
    }
    assert {r.legacy for r in unmapped_legacy_fields(rows).collect()} == {"note", "next"}
    _write(tmp_path / "bad", {"c.csv": "target,v0\n"})
    with pytest.raises(Exception, match="crosswalk needs"):
        read_crosswalk(spark, str(tmp_path / "bad")).collect()


def test_field_maps(spark, tmp_path):
    _write(tmp_path, {"1.json": {"a": "x", "b": None}, "2.json": {"a": "y", "b": "z", "c": "w"}})
    merged = read_field_maps(spark, str(tmp_path))
    assert {r.legacy: r.target for r in merged.collect()} == {"a": "x", "b": None, "c": "w"}
    one = read_field_map(spark, str(tmp_path / "2.json"))
    assert {r.legacy: r.target for r in one.collect()} == {"a": "y", "b": "z", "c": "w"}
    with pytest.raises(ValueError):
        read_field_map(spark, str(tmp_path / "2.txt"))
    _write(tmp_path / "bad", {"1.json": [1]})
    with pytest.raises(Exception, match="must be a JSON object"):
        read_field_maps(spark, str(tmp_path / "bad")).collect()


def test_value_maps(spark, tmp_path):
    _write(
        tmp_path,
        {
            "a.json": {"k": "flat", "other": {"x": 1}, "f": 35.0},
            "b.json": {"a": {"k": ["one", 2]}, "empty": {}},
            "c.json": {"other": {"y": None}, "m": True},
        },
    )
    rows = read_value_maps(spark, str(tmp_path)).select(
        "field", "legacy_key", "is_list", json_array(F.col("options")).alias("o")
    )
    assert {tuple(r) for r in rows.collect()} == {
        ("a", "k", True, '["one",2]'), ("other", "y", False, "[null]"), ("empty", None, False, "[]"),
        ("c", "m", False, "[true]"),
    }


def test_rules_come_folder_first_in_path_order(spark, tmp_path):
    one = lambda v: [{"when": {"__must__": [{"a": 1.5}]}, "then": {"v": v}}]
    _write(tmp_path / "dir", {"b.json": one("b"), "a/z.json": one("z"), "empty.json": []})
    _write(tmp_path, {"last.json": one("last")})
    found = ordered_rules(read_rules(spark, str(tmp_path / "dir"), str(tmp_path / "last.json")))
    assert [r["then"]["v"] for r in found] == ["z", "b", "last"]
    assert found[0]["when"] == {"__must__": [{"a": 1.5}]}
    _write(tmp_path / "bad", {"x.json": {"when": {}}})
    with pytest.raises(Exception, match="JSON array"):
        read_rules(spark, str(tmp_path / "bad")).collect()


def test_target_schema_reader_agrees_with_the_constructor(spark, tmp_path):
    fields = [
        {"name": "a", "description": "d", "type": "number", "required": True, "regex": "^x$", "default_value": 35.0,
         "permissible_values": ["q", 1, 1.5, True, None]},
        "junk", {"key": "b"}, {"name": ""},
        {"name": "c", "required": 1, "default_value": {"z": [1.0, "t"]}},
        {"name": "e", "permissible_values": []},
        {"name": "a", "required": "yes"},
    ]
    _write(tmp_path, {"s.json": fields})
    found = [r.asDict(True) for r in read_target_schema(spark, str(tmp_path / "s.json")).collect()]
    wanted = target_schema(fields)
    drop = lambda r: {k: v for k, v in r.items() if k != "pos"}
    found.sort(key=lambda r: r["pos"])
    assert [drop(r) for r in found] == [drop(r) for r in wanted]


def test_quality_tables(spark, tmp_path, bodies):
    schema = target_schema([{"name": "a", "required": True, "permissible_values": ["x"]}])
    docs = bodies({"a": "y"}, {"a": None}, {"a": "x"}).select(
        "metadata", F.concat(F.lit("D"), "id").alias("record_id"), F.lit("G").alias("group_name"),
        F.lit("T").alias("dataset_type"),
    )
    write_quality(check_quality(docs, schema, "metadata"), schema, str(tmp_path / "q"), "http://x/")
    read = lambda name: spark.read.json(str(tmp_path / "q" / name))
    assert {(r.field, r.value) for r in read("nonstandard_values").collect()} == {("a", "y"), ("a", "null")}
    assert read("counts").first().documents_processed == 3
    assert read("summary").first().total_datasets_with_issues == 2
    assert [(r.group_slug, r.dataset_id) for r in read("review/missing_required").collect()] == [("g-t", "D1")]
    assert [r.value for r in read("choices").collect()] == ["x"]


def test_stream_takes_only_new_files(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: write_document_stream(
        output_documents(harmonize(read_document_stream(spark, str(folder)), rules([{"when": {}, "then": {"v": 1}}]))),
        out, state,
    ).awaitTermination()
    _write(folder, {"1.json": DOCUMENT, "2.json": "{"})
    run()
    assert spark.read.parquet(out).count() == 2
    _write(folder, {"3.json": DOCUMENT})
    run()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 3
    good = [json.loads(r.document) for r in rows if r.error is None]
    assert [d["modified_metadata"] for d in good] == [{"a": "é", "n": None, "v": 1}] * 2


def test_readers_take_one_array_and_nothing_else(spark, tmp_path):
    (tmp_path / "good.json").write_text('\n [{"name":"a"}]\n')
    assert [r.name for r in read_target_schema(spark, str(tmp_path / "good.json")).collect()] == ["a"]
    (tmp_path / "rules.json").write_text('\n[{"when":{},"then":{"a":1}}] ')
    assert read_rules(spark, file=str(tmp_path / "rules.json")).count() == 1
    for text in ("[] junk", '{"name":"a"}', '[],"y":[]', "[1"):
        (tmp_path / "bad.json").write_text(text)
        with pytest.raises(Exception, match="must"):
            read_target_schema(spark, str(tmp_path / "bad.json")).collect()
        with pytest.raises(Exception, match="must"):
            read_rules(spark, file=str(tmp_path / "bad.json")).collect()


def test_crosswalk_quotes_as_in_csv(spark, tmp_path):
    import csv
    import io

    text = 'target,v0,v1\r\nsize,5" disk,\r\nname,3" lbl,x""y\r\n\r\n"a ""b""","c\nd","e"f"g\nlast,"open, to\nthe end'
    (tmp_path / "c.csv").write_bytes(text.encode())
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    found = read_crosswalk(spark, str(tmp_path / "c.csv")).collect()
    got = {(r.row_no, r.col_no): (r.target, r.legacy) for r in found}
    assert got == {(i, j): (r[0], r[j]) for i, r in enumerate(rows) if i for j in range(1, len(r))}


def test_split_valid_is_a_filter_of_the_scan(spark, tmp_path):
    from docalign.sources.documents import parse_documents, split_valid

    frame = spark.createDataFrame([(1, "a", "a.json", '{"uuid":"1","metadata":{}}')], "id int, stem string, source_file string, content string")
    parse_documents(frame).write.parquet(str(tmp_path / "parsed"))
    good, failed = split_valid(spark.read.parquet(str(tmp_path / "parsed")))
    plan = good.where("source_file = 'a.json'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(source_file,a.json)" in plan and "IsNull(error)" in plan and "head#" not in plan and "metadata#" not in plan
    assert good.count() == 1 and failed.count() == 0
