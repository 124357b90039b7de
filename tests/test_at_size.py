"""What keeps the registered queries whole on large tables: parses, partitions and joins."""

from pyspark.sql import functions as F

from checks import fixtures as X
from checks import registered as R
from docalign.functions import cells as C


def _parts(spark, folder, n=40):
    k = F.col("id")
    spark.range(n).select(
        k.alias("p_partkey"), F.lit("Brand#1").alias("p_brand"),
        F.when(k % 2 == 0, F.lit("SMALL")).otherwise(F.lit("LARGE")).alias("p_type"), (k % 50).cast("int").alias("p_size"),
    ).coalesce(1).write.parquet(f"{folder}/part.parquet")
    return str(folder)


def _plan(rows):
    return rows._jdf.queryExecution().toString()


def test_a_text_is_parsed_once_as_kinds_and_once_as_raw_text(spark):
    """Each parse stood in the expression three times, and in a list once for each value."""
    text = spark.range(1).select(F.lit('{"a":[1.50]}').alias("t"))
    plan = text.select(C.parse_cells(F.col("t")).alias("c"))._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count("from_json(") == 2
    found = text.select(C.parse_values(F.lit('[1.50,"[1]",null,{"a":1}]')).alias("v")).first().v
    assert [tuple(v) for v in found] == [("float", "1.5"), ("string", "[1]"), ("null", None), ("object", '{"a":1}')]


def test_documents_of_parts_are_made_on_all_cores(spark, tmp_path, monkeypatch):
    folder = _parts(spark, tmp_path)
    cores = spark.sparkContext.defaultParallelism
    assert X.part_documents(spark, folder).rdd.getNumPartitions() == cores
    monkeypatch.setattr(X, "ROWS_A_TASK", 2)
    assert X.schema_files(spark, folder).rdd.getNumPartitions() == max(cores, 20)


def test_catalogs_of_parts_are_not_broadcast(spark, tmp_path):
    """One profile a document: a broadcast would send the whole catalog through the driver."""
    folder = _parts(spark, tmp_path)
    found = R.nonpermissible_catalog(spark, folder)
    for key in ("profile", "_scope"):
        assert f"BroadcastHashJoin [{key}" not in _plan(found)
    assert found.count() > 0


def test_a_head_that_needs_kinds_parses_its_raw_texts_once(spark):
    """They were parsed again for the kinds."""
    text = spark.range(1).select(F.lit('{"uuid":"1","n":12345678901234567890123,"m":{"a": 1},"metadata":{"b": 1}}').alias("t"))
    head = text.select(C.parse_head(F.col("t"), "metadata").alias("h"))
    assert head._jdf.queryExecution().analyzed().toString().lower().count("from_json(") == 2
    assert [tuple(c) for c in head.first().h] == [
        ("uuid", "string", "1"), ("n", "integer", "12345678901234567890123"), ("m", "object", '{"a":1}'), ("metadata", "object", '{"b":1}'),
    ]


def _events(spark, folder, n):
    spark.range(n).select(
        F.col("id").alias("event_id"), F.lit("view").alias("event_type"), F.lit('{"k": 1}').alias("props")
    ).coalesce(1).write.parquet(f"{folder}/events.parquet")
    spark.range(16).select(F.col("id").alias("s_suppkey"), F.lit(1).alias("s_nationkey")).write.parquet(f"{folder}/supplier.parquet")
    return str(folder)


def test_batches_of_a_stream_keep_all_cores_busy(spark, tmp_path, monkeypatch):
    """Batches were of four files, whatever the number of files and cores."""
    folder = _events(spark, tmp_path, 800)
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(X, "ROWS_A_TASK", 800 // (4 * cores))
    written = R._streamed(spark, folder)
    runs = [r.files for r in R.outcomes.read_runs(spark, written).collect()]
    assert 1 < len(runs) <= 3 and sum(runs) == 800
    assert R._files_a_batch(spark, cores) == 4


def test_documents_that_are_only_counted_are_not_written(spark, tmp_path):
    folder = _events(spark, tmp_path, 410)
    found = R.config_dead_letters(spark, folder)
    assert any("events.parquet" in f for f in found.inputFiles())
    rows = {(r.profile, r.status, r.error): r.n for r in found.collect()}
    assert sum(rows.values()) == 410
    # Its field map is broken (and the shared value map, which its own one stands in for).
    assert rows["s-4", "failed", "config: field map field-map/000000004.json: invalid JSON"] == 5
    assert rows[None, "failed", "config: value map value-map/all.json: a value map must be a JSON object"] == 5
