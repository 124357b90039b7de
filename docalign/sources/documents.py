"""Documents in and out: JSON text to rows, wide tables to rows, rows to files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.sources.files import scan_text

HEAD_FIELDS = ("uuid", "status", "group_name", "dataset_type")


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    profile: str | None = None,
    id_field: str = "record_id",
    one_per_file: bool = True,
) -> DataFrame:
    """Scan JSON documents, one per ``*.json`` file or one per line.

    Broken documents stay as rows with an ``error``; see ``split_valid``.
    Millions of small files are slow to list on any file system: prefer JSON
    Lines (``one_per_file=False``), which also splits by byte range.
    """
    pattern = "*.json" if one_per_file else None
    files = scan_text(spark.read, path, pattern, whole=one_per_file, profile=profile)
    return parse_documents(files, id_field)


def parse_documents(texts: DataFrame, id_field: str = "record_id") -> DataFrame:
    """Parse the ``content`` column of text rows into documents.

    Adds ``head`` (top-level cells in order, with an empty placeholder where
    the body was), the well-known head fields as columns, the body as cells in
    ``metadata``, and ``error``, which is null for a good document. A body that
    is absent counts as empty; a null or non-object body is an error.
    """
    parsed = texts.withColumn("_top", C.parse_head(F.col("content"), "metadata"))
    placed = parsed.withColumn("_body", C.cell_of(F.col("_top"), "metadata"))
    body = (
        F.when(F.col("_top").isNull(), F.lit(None).cast(C.CELLS))
        .when(F.col("_body").isNull(), C.no_cells())
        .when(F.col("_body.kind") == "object", C.parse_cells(F.col("_body.text")))
    )
    head = F.transform(
        F.col("_top"),
        lambda c: F.when(
            c["field"] == "metadata", C.cell(c["field"], c["kind"], F.lit(None).cast("string"))
        ).otherwise(c),
    )
    error = (
        F.when(F.col("_top").isNotNull() & F.col("metadata").isNotNull(), F.lit(None))
        .when(F.col("_top").isNotNull(), F.lit("metadata is not a JSON object"))
        .when(_one_value(F.col("content")), F.lit("input must contain a JSON object"))
        .otherwise(F.lit("invalid JSON"))
    )
    heads = [
        C.cell_of(F.col("_top"), source)["text"].alias(name)
        for name, source in [("record_id", id_field), *[(f, f) for f in HEAD_FIELDS]]
    ]
    carried = [c for c in texts.columns if c != "content"]
    return (
        placed.withColumn("metadata", body)
        .withColumn("error", error.cast("string"))
        .select(*carried, *heads, head.alias("head"), "metadata", "error")
    )


def _one_value(text: Column) -> Column:
    """Whether a text is one JSON value, of any kind, and nothing else."""
    return F.coalesce(F.size(C.parse_cells(F.concat(F.lit('{"x":'), text, F.lit("}")))) == 1, F.lit(False))


def split_valid(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good documents, and one outcome row per broken one.

    Both sides are plain filters on ``error``, so on parsed documents that were written
    once they reach the scan, and columns that are not used are not read. On documents
    that were not written, each side parses the texts again.
    """
    good = documents.where(F.col("error").isNull()).drop("error")
    return good, file_outcomes(documents.where(F.col("error").isNotNull()))


def file_outcomes(documents: DataFrame, log_entries: Column | None = None, *more: Column) -> DataFrame:
    """One row per input: what became of it, with ``more`` columns behind."""
    ok = F.col("error").isNull()
    entries = F.lit(0) if log_entries is None else F.coalesce(log_entries, F.lit(0))
    return documents.select(
        F.col("source_file").alias("input_file"),
        F.when(ok, F.concat("stem", F.lit(".json"))).alias("output_file"),
        F.when(ok, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        F.col("error"),
        F.when(ok, F.lit(1)).otherwise(F.lit(0)).alias("objects_processed"),
        F.when(ok, entries).otherwise(F.lit(0)).alias("log_entries"),
        *more,
    )


def table_to_documents(
    table: DataFrame,
    head: dict[str, Column],
    body: Sequence[tuple[str, Column] | tuple[str, Column, Column]],
) -> DataFrame:
    """Rows of a wide table as documents.

    ``body`` lists ``(field, value)`` or ``(field, value, present)`` in the
    order the cells get; the kind follows from the column type. A null value is
    JSON null, a false ``present`` leaves the field out.
    """
    types = dict(table.select(*[b[1].alias(b[0]) for b in body]).dtypes)

    def one(field: str, value: Column, present: Column | None = None) -> Column:
        kind, text = _column_value(types[field], value)
        kind = F.when(value.isNull(), F.lit("null")).otherwise(F.lit(kind))
        made = C.cell(F.lit(field), kind, text)
        return made if present is None else F.when(present, made)

    made = F.array_compact(F.array(*[one(*b) for b in body])).cast(C.CELLS)
    return table.select(*[v.alias(k) for k, v in head.items()], made.alias("metadata"))


def _column_value(sql_type: str, value: Column) -> tuple[str, Column]:
    if sql_type == "boolean":
        return "boolean", value.cast("string")
    if sql_type in ("tinyint", "smallint", "int", "bigint"):
        return "integer", value.cast("string")
    if sql_type in ("float", "double") or sql_type.startswith("decimal"):
        return "float", C.float_text(value.cast("double"))
    return "string", value.cast("string")


def document_json(documents: DataFrame) -> Column:
    """The output document as JSON text.

    Keys come in input order, then ``modified_metadata``, ``json_patch`` and
    ``processing_log``, each only if its column is there.
    """
    def member(name: str, text: Column) -> Column:
        return F.array(F.lit(f',"{name}":'), text)

    body = member("metadata", C.json_object(F.col("metadata")))
    if "head" in documents.columns:
        top = F.transform(F.col("head"), lambda c: C.json_member(c["field"], c))
        # The body goes in by position, so it is rendered once per document.
        at = F.array_position(C.names(F.col("head")), F.lit("metadata")).cast("int")
        placed = F.when(
            at > 0,
            F.concat(F.slice(top, F.lit(1), at - 1), F.array(body), F.slice(top, at + 1, F.size(top))),
        ).otherwise(top)
    else:
        known = [n for n in ("uuid", "record_id", *HEAD_FIELDS[1:]) if n in documents.columns]
        parts = [F.when(F.col(n).isNotNull(), member(n, C.json_string(F.col(n)))) for n in known]
        placed = F.array_compact(F.array(*parts, body))
    extra = []
    if "modified_metadata" in documents.columns:
        extra.append(member("modified_metadata", C.json_object(F.col("modified_metadata"))))
    if "json_patch" in documents.columns:
        extra.append(member("json_patch", patch_json(F.col("json_patch"))))
    if "processing_log" in documents.columns:
        extra.append(member("processing_log", log_json(F.col("processing_log"))))
    return C.enclosed(F.concat(placed, F.array(*extra)) if extra else placed, "{", "}")


def patch_json(patch: Column) -> Column:
    """Diff operations as a JSON array."""
    def one(p: Column) -> Column:
        start = F.array(
            F.lit(',{"op":"'), p["op"], F.lit('","path":"'), C.escaped(p["path"]), F.lit('"')
        )
        value = F.when(p["op"] == "remove", F.array().cast("array<string>")).otherwise(
            C.json_member(F.lit("value"), p)
        )
        return F.flatten(F.array(start, value, F.array(F.lit("}"))))

    # A removal prints as it is wanted.
    return C.printed_whole(
        patch, rf'("op":"(?!remove")[^"\\]*+","path":{C.QUOTED}),"kind":{C.KIND_AND_TEXT}', '$1,"value":$2$3$4', ',"kind":', "[]",
        C.enclosed(F.transform(patch, one), "[", "]"),
    )


def log_json(log: Column) -> Column:
    """The processing log as JSON text, its four parts in fixed order."""
    def rename(e: Column) -> Column:
        return F.array(F.lit(',"'), C.escaped(e["legacy"]), F.lit('":"'), C.escaped(e["target"]), F.lit('"'))

    def value(e: Column) -> Column:
        start = F.array(F.lit(',"'), C.escaped(e["field"]), F.lit('":{"'), C.escaped(e["old"]), F.lit('"'))
        # A member without its name: what follows is the colon and the value.
        pieces = C.json_member(F.lit(""), e)
        return F.flatten(F.array(start, F.slice(pieces, 4, 9), F.array(F.lit("}"))))

    def ambiguous(e: Column) -> Column:
        start = F.array(F.lit(',{"field":"'), C.escaped(e["field"]), F.lit('"'))
        options = F.array(F.lit(',"permissible_values":'), C.json_array(e["options"]), F.lit("}"))
        return F.flatten(F.array(start, C.json_member(F.lit("value"), e), options))

    renamed, mapped, several = log["field_mappings"], log["value_mappings"], log["ambiguous_mappings"]
    return F.concat(
        F.lit('{"field_mappings":'),
        C.printed_whole(
            renamed, rf'\{{"legacy":({C.QUOTED}),"target":({C.QUOTED})\}}', "$1:$2", '{"', "{}",
            C.enclosed(F.transform(renamed, rename), "{", "}"),
        ),
        F.lit(',"value_mappings":'),
        C.printed_whole(
            mapped, rf'\{{"field":({C.QUOTED}),"old":({C.QUOTED}),"kind":{C.KIND_AND_TEXT}\}}', "$1:{$2:$3$4$5}", '{"field":', "{}",
            C.enclosed(F.transform(mapped, value), "{", "}"),
        ),
        F.lit(',"ambiguous_mappings":'),
        F.when(F.size(several) == 0, F.lit("[]")).otherwise(C.enclosed(F.transform(several, ambiguous), "[", "]")),
        F.lit(',"excluded_data":'),
        C.json_object(log["excluded_data"]),
        F.lit("}"),
    )


def write_documents(documents: DataFrame, path: str, mode: str = "error") -> None:
    """Write output documents to a Parquet table under ``path``.

    One row per input, with its ``source_file`` and the ``document`` as JSON
    text. Files are laid out by ``dataset_type`` and ``group_name`` so that later reads
    prune. Rows are brought together by both, so that not every task writes a file for
    every group; adaptive execution splits a group that holds most documents.
    """
    group = F.coalesce("group_name", F.lit("Unknown Group")) if "group_name" in documents.columns else F.lit("Unknown Group")
    rows = documents.select(
        F.coalesce("dataset_type", F.lit("Unknown")).alias("dataset_type"),
        group.alias("group_name"),
        *(["source_file"] if "source_file" in documents.columns else []),
        document_json(documents).alias("document"),
    )
    layout = ["dataset_type", "group_name"]
    rows.hint("rebalance", *layout).write.mode(mode).partitionBy(*layout).parquet(path)


def write_document_lines(documents: DataFrame, path: str, mode: str = "error") -> None:
    """Write only the JSON texts, one document per line."""
    documents.select(document_json(documents).alias("value")).write.mode(mode).text(path)
