"""Non-standard values as JSON: per profile one object, a scalar or a sorted array per field.

A field may have more values than one task can hold, so a document is never put together in
one place. It is a sequence of fragments, one per value, in the order of profile, field and
value: each carries its value and the marks before and behind it. Which marks those are
depends on the neighbours alone. Values are sorted by range; inside a part the neighbours are
at hand, and across parts they come from a prefix scan over one row per part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.sources.runs import ReadRun, Run, written_run


def write_value_lists(values: DataFrame, path: str, name: str | None = None) -> ReadRun:
    """Write the documents as a run under ``path`` and open it.

    ``values`` are rows of ``nonstandard_values``: ``field``, ``value`` and perhaps ``profile``;
    equal rows count once, rows without a field or value are left out, further columns too.
    Table ``fragments`` has ``profile`` (null if there is none), ``ordinal`` (from 1 within a
    profile), ``field``, ``value`` and the fragment's ``text``: the texts of a profile in the order
    of ``ordinal`` are its JSON document. No values give no documents.

    A run counts once its manifest is written, see ``sources.runs``. ``path`` must be on
    storage that all executors share.
    """
    profile = F.col("profile") if "profile" in values.columns else F.lit(None).cast("string")
    rows = values.select(profile.alias("profile"), "field", "value").where("field IS NOT NULL AND value IS NOT NULL").distinct()

    def steps(run: Run) -> None:
        ranged = rows.repartitionByRange("profile", "field", "value").withColumn("part", F.spark_partition_id())
        # Numbers of parts must not change any more: ranges are sampled anew in each job.
        run.add("fragments", fragments(run.add("values", ranged)), sort=("profile", "ordinal"))

    return written_run(values.sparkSession, path, steps, name)


def fragments(placed: DataFrame) -> DataFrame:
    """``profile, ordinal, field, value, text`` of distinct values in numbered ranges.

    ``placed`` has ``profile``, ``field``, ``value`` and ``part``; every row of a part comes before
    every row of the next one. A task holds one part, whatever the sizes of the fields.
    """
    key = F.struct("profile", "field", "value")
    # One row per part: its ends, and how many rows of its last profile it holds.
    sizes = placed.groupBy("part", "profile").agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
    ends = sizes.groupBy("part").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.max(F.struct("profile", "n")).alias("tail")
    )
    scan = Window.orderBy("part")
    # Rows of the part's first profile in all earlier parts: those that end with that profile.
    before = Window.partitionBy("low.profile").orderBy("part")
    tails = ends.select(F.col("tail.profile").alias("profile"), F.col("tail.n").alias("n"), F.col("part").alias("at"))
    outer = ends.select("part", F.lag("high").over(scan).alias("left"), F.lead("low").over(scan).alias("right"), F.col("low.profile").alias("first"))
    earlier = (
        outer.join(tails, F.col("profile").eqNullSafe(F.col("first")) & (F.col("at") < F.col("part")), "left")
        .groupBy("part", "left", "right", "first")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("earlier"))
    )
    del before
    inside = Window.partitionBy("part").orderBy("profile", "field", "value")
    own = Window.partitionBy("part", "profile").orderBy("field", "value")
    near = placed.select(
        "*",
        F.lag(key).over(inside).alias("prev"),
        F.lead(key).over(inside).alias("next"),
        F.row_number().over(own).cast("bigint").alias("within"),
    ).join(earlier, "part")
    near = near.withColumn("prev", F.coalesce("prev", "left")).withColumn("next", F.coalesce("next", "right"))
    shift = F.when(F.col("profile").eqNullSafe(F.col("first")), F.col("earlier")).otherwise(F.lit(0))
    return near.select("profile", (F.col("within") + shift).alias("ordinal"), "field", "value", _text(F.col("prev"), F.col("next")).alias("text"))


def _text(prev: Column, next_: Column) -> Column:
    """A value with the marks that its neighbours call for."""

    def same(other: Column, *names: str) -> Column:
        equal = other.isNotNull()
        for name in names:
            equal = equal & other[name].eqNullSafe(F.col(name))
        return equal

    starts, ends = ~same(prev, "profile", "field"), ~same(next_, "profile", "field")
    none = F.lit("")
    return F.concat(
        F.when(~same(prev, "profile"), F.lit("{")).otherwise(F.lit(",")),
        F.when(starts, F.concat(C.json_string(F.col("field")), F.lit(":"))).otherwise(none),
        F.when(starts & ~ends, F.lit("[")).otherwise(none),
        C.json_string(F.col("value")),
        F.when(ends & ~starts, F.lit("]")).otherwise(none),
        F.when(~same(next_, "profile"), F.lit("}")).otherwise(none),
    )


def write_value_list_files(run: ReadRun, path: str, mode: str = "error") -> None:
    """Write the fragments of a run as text, a folder per profile.

    The files of a folder, in the order of their names, are one JSON document: what stands
    between two fragments is a line end. A profile with most values is several files.
    """
    rows = run.table("fragments").repartitionByRange("profile", "ordinal").sortWithinPartitions("profile", "ordinal")
    rows.select("profile", F.col("text").alias("value")).write.mode(mode).partitionBy("profile").text(path)


def value_list_documents(run: ReadRun) -> DataFrame:
    """``profile, document``: the whole texts, where each fits in a row.

    A convenience for profiles of moderate size; a large one is read as fragments or files.
    """
    pieces = F.sort_array(F.collect_list(F.struct("ordinal", "text")))
    joined = F.array_join(F.transform(pieces, lambda p: p["text"]), "")
    return run.table("fragments").groupBy("profile").agg(joined.alias("document"))


def read_value_lists(spark: SparkSession, path: str) -> DataFrame:
    """The fragments of the newest whole run under ``path``."""
    return ReadRun(spark, path).table("fragments")
