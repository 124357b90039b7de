"""Mixing sources to target weights along a curriculum.

Each source has a weight at some points in time, linear between them. The integral of
the weight over the whole time says what share of the words the source gets; the integral
up to ``t``, scaled to the source's target, is the demand for its words up to ``t``. The
documents of a source stand in a fixed random order, and the words before a document are
looked up in the inverse of that demand: this is the document's position in training.
The mix is the documents sorted by range of position.

Nothing is gathered by source: a source is cut into buckets by hash, the sums of the
buckets are added up in order, and only then are documents ordered inside a bucket.

Defined cases: a null text has size 0 and is never in the way; a null source is a source
of its own, last in order; null or repeated ids and repeated rows are allowed (equal rows
share the hash and stand next to each other); extra columns are ignored or carried; an
empty table, or one without words, gives targets of 0.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Documents in a bucket of a source, about.
BUCKET_ROWS = 256


@dataclass(frozen=True)
class Curriculum:
    """Weights at points in time from 0 to 1.

    Each entry of ``weights`` is a sequence, dealt to the sources in code-point order and
    repeating, or a mapping from source to weight (0 if absent). ``amount`` is the number
    of words of the mix as a share of all words; ``max_repeats`` says how often a
    document may be taken.
    """

    times: Sequence[float] = (0.0, 1.0)
    weights: Sequence[Sequence[float] | Mapping[str, float]] = ((5, 2, 1), (5, 2, 1))
    amount: float = 1.0
    max_repeats: int = 3

    def __post_init__(self) -> None:
        if len(self.times) != len(self.weights) or list(self.times) != sorted(set(self.times)):
            raise ValueError("one weight for each time; times must increase")
        if self.times[0] != 0 or self.times[-1] != 1 or self.amount > self.max_repeats:
            raise ValueError("times run from 0 to 1, and the amount can't exceed max_repeats")

    def weight(self, k: int, source: Column, rank: Column) -> Column:
        given = self.weights[k]
        if isinstance(given, Mapping):
            names = F.create_map(*[F.lit(x) for kv in given.items() for x in (f"s{kv[0]}", float(kv[1]))])
            return F.coalesce(F.try_element_at(names, source), F.lit(0.0))
        return F.element_at(F.lit([float(w) for w in given]), (rank % len(given) + 1).cast("int"))


def word_count(text: Column) -> Column:
    """Number of runs of characters that are no white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _sized(documents: DataFrame, digits: int, carried: Column) -> DataFrame:
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    # 's' before each source and 't' for null: code-point order with null last, and no null keys.
    return documents.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("t")).alias("source_key"),
        key.alias("key"),
        F.substring(key, 1, digits).alias("bucket"),
        F.xxhash64("text").alias("tie"),
        word_count(F.col("text")).alias("size"),
        carried.alias("own"),
    )


def source_targets(buckets: DataFrame, curriculum: Curriculum) -> DataFrame:
    """Rows ``source_key, source_size, target, times, weights, areas``; one per source.

    Sources are capped in order of cap by weight: a source is capped if its share of what
    the sources before it leave exceeds its cap. The rest shares what is left by weight.
    """
    sources = buckets.groupBy("source_key").agg(F.sum("bucket_size").alias("source_size"))
    sources = sources.withColumn("rank", F.row_number().over(W.orderBy("source_key")) - 1)
    times = [float(t) for t in curriculum.times]
    weights = F.array(*[curriculum.weight(k, F.col("source_key"), F.col("rank")) for k in range(len(times))])
    sources = sources.withColumn("weights", weights)
    area, areas = F.lit(0.0), [F.lit(0.0)]
    for k in range(1, len(times)):
        mean = (F.get("weights", F.lit(k - 1)) + F.get("weights", F.lit(k))) / 2
        area = area + mean * (times[k] - times[k - 1])
        areas.append(area)
    sources = sources.withColumn("areas", F.array(*areas)).withColumn("weight", F.element_at("areas", -1))
    sources = sources.withColumn("cap", F.col("source_size") * curriculum.max_repeats)
    order = W.orderBy(F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).asc_nulls_last(), "source_key")
    before, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    every = W.partitionBy()
    total = F.sum("source_size").over(every) * F.lit(float(curriculum.amount))
    free = total - F.coalesce(F.sum("cap").over(before), F.lit(0))
    sources = sources.withColumns({"total": total, "free": free, "rest": F.sum("weight").over(rest)})
    capped = F.col("free") * F.col("weight") >= F.col("cap") * F.col("rest")
    sources = sources.withColumn("capped", (F.col("weight") > 0) & capped)
    # Once a source is not capped, none after it is.
    sources = sources.withColumn("capped", F.min("capped").over(order.rowsBetween(W.unboundedPreceding, 0)))
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0))
    sharing = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.coalesce(F.try_divide(left * F.col("weight"), sharing), F.lit(0.0))
    )
    return sources.select("source_key", "source_size", target.alias("target"), "weights", "areas")


def position(demand: Column, curriculum: Curriculum) -> Column:
    """Time up to which a source's demand reaches ``demand`` words."""
    times = F.lit([float(t) for t in curriculum.times])
    need = demand / F.col("target") * F.element_at("areas", -1)
    k = F.least(F.size(F.filter("areas", lambda a: a <= need)), F.lit(len(curriculum.times) - 1)) - 1
    k = F.greatest(k, F.lit(0))
    left, right = F.get("weights", k), F.get("weights", k + 1)
    span = F.get(times, k + 1) - F.get(times, k)
    more = need - F.get("areas", k)
    # The weight is linear here: left * x + (right - left) / (2 span) * x^2 = more.
    root = F.sqrt(F.greatest(left * left + 2 * (right - left) / span * more, F.lit(0.0)))
    return F.get(times, k) + F.coalesce(F.try_divide(2 * more, left + root), F.lit(0.0))


def placed(documents: DataFrame, curriculum: Curriculum, carried: Column) -> DataFrame:
    """Each row with ``own`` (what is carried), its sizes and ``offset``, the words before it in its source."""
    digits = max(1, math.ceil(math.log(max(1, documents.count()) / BUCKET_ROWS, 16)))
    buckets = (
        _sized(documents, digits, F.lit(None))
        .groupBy("source_key", "bucket")
        .agg(F.sum("size").alias("bucket_size"))
    )
    sources = source_targets(buckets, curriculum)
    up_to = W.partitionBy("source_key").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = buckets.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(up_to), F.lit(0)))
    starts = starts.drop("bucket_size").join(sources, "source_key")
    inside = W.partitionBy("source_key", "bucket").orderBy("key", "size", "tie")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return (
        _sized(documents, digits, carried)
        .join(starts, ["source_key", "bucket"])
        .withColumn("offset", F.col("bucket_start") + before)
        .drop("bucket_start", "key", "tie", "bucket")
    )


def _middles(curriculum: Curriculum) -> list[Column]:
    """Words of a source's repeated order before the middle of each repeat of a document."""
    return [F.col("offset") + j * F.col("source_size") + F.col("size") / 2 for j in range(curriculum.max_repeats)]


def mix_counts(documents: DataFrame, curriculum: Curriculum = Curriculum()) -> DataFrame:
    """For each row ``doc_id, size, source_size, target, taken, repeats, first_position``.

    A repeat is in the mix if its middle lies before the source's target, so the words
    taken differ from the target by half a document at most.
    """
    middles = _middles(curriculum)
    repeats = sum((F.when(m < F.col("target"), 1).otherwise(0) for m in middles), F.lit(0))
    return (
        placed(documents, curriculum, F.col("doc_id"))
        .withColumn("repeats", repeats)
        .select(
            F.col("own").alias("doc_id"), "size", "source_size", "target",
            (F.col("size") * F.col("repeats")).cast("long").alias("taken"),
            F.col("repeats").cast("int").alias("repeats"),
            F.when(F.col("repeats") > 0, F.round(position(middles[0], curriculum), 9)).alias("first_position"),
        )
    )


def mix_documents(documents: DataFrame, curriculum: Curriculum = Curriculum()) -> DataFrame:
    """The documents of the mix with their own columns, repeats included, in training order."""
    columns = documents.columns
    names = [f"c{i}" for i in range(len(columns))]
    own = F.struct(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)])
    at = F.filter(
        F.array(*[F.when(m < F.col("target"), position(m, curriculum)) for m in _middles(curriculum)]),
        lambda p: p.isNotNull(),
    )
    taken = placed(documents, curriculum, own).select("own", F.explode(at).alias("at"))
    return taken.orderBy("at", "own.c0").select(
        *[F.col(f"own.{n}").alias(c) for c, n in zip(columns, names, strict=True)]
    )
