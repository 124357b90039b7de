"""Exact top-k search by inner product, with a uniform threshold in three phases.

The components of the vectors are cut into ``lists``; a list holds, for each query, the
partial score of every vector. Work is done on tiles: a task holds some blocks of queries and
takes a span of the vectors chunk by chunk, so neither side is ever whole in one task. Blocks
and chunks go to their tiles in one shuffle. Nothing is joined for it, so nothing can be
broadcast; a chunk is copied once for ``held`` blocks or less, a block once for a span.

1. Each list gives its best vectors for each query; their whole scores are resolved where the
   vectors lie, and the k-th best of them is a safe cutoff: the result is at least as good.
2. The cutoff goes to all tiles of the query. A vector that reaches it reaches an equal
   share of it in at least one list, so each list gives the vectors with at least that.
3. The whole scores of these vectors are resolved exactly in the same tile, and only the best
   that reach the cutoff leave it; the best of all tiles are kept.

Equal vectors are one candidate, with the smallest of their ids, so a third of all rows
may hold the same vector.

Defined cases: vectors that are null, or hold null, NaN or infinite components, take no
part, nor do rows without an id; a shorter vector counts as padded with zeros; an empty
vector is all zeros; rows of one id all count as candidates, but not for a query of that
id; a query id with several vectors is answered for the smallest one; scores beyond long
are set to its limits; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docalign.llm.common import Stash

LONG = 2**63 - 1


@dataclass(frozen=True)
class Blocks:
    queries: int = 1024
    vectors: int = 4096
    lists: int = 2
    #: Blocks of queries that a task holds at most.
    held: int = 64


def whole_components(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as long; null if a component is null or not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(rows: pa.ListArray, width: int) -> np.ndarray:
    """Rows of components, in the kind that they are stored in, padded with zeros."""
    lengths = pc.list_value_length(rows).to_numpy(zero_copy_only=False)
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(rows), width), dtype=flat.dtype)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of all rows; in floats where they are exact, else in whole numbers within the limits of long."""
    most = lambda m: float(np.abs(m.astype(np.float64)).max(initial=0))
    bound = most(queries) * most(vectors) * max(1, queries.shape[1])
    if bound < 2**53:
        kind = np.float32 if bound < 2**24 else np.float64
        return queries.astype(kind) @ vectors.astype(kind).T
    exact = queries.astype(object) @ vectors.astype(object).T
    return np.clip(exact, -LONG - 1, LONG).astype(np.int64) if exact.size else np.zeros(exact.shape)


def _pair_scores(qv: np.ndarray, cv: np.ndarray) -> np.ndarray:
    """Whole scores of pairs of rows, exactly; beyond long they are its limits."""
    if np.abs(cv).max(initial=0).astype(float) * np.abs(qv).max(initial=0).astype(float) * cv.shape[1] < 2**62:
        return np.einsum("ij,ij->i", cv, qv)
    exact = (cv.astype(object) * qv.astype(object)).sum(axis=1)
    return np.array([max(-LONG - 1, min(LONG, s)) for s in exact], dtype=np.int64)


def _blocks(frame: DataFrame, block: Column, *columns: str) -> DataFrame:
    """One row per block: its rows in order of ``key``, as arrays."""
    made = frame.groupBy(block.alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("key", *columns))).alias("rows")
    )
    return made.select("block", F.col("rows.key").alias("keys"), *[F.col(f"rows.{c}").alias(c) for c in columns])


def _packed(blocks: DataFrame, width: int) -> DataFrame:
    """The same blocks; their vectors as the bytes of one matrix, which no reader takes apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("v")
            for i in range(batch.num_rows):
                v = _matrix(batch.column(at)[i].values, width).tobytes()
                yield batch.slice(i, 1).set_column(at, "v", pa.array([v], pa.binary()))

    return blocks.mapInArrow(run, ", ".join(f"{n} {'binary' if n == 'v' else t}" for n, t in blocks.dtypes))


class Leaders:
    """The ``n`` best scores of each row, ties to the smaller key; ``floor``: what the n-th best so far has at least."""

    def __init__(self, floor: np.ndarray, n: int) -> None:
        self.floor, self.n = floor.copy(), n
        self.row = self.key = self.score = np.empty(0, dtype=np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, row: np.ndarray, key: np.ndarray, score: np.ndarray) -> None:
        self.new.append((row, key, score))
        if 4 * sum(len(x[0]) for x in self.new) >= self.n * len(self.floor):
            self.settle()

    def settle(self) -> None:
        """Take in what was added."""
        old = [(self.row, self.key, self.score)] if len(self.row) else []
        row, key, score = (np.concatenate(x) for x in zip(*old, *self.new, (self.row[:0],) * 3))
        self.new = []
        order = np.lexsort((~key, score, row))[::-1]
        row, key, score = row[order], key[order], score[order]
        place = np.arange(len(row))
        place -= np.maximum.accumulate(np.where(np.append(True, row[1:] != row[:-1])[: len(row)], place, 0))
        last, kept = place == self.n - 1, place < self.n
        self.floor[row[last]] = np.maximum(self.floor[row[last]], _not_above(score[last]))
        self.row, self.key, self.score = row[kept], key[kept], score[kept]


def _not_above(score: np.ndarray) -> np.ndarray:
    """Scores as floats; those that may have been rounded are lowered."""
    score = score.astype(np.float64)
    return np.where(np.abs(score) < 2.0**52, score, score - np.abs(score) * 1e-15)


def _bound(least: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The bound of each row for the whole numbers ``score``, in their own kind."""
    # A bound that this rounds is beyond all scores of the kind.
    return (np.ceil(least).astype(score.dtype) if score.dtype.kind == "f" else least)[:, None]


def _leading(score: np.ndarray, floor: np.ndarray, n: int) -> np.ndarray:
    """Where scores are above the floor of their row; where these are many, some of them, each row's ``n`` best among these."""
    found, n = score > _bound(floor, score), min(n, score.shape[1])
    most, pieces = 4 * n * len(score), 4 * n
    if np.count_nonzero(found) > most and score.shape[1] >= 2 * pieces:
        # n pieces of a row have a best score like this, so n scores at least reach it.
        tops = score[:, : score.shape[1] // pieces * pieces].reshape(len(score), -1, pieces).max(axis=1)
        found &= score >= np.partition(tops, -n, axis=1)[:, -n, None]
    if np.count_nonzero(found) > most:
        best = np.zeros_like(found)
        np.put_along_axis(best, np.argpartition(score, -n, axis=1)[:, -n:], True, axis=1)
        found &= best
    return found


def _places(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns that hold true."""
    return np.divmod(np.flatnonzero(found), max(1, found.shape[1]))


class Nominated:
    """Phase 1 in a tile: the best whole scores among those that the lists have as their best."""

    schema = "q long, scores array<long>"

    def __init__(self, keys: np.ndarray, v: np.ndarray, floor: np.ndarray, lists: int, n: int) -> None:
        self.keys, self.v, self.n = keys, v, n
        self.lists = [Leaders(floor, n) for _ in range(lists)]
        self.whole = Leaders(floor, n)

    def take(self, keys: np.ndarray, v: np.ndarray) -> None:
        found = np.zeros((len(self.v), len(v)), dtype=bool)
        for number, best in enumerate(self.lists):
            at = slice(number, None, len(self.lists))
            score = _products(self.v[:, at], v[:, at])
            own = _leading(score, best.floor, self.n)
            row, c = _places(own)
            best.add(row, keys[c], score[row, c].astype(np.float64))
            found |= own
        _resolve(self.whole, found, self.v, keys, v)

    def rows(self) -> pa.RecordBatch:
        """The best whole scores of each query; only their number and values matter."""
        self.whole.settle()
        order = np.argsort(self.whole.row, kind="stable")
        ends = np.cumsum(np.bincount(self.whole.row, minlength=len(self.keys)))
        scores = pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), self.whole.score[order])
        return pa.RecordBatch.from_arrays([pa.array(self.keys), scores], names=["q", "scores"])


class Sufficient:
    """Phases 2 and 3 in a tile: the best of the vectors that reach a share of the cutoff in one list, and all of it as a whole."""

    schema = "q long, c long, score long"

    def __init__(self, keys: np.ndarray, v: np.ndarray, floor: np.ndarray, lists: int, n: int) -> None:
        self.keys, self.v, self.lists = keys, v, lists
        self.whole = Leaders(floor, n)

    def take(self, keys: np.ndarray, v: np.ndarray) -> None:
        found = np.zeros((len(self.v), len(v)), dtype=bool)
        for number in range(self.lists):
            at = slice(number, None, self.lists)
            score = _products(self.v[:, at], v[:, at])
            found |= score >= _bound(self.whole.floor / self.lists, score)
        _resolve(self.whole, found, self.v, keys, v)

    def rows(self) -> pa.RecordBatch:
        best = self.whole
        best.settle()
        return pa.RecordBatch.from_arrays(
            [pa.array(self.keys[best.row]), pa.array(best.key), pa.array(best.score)], names=["q", "c", "score"]
        )


def _resolve(best: Leaders, found: np.ndarray, qv: np.ndarray, keys: np.ndarray, cv: np.ndarray) -> None:
    """Whole scores of the pairs found, in pieces; those that reach the floor are added."""
    row, c = _places(found)
    for at in range(0, len(row), 1 << 14):
        some_row, some_c = row[at : at + (1 << 14)], c[at : at + (1 << 14)]
        score = _pair_scores(qv[some_row].astype(np.int64), cv[some_c].astype(np.int64))
        kept = score >= best.floor[some_row]
        best.add(some_row[kept], keys[some_c[kept]], score[kept])


def _on_tiles(start: Callable, width: int, kind: type) -> Callable:
    """For mapInArrow: rows of tiles, each tile's blocks of queries before its chunks of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                if row["tile"].as_py() != tile:
                    yield from (block.rows() for block in held)
                    tile, held = row["tile"].as_py(), []
                keys, v = row["keys"].values.to_numpy(), np.frombuffer(row["v"].as_buffer(), kind).reshape(-1, width)
                if row["floors"].is_valid:
                    held.append(start(keys.copy(), v.copy(), row["floors"].values.to_numpy()))
                else:
                    for block in held:
                        block.take(keys, v)
        yield from (block.rows() for block in held)

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    scale: int = 64,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    blocks: Blocks = Blocks(),
) -> DataFrame:
    """Rows ``query_id, rank, vec_id, score``: the ``k`` best of each query, ties to the smaller id.

    ``is_query`` is a condition on the columns of ``vectors``.
    """
    spark = vectors.sparkSession
    stash = Stash(spark, "topk")
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"), whole_components(F.col(vector), scale).alias("v"), is_query.alias("q")
    ).where("id is not null and v is not null")
    # Trailing zeros change no score: without them, equal vectors are equal arrays.
    rows = stash.save(rows, "rows")
    size, least, most = rows.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    width = max(1, size or 0)
    kind = next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= (least or 0) and (most or 0) <= np.iinfo(t).max)
    rows = rows.withColumn("v", F.col("v").cast({2: "array<short>", 4: "array<int>", 8: "array<long>"}[np.dtype(kind).itemsize]))

    # Of equal vectors only the k+1 smallest ids can be in a result (one may be the query's own).
    first = rows.withColumn("n", F.row_number().over(W.partitionBy("v").orderBy("id"))).where(F.col("n") <= k + 1)
    classes = first.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = stash.save(classes.select(F.get("ids", F.lit(0)).alias("key"), "v", "ids"), "classes")
    queries = stash.save(rows.where("q").groupBy(F.col("id").alias("key")).agg(F.min("v").alias("v")), "queries")

    def number(frame: DataFrame, most: int) -> tuple[Column, int]:
        n = max(1, -(-frame.count() // most))
        return F.pmod(F.xxhash64("key"), F.lit(n)).cast("int"), n

    chunk, n_chunks = number(classes, blocks.vectors)
    group, n_groups = number(queries, blocks.queries)
    chunks = stash.save(_packed(_blocks(classes, chunk, "v"), width), "chunks")

    # Some tasks a core. Each chunk is copied for every band of query blocks and each block for every span of
    # chunks, so bands and spans are in proportion to the rows of the two sides.
    tasks = 4 * spark.sparkContext.defaultParallelism
    bands = round((tasks * n_groups * blocks.queries / (n_chunks * blocks.vectors)) ** 0.5)
    held = min(blocks.held, -(-n_groups // max(1, bands)))
    bands = -(-n_groups // held)
    spans = min(n_chunks, -(-tasks // bands))

    def on_tiles(groups: DataFrame, phase: type) -> DataFrame:
        """What a phase gives of every block of queries by every chunk of vectors."""
        span, band = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (spans, bands))
        left = _packed(groups, width).withColumn("span", span).withColumn("band", F.floor(F.col("block") / held))
        right = chunks.withColumn("band", band).withColumn("span", F.col("block") % spans)
        both = left.unionByName(right.withColumn("floors", F.lit(None).cast("array<double>")))
        tile = (F.col("band") * spans + F.col("span")).cast("int")
        dealt = both.select(tile.alias("tile"), "keys", "v", "floors").repartitionById(bands * spans, "tile")
        dealt = dealt.sortWithinPartitions("tile", F.col("floors").isNull())
        lists, n = blocks.lists, k + 1
        start = lambda keys, v, floor: phase(keys, v, floor, lists, n)
        return dealt.mapInArrow(_on_tiles(start, width, kind), phase.schema)

    # Phase 1: the best of each list, and the cutoff from the whole scores of all tiles.
    floor = F.lit(float("-inf"))
    nominated = on_tiles(_blocks(queries.withColumn("floors", floor), group, "v", "floors"), Nominated)
    best = F.sort_array(F.flatten(F.collect_list("scores")), asc=False)
    cutoff = nominated.groupBy(F.col("q").alias("key")).agg(F.get(best, F.lit(k)).alias("cutoff"))
    cutoff = stash.save(cutoff, "cutoffs")

    # Phases 2 and 3: each tile gives the best of what reaches its share of the cutoff in a list, and the
    # cutoff as a whole. Too few vectors: all are taken.
    bound = F.col("cutoff").cast("double")
    bound = F.when(F.abs(bound) < 2.0**52, bound).otherwise(bound - F.abs(bound) * 1e-15)
    cut = queries.join(cutoff.hint("merge"), "key", "left").withColumn("floors", F.coalesce(bound, floor))
    scores = stash.save(on_tiles(_blocks(cut, group, "v", "floors"), Sufficient), "sufficient")
    top = scores.withColumn("n", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "c")))
    top = top.where(F.col("n") <= k + 1)
    candidates = top.join(classes.select(F.col("key").alias("c"), "ids").hint("merge"), "c").select(
        F.col("q").alias("query_id"), F.explode("ids").alias("vec_id"), "score"
    )
    final = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        candidates.where(F.col("query_id") != F.col("vec_id"))
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
