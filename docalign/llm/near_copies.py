"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from SimHash fingerprints first (``simhash.fingerprint_pairs``). They do not
find all: at a similarity of 0.8 two fingerprints are some ten bits of 64 apart, with a
deviation of three, and eight positional bytes then share none. What fingerprints leave
apart comes from MinHash bands. Every candidate is verified on the sets.

1. Equal sets are one node, so a large group of copies is one node.
2. Pairs of nodes whose fingerprints are linked are verified.
3. A list holds the nodes that agree in the ``IN_BAND`` minima of one of ``BANDS`` bands.
   Two nodes of similarity s miss all lists with a probability of about (1 - s^8)^64: 8e-6
   at 0.8, 2e-9 at 0.85. Lists that fingerprints have made one component are done.
4. Each member of the others is verified against two members of its list; where the list is
   not one component after that, also against the ``PIVOTS`` members with most links. What
   lists still leave apart is compared whole, block by block, so no candidate goes unverified
   but those already linked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docalign.llm.common import Stash, as_bytes
from docalign.llm.components import components

SEED = 42
WIDTH = 5
#: Similarity from which two documents are near copies, as a fraction of whole numbers.
LEAST = (4, 5)
MINIMA, IN_BAND, BANDS = 160, 8, 64
PIVOTS = 3
#: Nodes of a block, and bytes of their sets.
BLOCK_NODES, BLOCK_BYTES = 256, 8 << 20

_random = np.random.default_rng(SEED)
_TIMES, _PLUS = (_random.integers(0, 2**64, MINIMA, dtype=np.uint64) | np.uint64(1) for _ in range(2))
_MEMBERS = np.array([_random.choice(MINIMA, IN_BAND, replace=False) for _ in range(BANDS)])
_MIX = _random.integers(0, 2**64, (BANDS, IN_BAND), dtype=np.uint64) | np.uint64(1)


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle, one without words has none."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    n = max(1, len(words) - width + 1)
    hashed = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((hashed(b" ".join(words[i : i + width]), SEED) for i in range(n)), np.uint64, n))


def bands(found: np.ndarray) -> np.ndarray:
    """Keys of the lists that a set stands in."""
    least = np.full(MINIMA, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(found), 4096):
        least = np.minimum(least, (found[at : at + 4096, None] * _TIMES + _PLUS).min(axis=0))
    return (least[_MEMBERS] * _MIX).sum(axis=1, dtype=np.uint64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return LEAST[1] * both >= LEAST[0] * (len(a) + len(b) - both)


def shingle_sets(documents: DataFrame, keep: tuple[str, ...], fingerprint: Callable[[bytes], int]) -> DataFrame:
    """For each row its ``keep`` columns, ``fp``, a hash of the set, ``bits``, the text's fingerprint, and ``keys``, its lists."""
    needed = documents.select(*keep, "text")
    made = [("fp", T.LongType()), ("bits", T.LongType()), ("keys", T.ArrayType(T.LongType()))]
    schema = T.StructType([needed.schema[c] for c in keep] + [T.StructField(*m) for m in made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            fps, bits, keys = [], [], []
            for text in as_bytes(batch.column(len(keep))):
                found = shingles(text)
                fps.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
                bits.append(fingerprint(text))
                keys.append(bands(found).view(np.int64) if len(found) else np.empty(0, np.int64))
            columns = [batch.column(i) for i in range(len(keep))]
            made = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (fps, bits)]
            made.append(pa.array(keys, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*columns, *made], names=[*keep, "fp", "bits", "keys"])

    return needed.mapInArrow(run, schema)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    read = lru_cache(maxsize=256)(shingles)
    for batch in batches:
        texts = zip(as_bytes(batch.column(2)), as_bytes(batch.column(3)), strict=True)
        near = pa.array([similar(read(a), read(b)) for a, b in texts], pa.bool_())
        yield batch.select([0, 1]).filter(near)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs(u, v)`` whose texts are near copies; ``texts(fp, text)`` has one text of each node."""
    of_u = texts.select(F.col("fp").alias("u"), F.col("text").alias("a"))
    of_v = texts.select(F.col("fp").alias("v"), F.col("text").alias("b"))
    both = pairs.join(of_u, "u").join(of_v, "v").select("u", "v", "a", "b")
    return both.mapInArrow(_verify, "u long, v long")


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def near_links(rows: DataFrame, documents: DataFrame, pairs: DataFrame, stash: Stash) -> DataFrame:
    """Edges ``u, v`` that connect all near copies among the nodes of ``rows(row, fp, keys)``;
    ``documents(row, text)`` has their texts. ``pairs(u, v)`` are candidates that come first."""
    listed = rows.select("fp", F.explode("keys").alias("key"))
    # Copies of one set stand in a list once: a list counts if its smallest and largest node differ.
    lists = listed.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high").select("key")
    listed = stash.save(listed.join(lists, "key").distinct(), "lists")
    pairs = stash.save(pairs, "pairs")
    needed = listed.select("fp").unionByName(pairs.select(F.explode(F.array("u", "v")).alias("fp"))).distinct()
    own = rows.join(needed, "fp", "left_semi").groupBy("fp").agg(F.min("row").alias("row"))
    texts = stash.save(documents.join(own, "row").dropDuplicates(["fp"]).select("fp", "text"), "texts")
    linked = stash.save(verified(pairs, texts), "edges")
    listed = stash.save(_apart(listed, linked, stash).select("key", "fp"), "lists")

    # The order differs from list to list, so a node meets others in each.
    order = F.xxhash64("fp", "key")
    chosen = listed.groupBy("key").agg(F.array(F.min_by("fp", order), F.max_by("fp", order)).alias("chosen"))
    first = listed.join(chosen, "key").select("fp", F.explode("chosen").alias("other")).where("fp <> other")
    first = first.select(*_ordered("fp", "other")).distinct().join(pairs, ["u", "v"], "left_anti")
    first = stash.save(first, "first")
    edges = linked.unionByName(stash.save(verified(first, texts), "edges"))

    # A text that copies were made from is near to more of them than they are to each other: members
    # of lists that are still apart meet the nodes of their list with most links so far.
    rest = _apart(listed, edges, stash)
    ends = edges.select(F.col("u").alias("fp")).unionByName(edges.select(F.col("v").alias("fp")))
    counted = rest.join(ends.groupBy("fp").agg(F.count("*").alias("links")), "fp")
    most = F.slice(F.sort_array(F.collect_set(F.struct("links", "fp", "root")), asc=False), 1, PIVOTS)
    # Two steps, so that a long list is not one task's memory.
    part = F.pmod(F.xxhash64("fp"), F.lit(16))
    pivots = counted.groupBy("key", part.alias("part")).agg(most.alias("some"))
    best = F.slice(F.sort_array(F.flatten(F.collect_list("some")), asc=False), 1, PIVOTS)
    pivots = pivots.groupBy("key").agg(best.alias("best")).select("key", F.explode("best").alias("p"))
    second = rest.join(pivots, "key").where("p.root <> root").select(*_ordered("fp", "p.fp")).distinct()
    second = second.join(first.unionByName(pairs), ["u", "v"], "left_anti")
    second = stash.save(second, "second")
    edges = edges.unionByName(stash.save(verified(second, texts), "edges"))

    return edges.unionByName(stash.save(_all_in_blocks(_apart(listed, edges, stash), texts, stash), "edges"))


def _all_in_blocks(rest: DataFrame, texts: DataFrame, stash: Stash) -> DataFrame:
    """Links between different components of the lists in ``rest(key, fp, root)``, exactly.

    Nodes that lists connect are a cluster. A cluster is cut into blocks of bounded size, and a
    task compares two blocks by an inverted index of their shingles. No pair is a row but a
    link, and of a node's links to one component only one.
    """
    rest = stash.save(rest, "rest")
    lists = rest.groupBy("key").agg(F.min("fp").alias("u"))
    spokes = rest.join(lists, "key").select("u", F.col("fp").alias("v")).where("u <> v").distinct()
    clusters = components(stash.save(spokes, "spokes"), stash).select(F.col("node").alias("fp"), F.col("root").alias("cluster"))
    nodes = rest.select("fp", "root").distinct().join(clusters, "fp").join(texts, "fp").mapInArrow(
        _with_sets, "fp long, root long, cluster long, found binary"
    )
    nodes = stash.save(nodes, "sets")
    many = F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum(F.octet_length("found")) / BLOCK_BYTES))
    sizes = nodes.groupBy("cluster").agg(many.alias("blocks"))
    dealt = nodes.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("fp", F.lit("block")), F.col("blocks")))
    block = dealt.groupBy("cluster", "block").agg(
        F.any_value("blocks").alias("blocks"), F.collect_list(F.struct("fp", "root", "found")).alias("nodes")
    )
    block = stash.save(block, "blocks")
    left = block.select("cluster", F.col("nodes").alias("a"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("block"))
    both = left.join(block.select("cluster", "block", F.col("nodes").alias("b")), ["cluster", "block"]).select("a", "b")
    return both.mapInArrow(_compare_blocks, "u long, v long").distinct()


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array([shingles(t).tobytes() for t in as_bytes(batch.column(3))], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], names=["fp", "root", "cluster", "found"])


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            a, b = (batch.column(i)[at].as_py() for i in (0, 1))
            links = list(block_links(a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["u", "v"])


def block_links(a: list[dict], b: list[dict]) -> Iterator[tuple[int, int]]:
    """For each node of ``a`` one link to each other component in ``b`` that has a near copy of it."""
    sets = [np.frombuffer(n["found"], dtype=np.uint64) for n in b]
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(b)), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    for node in a:
        own = np.frombuffer(node["found"], dtype=np.uint64)
        low, high = np.searchsorted(flat, own, side="left"), np.searchsorted(flat, own, side="right")
        many = high - low
        at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        shared = np.bincount(owner[at], minlength=len(b))
        reached = {node["root"]}
        for k in np.flatnonzero(LEAST[1] * shared >= LEAST[0] * (len(own) + size - shared)):
            if b[k]["root"] not in reached:
                reached.add(b[k]["root"])
                yield min(node["fp"], b[k]["fp"]), max(node["fp"], b[k]["fp"])


def _apart(listed: DataFrame, edges: DataFrame, stash: Stash) -> DataFrame:
    """``key, fp, root`` of the lists whose members are not one component yet."""
    grouped = components(edges, stash)
    rooted = listed.join(grouped.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = stash.save(rooted.select("key", "fp", F.coalesce("root", "fp").alias("root")), "rooted")
    apart = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    return rooted.join(apart, "key")
