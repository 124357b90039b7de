"""SimHash near-duplicates by an inverted index of positional bytes.

A fingerprint is eight bytes. Two fingerprints that differ in two bits share at least six
bytes at their positions. The index therefore lists fingerprints under sets of four
positional bytes, such that any two that share six bytes meet under one set at least:
the positions form four pairs, and each set joins two of these. Pairs that meet are
tallied by shared positional bytes; those with six or more are verified bit by bit.

A list that is too long for pairs is split by two more positional bytes. What shares six
given bytes differs in two bytes only, so such a list has at most 65,536 members, and its
links are found by lookup of all changes of up to two bits, in time linear in the list.

Equal fingerprints are one node. Nothing is gathered by group beyond that bound.

Defined cases: a text without words (or null) has fingerprint zero and is linked like any
other; with one or two words the whole sequence is the one shingle; a null ``doc_id`` is
never a component's id unless all of its ids are null; repeated rows and extra columns
are allowed; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docalign.llm.common import Stash, as_bytes, row_key
from docalign.llm.components import components
from docalign.llm.near_copies import near_links, shingle_sets

#: Seed of the shingle hash.
SEED = 42
#: Members of a list up to which its pairs are compared.
SHORT_LIST = 256
PAIRS = [(0, 1), (2, 3), (4, 5), (6, 7)]
#: Positions under which fingerprints are listed: two of the four pairs.
LISTED = [a + b for a, b in combinations(PAIRS, 2)]
#: All changes of one or two bits in 16.
CHANGES = np.array(
    [1 << i for i in range(16)] + [(1 << i) | (1 << j) for i, j in combinations(range(16), 2)], dtype=np.uint16
)


def fingerprint(text: bytes, width: int = 3) -> int:
    """64 bits, each 1 if more than half of the shingles' hashes have it."""
    import xxhash

    # lower() and split() of bytes touch A-Z and the six white-space characters only.
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    begins = np.concatenate([[0], ends[:-1]])
    n = max(1, len(words) - width + 1)
    last = ends[width - 1 :] if len(words) >= width else ends[-1:]
    hashed = xxhash.xxh64_intdigest
    spans = zip(begins[:n].tolist(), (last - 1).tolist(), strict=True)
    hashes = np.fromiter((hashed(joined[a:b], SEED) for a, b in spans), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 15):
        bits = np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(documents: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """For each row its ``keep`` columns and ``fp``, the fingerprint as a signed long."""
    needed = documents.select(*keep, text)
    schema = T.StructType([needed.schema[c] for c in keep] + [T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t) for t in as_bytes(batch.column(len(keep)))], dtype=np.uint64)
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(made.view(np.int64))], names=[*keep, "fp"])

    return needed.mapInArrow(run, schema)


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(255)


def _bytes_key(fp: Column, positions: tuple[int, ...]) -> Column:
    """The bytes at some positions, all others zero."""
    mask = sum(0xFF << (8 * p) for p in positions)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def index(nodes: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    """Rows ``no, key, fp``: each fingerprint under each set of positional bytes."""
    keys = F.array(*[
        F.struct(F.lit(i).alias("no"), _bytes_key(F.col("fp"), p).alias("key")) for i, p in enumerate(sets)
    ])
    return nodes.select(F.inline(keys), "fp")


def _link_list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside lists whose members differ in two bytes only: for each member, the
    smallest one at one or two bits' distance, and the smallest neighbor of larger ones."""
    for batch in batches:
        for i in range(batch.num_rows):
            fps = np.sort(batch.column("fps")[i].values.to_numpy().view(np.uint64))
            low, high = batch.column("low")[i].as_py(), batch.column("high")[i].as_py()
            byte = lambda p: ((fps >> np.uint64(8 * p)) & np.uint64(255)).astype(np.uint16)
            short = byte(low) | (byte(high) << np.uint16(8))
            place = np.full(1 << 16, -1, dtype=np.int64)
            place[short] = np.arange(len(fps))
            us, vs = [], []
            for change in CHANGES:
                other = place[short ^ change]
                found = np.nonzero(other > np.arange(len(fps)))[0]
                us.append(fps[found])
                vs.append(fps[other[found]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], names=["u", "v"]
            )


def links(nodes: DataFrame, stash: Stash) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints ``fp`` that differ in two bits or fewer; none is lost."""
    listed = stash.save(index(nodes, LISTED), "index")
    sizes = listed.groupBy("no", "key").agg(F.count("*").alias("n")).where("n > 1")
    short = sizes.where(F.col("n") <= SHORT_LIST).select("no", "key")
    long = sizes.where(F.col("n") > SHORT_LIST).select("no", "key")
    few = listed.join(short, ["no", "key"])
    a, b = few.select("no", "key", F.col("fp").alias("u")), few.select("no", "key", F.col("fp").alias("v"))
    u, v = F.col("u"), F.col("v")
    tally = sum((F.when(_byte(u, p) == _byte(v, p), 1).otherwise(0) for p in range(8)), F.lit(0))
    near = (u < v) & (tally >= 6) & (F.bit_count(u.bitwiseXOR(v)) <= 2)
    pairs = a.join(b, (a["no"] == b["no"]) & (a["key"] == b["key"]) & near).select("u", "v")

    more = [
        F.struct(
            F.lit(i).alias("of"), F.lit(low).alias("low"), F.lit(high).alias("high"),
            _bytes_key(F.col("fp"), tuple(p for p in range(8) if p not in (low, high))).alias("key6"),
        )
        for i, positions in enumerate(LISTED)
        for low, high in combinations([p for p in range(8) if p not in positions], 2)
    ]
    split = listed.join(long, ["no", "key"]).select("fp", "no", F.inline(F.array(*more)))
    split = split.where(F.col("no") == F.col("of")).groupBy("low", "high", "key6").agg(F.collect_set("fp").alias("fps"))
    dense = split.where(F.size("fps") > 1).select("low", "high", "fps").mapInArrow(_link_list, "u long, v long")
    return pairs.unionByName(dense)


def simhash_components(rows: DataFrame, stash: Stash, linked: DataFrame | None = None) -> DataFrame:
    """Rows ``fp, component_id`` of all fingerprints; the smallest ``doc_id`` that links reach.

    ``linked`` are other edges between the nodes than those of the fingerprints."""
    classes = stash.save(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    grouped = components(links(classes.select("fp"), stash) if linked is None else linked, stash)
    of_root = (
        grouped.join(classes, grouped["node"] == classes["fp"])
        .groupBy("root").agg(F.min("least_id").alias("reached"))
    )
    reached = grouped.join(of_root, "root").select(F.col("node").alias("fp"), "reached")
    return classes.join(reached, "fp", "left").select("fp", F.coalesce("reached", "least_id").alias("component_id"))


def near_duplicates(documents: DataFrame, text: str = "text") -> DataFrame:
    """For each row ``doc_id``, ``fingerprint`` as 16 hex digits and ``component_id``."""
    stash = Stash(documents.sparkSession, "simhash")
    rows = stash.save(fingerprints(documents, text), "fingerprints")
    found = simhash_components(rows, stash)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(found, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """One document of each component: the one with the smallest id (of equal rows, one)."""
    stash = Stash(documents.sparkSession, "simhash")
    keyed = documents.select("doc_id", "text", row_key("doc_id", *_others(documents), "text").alias("row"))
    rows = stash.save(fingerprints(keyed, keep=("doc_id", "row")), "fingerprints")
    return _first_of_each(documents, rows, stash)


def fingerprint_pairs(rows: DataFrame, stash: Stash) -> DataFrame:
    """Pairs ``u < v`` of nodes of ``rows(fp, bits)`` whose fingerprints ``bits`` are equal or linked.

    A fingerprint stands for its smallest node, which meets the others of the same bits and
    the smallest nodes of two linked fingerprints, so pairs grow with nodes, not with links.
    """
    classes = stash.save(rows.groupBy("bits").agg(F.min("fp").alias("least")), "bits")
    found = stash.save(links(classes.select(F.col("bits").alias("fp")), stash), "links")
    both = found.unionByName(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
    order = F.xxhash64("u", "v")
    some = both.groupBy("u").agg(F.array(F.min_by("v", order), F.max_by("v", order)).alias("some"))
    some = some.select(F.col("u").alias("bits"), F.explode("some").alias("other"))
    ends = classes.select(F.col("bits").alias("other"), F.col("least").alias("b"))
    across = some.join(classes, "bits").join(ends, "other").select(F.col("least").alias("a"), "b")
    inside = rows.select("bits", "fp").distinct().join(classes, "bits").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    pairs = across.unionByName(inside).where("a <> b")
    return pairs.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def keep_one_of_near_copies(documents: DataFrame) -> DataFrame:
    """One document of each group that five-word shingles of Jaccard similarity 0.8 or more
    link: the one with the smallest id (of equal rows, one). Fingerprints of two bits'
    distance give the first candidates, bands those that they miss.

    Defined cases: null and empty texts are one group; a text of fewer than five words is one
    shingle; null ids come last; equal rows count once; texts of any length are taken whole;
    other columns come through, whatever their names; an empty table gives none.
    """
    stash = Stash(documents.sparkSession, "near-copies")
    keyed = documents.select("doc_id", "text", row_key("doc_id", *_others(documents), "text").alias("row"))
    rows = stash.save(shingle_sets(keyed, ("doc_id", "row"), fingerprint), "sets")
    linked = near_links(rows, keyed.select("row", "text"), fingerprint_pairs(rows, stash), stash)
    return _first_of_each(documents, rows, stash, linked)


def _first_of_each(documents: DataFrame, rows: DataFrame, stash: Stash, linked: DataFrame | None = None) -> DataFrame:
    # Components need an order of rows, so a row stands for its place: id (null last), then hash.
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    found = simhash_components(rows.select(place.alias("doc_id"), "fp"), stash, linked)
    kept = found.select(F.col("component_id.doc_id").alias("kept_id"), F.col("component_id.row").alias("kept_row"))
    # Own columns go in a struct, so that none meets a name used here.
    columns = documents.columns
    names = [f"c{i}" for i in range(len(columns))]
    own = documents.select(
        F.col("doc_id").alias("own_id"), row_key("doc_id", *_others(documents), "text").alias("own_row"),
        F.struct(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)]).alias("own"),
    )
    one = own.join(kept.distinct(), (F.col("own_row") == F.col("kept_row")) & F.col("own_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return one.dropDuplicates(["own_id", "own_row"]).select(*[F.col(f"own.{n}").alias(c) for c, n in zip(columns, names, strict=True)])


def _others(documents: DataFrame) -> list[str]:
    return [c for c in documents.columns if c not in ("doc_id", "text")]
