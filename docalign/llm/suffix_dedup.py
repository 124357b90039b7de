"""Exact removal of repeated byte strings by suffix order.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a
document of smaller id, or earlier in the same one. Strings are judged on the input.

1. Every string is given to the smallest hash of the short grams inside it (the leftmost
   one), so equal strings go to equal grams, wherever they stand. The strings of one gram
   are neighbors; with their bytes they are a *context*. Grams that occur once in the
   corpus repeat nothing and are dropped.
2. Equal contexts are one class. All its occurrences but the first are repeats whole.
3. Contexts that share a gram but are not equal may share some strings. The first
   occurrences are sharded by gram, and each shard's suffixes are sorted by external
   induced sorting; neighbors that share ``LENGTH`` bytes or more are equal strings, and
   all but the earliest are repeats.
4. The spans that repeats cover are joined to the documents and cut out.

A passage in a third of all documents is one class for each of its inner grams, counted
by partial aggregation. At its two edges, contexts differ from document to document; their
shard may be large, and its sorting takes some 45 bytes of memory for each of its bytes.

Defined cases: a null text counts as empty; nothing is removed from texts shorter than
``LENGTH``; a null id comes after all others; rows of one id with different texts are
different documents, in order of the text's hash; equal rows are one document, so neither
repeats the other, and both lose the same bytes; extra columns are ignored or carried;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docalign.llm.common import Stash, as_bytes, row_key, shuffle_partitions
from docalign.llm.induced import InducedSort

LENGTH = 100
GRAM = 20


@dataclass(frozen=True)
class Sharding:
    """Bytes of context for one shard, about; a shard of one gram may be larger."""

    shard_bytes: int = 4_000_000


_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _ODD[0] + (b ^ (b >> np.uint64(29))) * _ODD[1]
    x ^= x >> np.uint64(32)
    x *= _ODD[2]
    x ^= x >> np.uint64(29)
    return x


def gram_hashes(text: np.ndarray, width: int = GRAM) -> np.ndarray:
    """Hash of the ``width`` bytes from each place on, by doubling."""
    done, span, have = None, 0, text.astype(np.uint64) * _ODD[3] + _ODD[0]
    size = 1
    while size <= width:
        if width & size:
            done = have if done is None else _mix(done[: len(have) - span], have[span:])
            span += size
        size *= 2
        if size <= width:
            have = _mix(have[: -(size // 2)], have[size // 2 :])
    return done[: len(text) - width + 1]


def least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the least (then leftmost) of each ``width`` neighboring hashes."""
    place = np.uint64(len(hashes).bit_length())
    low = (np.uint64(1) << place) - np.uint64(1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        rest = width - size
        least = np.minimum(least[:-rest], least[rest:])
    return (least & low).astype(np.int64)


def contexts_of(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hash, context hash, first string and number of strings of each context of a text."""
    grams = gram_hashes(text)
    owner = least_places(grams, LENGTH - GRAM + 1)
    starts = np.append(0, np.nonzero(np.diff(owner))[0] + 1)
    counts = np.diff(np.append(starts, len(owner)))
    anchors = owner[starts]
    # The context's bytes are covered by grams side by side, the last one flush with the end.
    last = starts + counts - 1 + LENGTH - GRAM
    made = _mix(counts.astype(np.uint64), (anchors - starts).astype(np.uint64))
    for k in range((2 * LENGTH - GRAM) // GRAM + 1):
        made = _mix(made, grams[np.minimum(starts + k * GRAM, last)])
    return grams[anchors], made, starts, counts


CONTEXT = "gram long, context long, start long, strings int"


def document_contexts(documents: DataFrame) -> DataFrame:
    """Rows ``doc_id, row, gram, context, start, strings`` of all contexts. ``documents``: ``doc_id, row, text``."""
    needed = documents.select("doc_id", "row", "text")
    schema = T.StructType(needed.schema.fields[:2] + T.StructType.fromDDL(CONTEXT).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = [], []
            for i, text in enumerate(as_bytes(batch.column(2))):
                if len(text) >= LENGTH:
                    found.append(contexts_of(np.frombuffer(text, dtype=np.uint8)))
                    owner.append((i, len(found[-1][0])))
            if not found:
                continue
            rows = pa.array(np.repeat([i for i, _ in owner], [n for _, n in owner]))
            gram, context, start, strings = (np.concatenate(x) for x in zip(*found, strict=True))
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows), batch.column(1).take(rows), pa.array(gram.view(np.int64)),
                    pa.array(context.view(np.int64)), pa.array(start), pa.array(strings.astype(np.int32)),
                ],
                names=[f.name for f in schema.fields],
            )
            for at in range(0, out.num_rows, 20_000):
                yield out.slice(at, 20_000)

    return needed.mapInArrow(run, schema)


def _document_order() -> Column:
    """Documents by id, null last, then by hash of the text."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "start")


def cut_contexts(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """Bytes of spans: rows of ``spans`` (``doc_id, row, gram, start, strings``) with ``bytes``."""
    wanted = spans.groupBy("doc_id", "row").agg(F.collect_list(F.struct("gram", "start", "strings")).alias("spans"))
    wanted = wanted.select(F.col("doc_id").alias("of_id"), F.col("row").alias("of_row"), "spans")
    one = documents.join(wanted, (F.col("row") == F.col("of_row")) & F.col("doc_id").eqNullSafe(F.col("of_id")))
    text = F.encode("text", "utf-8")
    return one.select("doc_id", "row", text.alias("text"), F.explode("spans").alias("s")).select(
        "doc_id", "row", "s.gram", "s.start", "s.strings",
        F.substring("text", F.col("s.start").cast("int") + 1, F.col("s.strings") + LENGTH - 1).alias("bytes"),
    )


SPAN = "start long, end long"


def shard_repeats(contexts: DataFrame, shards: int) -> DataFrame:
    """Rows ``doc_id, row, start, end``: spans of strings that start earlier in their shard too.

    The contexts of a shard come in document order, one partition or more shards each; they
    are written to one file with a zero byte behind each, so a place in the file is a
    place in document order.
    """
    schema = T.StructType(contexts.select("doc_id", "row").schema.fields + T.StructType.fromDDL(SPAN).fields)
    dealt = contexts.repartition(shards, "gram").sortWithinPartitions(F.col("doc_id").isNull(), "doc_id", "row", "start")
    dealt = dealt.select("doc_id", "row", "start", "strings", "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = tempfile.mkdtemp(prefix="shard-")
        try:
            yield from repeats_in_folder(batches, folder)
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    def repeats_in_folder(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
        where, heads, size = [], [], 0
        before = (np.int64(0), np.int64(-1))
        with open(os.path.join(folder, "text"), "wb") as file:
            for batch in batches:
                if not batch.num_rows:
                    continue
                row, first = batch.column(1).to_numpy(), batch.column(2).to_numpy()
                # Equal rows of the table are one document: their contexts stand next to each other.
                same = (row == np.append(before[0], row[:-1])) & (first == np.append(before[1], first[:-1]))
                before = (row[-1], first[-1])
                if same.any():
                    batch = batch.filter(pa.array(~same))
                parts = [b.as_py() for b in batch.column(4)]
                file.write(b"".join(p + b"\0" for p in parts))
                lengths = np.array([len(p) + 1 for p in parts], dtype=np.int64)
                ends = size + np.cumsum(lengths)
                size = int(ends[-1]) if len(ends) else size
                where.append((ends - lengths, batch.column(2).to_numpy(), batch.column(3).to_numpy()))
                heads.append(batch.select([0, 1]))
        if not size:
            return
        begin, start, strings = (np.concatenate(x) for x in zip(*where, strict=True))
        head = pa.Table.from_batches(heads)
        # Short shards are read whole; the map is for those beyond memory.
        text = np.memmap(os.path.join(folder, "text"), dtype=np.uint8, mode="r", shape=(size,))
        text = np.array(text) if size < 1 << 26 else text
        for context, first, last in repeated_runs(text, begin, strings, folder):
            yield from pa.table(
                {
                    "doc_id": head.column(0).take(context), "row": head.column(1).take(context),
                    "start": start[context] + first, "end": start[context] + last + LENGTH,
                }
            ).to_batches(max_chunksize=20_000)

    return dealt.mapInArrow(run, schema)


def repeated_runs(
    text: np.ndarray, begin: np.ndarray, strings: np.ndarray, folder: str
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (context, first, last): runs of strings that start earlier in the text too."""
    repeated = np.lib.format.open_memmap(os.path.join(folder, "repeated.npy"), "w+", bool, (len(text),))
    order = InducedSort(text, folder)
    left = (np.empty(0, dtype=np.int64), 0)  # places and number of the last group, which may go on
    number = 0
    for at, lcp in order.descending():
        group = number + np.cumsum(lcp < LENGTH)
        number = int(group[-1])
        context = np.searchsorted(begin, at, side="right") - 1
        valid = at - begin[context] < strings[context]
        places = np.append(left[0], at[valid])
        groups = np.append(np.full(len(left[0]), left[1]), group[valid])
        if not len(places):
            continue
        firsts = np.append(0, np.nonzero(np.diff(groups))[0] + 1)
        sizes = np.diff(np.append(firsts, len(places)))
        earliest = np.minimum.reduceat(places, firsts)
        repeated[places[places != np.repeat(earliest, sizes)]] = True
        # Only the earliest place of the open group is needed to judge what follows; all
        # others are marked. If an earlier one turns up, this one is marked then.
        left = (earliest[-1:], int(groups[-1]))
    order.close()
    for a in range(0, len(begin), 1 << 16):
        b = min(a + (1 << 16), len(begin))
        low = int(begin[a])
        high = int(begin[b]) if b < len(begin) else len(text)
        marks = np.concatenate([[0], np.asarray(repeated[low:high]).astype(np.int8), [0]])
        change = np.diff(marks)
        on, off = np.nonzero(change == 1)[0] + low, np.nonzero(change == -1)[0] + low
        # The byte behind each context is never marked, so a run lies in one context.
        context = np.searchsorted(begin, on, side="right") - 1
        if len(on):
            yield context, on - begin[context], off - 1 - begin[context]


def repeated_spans(documents: DataFrame, stash: Stash, sharding: Sharding = Sharding()) -> DataFrame:
    """Rows ``doc_id, row, start, end`` of bytes to remove; spans of a document may overlap."""
    spark = documents.sparkSession

    def done(*frames: DataFrame) -> None:
        """Delete tables that are not read again, and let Spark delete the shuffle files of finished jobs."""
        stash.drop(*frames)
        spark._jvm.System.gc()

    grams = document_contexts(documents).select("gram").groupBy("gram").agg(F.count("*").alias("n"))
    twice = stash.save(grams.where("n > 1").select("gram"), "grams")
    shared = stash.save(document_contexts(documents).join(twice, "gram", "left_semi"), "shared")
    done(twice)

    classes = shared.groupBy("gram", "context").agg(
        F.min(_document_order()).alias("first"), F.max("strings").alias("strings"), F.count("*").alias("n")
    )
    classes = stash.save(classes, "classes")
    first = classes.where("n > 1").select("gram", "context", "first")
    whole = shared.join(first, ["gram", "context"]).where(_document_order() > F.col("first"))
    whole = whole.select("doc_id", "row", "start", (F.col("start") + F.col("strings") + LENGTH - 1).alias("end"))
    whole = stash.save(whole, "whole")
    done(shared)

    several = classes.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    spans = classes.join(several, "gram", "left_semi").select("first.doc_id", "first.row", "gram", "first.start", "strings")
    contexts = stash.save(cut_contexts(documents, spans), "contexts")
    done(classes)
    total = contexts.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(shuffle_partitions(spark), -(-total // sharding.shard_bytes))
    inner = stash.save(shard_repeats(contexts, shards), "inner")
    done(contexts)
    return whole.unionByName(inner)


CUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def cut_documents(documents: DataFrame, spans: DataFrame, keep: list[str], with_text: bool) -> DataFrame:
    """Documents without the bytes of their spans: ``keep`` columns, sizes, hash, and the rest on request."""
    found = spans.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    found = found.select(F.col("doc_id").alias("of_id"), F.col("row").alias("of_row"), "spans")
    joined = documents.join(
        found, (F.col("row") == F.col("of_row")) & F.col("doc_id").eqNullSafe(F.col("of_id")), "left"
    ).select(*keep, "text", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))
    fields = T.StructType.fromDDL(CUT).fields
    schema = T.StructType([joined.schema[c] for c in keep] + fields[: None if with_text else -1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(keep)
        for batch in batches:
            made: list[list] = [[] for _ in fields]
            for i, text in enumerate(as_bytes(batch.column(n))):
                starts, ends = batch.column(n + 1)[i], batch.column(n + 2)[i]
                kept, removed, runs = text, 0, 0
                if starts.is_valid:
                    edges = np.zeros(len(text) + 1, dtype=np.int64)
                    np.add.at(edges, starts.values.to_numpy(), 1)
                    np.add.at(edges, ends.values.to_numpy(), -1)
                    gone = np.cumsum(edges[:-1]) > 0
                    kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                    removed = int(gone.sum())
                    runs = int((np.diff(np.append(False, gone).astype(np.int8)) == 1).sum())
                row = (len(text), removed, runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if with_text else None)
                for values, value in zip(made, row, strict=True):
                    values.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(v, k) for v, k in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n)] + arrays[: len(schema.fields) - n],
                names=[f.name for f in schema.fields],
            )

    return joined.mapInArrow(run, schema)


def suffix_dedup(documents: DataFrame, sharding: Sharding = Sharding()) -> DataFrame:
    """For each row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    stash = Stash(documents.sparkSession, "suffix")
    keyed = documents.select("doc_id", "text", row_key("doc_id", "text").alias("row"))
    return cut_documents(keyed, repeated_spans(keyed, stash, sharding), ["doc_id"], False)


def remove_repeats(documents: DataFrame, sharding: Sharding = Sharding()) -> DataFrame:
    """Documents with their own columns and what is left of their text (``n_chars`` follows it).

    Bytes of characters that are cut in two are dropped from the new text.
    """
    stash = Stash(documents.sparkSession, "suffix")
    columns = [c for c in documents.columns if c != "text"]
    names = [f"c{i}" for i in range(len(columns))]
    own = F.struct(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)])
    keyed = documents.select("doc_id", "text", row_key("doc_id", "text").alias("row"), own.alias("own"))
    spans = repeated_spans(keyed.drop("own"), stash, sharding)
    left = cut_documents(keyed, spans, ["own"], True)
    out = left.select(
        *[F.col(f"own.{n}").alias(c) for c, n in zip(columns, names, strict=True)], F.col("kept").alias("text")
    )
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return out.select(*documents.columns)
