"""Token files: ids by frequency rank in byte-aligned variable-length coding.

A file holds whole documents in ascending order of id. Ids are replaced by their rank of
frequency in the corpus, so frequent ids take one byte. Each rank takes one to four bytes;
two bits for each say how many, and these control bits stand apart from the data, so that
they are decoded by table: a control byte gives the lengths of four ranks.

Layout of a file, little-endian: the magic ``SVB1``, number of documents (u4), number of
ids (u8), size of the data (u8); then ids of documents (i8) with a byte each for null;
ids in each document (u4); control bytes; data bytes. The ranks of ids are a table beside
the files, as long as the vocabulary at most.

Defined cases: a null text is encoded as empty, so the document is the end id alone; null
ids come first, repeated ids in order of the text's hash; extra columns are ignored; an
empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docalign.llm.common import Stash, as_bytes, shuffle_partitions
from docalign.llm.library_tokens import worker_tokens
from docalign.llm.store import Files

MAGIC = b"SVB1"
HEAD = struct.Struct("<4sIQQ")
#: Ids in a file, about: a file ends with the document that reaches it.
FILE_IDS = 4_000_000
#: Lengths of the four values of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned numbers below 2**32."""
    values = values.astype("<u4")
    size = (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    padded = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    padded[: len(values)] = size
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) <= size[:, None]
    return control.astype(np.uint8).tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_values(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """Numbers back from control and data bytes: their lengths by table, their places by sums."""
    size = LENGTHS[control].ravel()[:n]
    place = np.cumsum(size) - size
    values = data[place].astype(np.uint32)
    for k in range(1, 4):
        longer = np.nonzero(size > k)[0]
        values[longer] |= data[place[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def file_parts(doc_ids: list, lengths: np.ndarray, ranks: np.ndarray) -> list[bytes]:
    control, data = encode_values(ranks)
    return [
        HEAD.pack(MAGIC, len(doc_ids), len(ranks), len(data)),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(),
        lengths.astype("<u4").tobytes(), control, data,
    ]


def read_file(content: memoryview) -> tuple[list, np.ndarray, np.ndarray]:
    """Ids of documents, ids in each, and the ranks of all."""
    magic, documents, n, size = HEAD.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(content, dtype=kind, count=count, offset=at)
        at += found.nbytes
        return found

    ids, absent = take("<i8", documents).tolist(), take("u1", documents).tolist()
    lengths, control, data = take("<u4", documents), take("u1", -(-n // 4)), take("u1", size)
    return [None if a else i for i, a in zip(ids, absent, strict=True)], lengths, decode_values(control, data, n)


def encoded_blocks(documents: DataFrame, tokenizer: str, end_id: int, partitions: int) -> DataFrame:
    """Rows ``shard, block, doc_ids, lengths, ids``: documents in order of id, up to ``FILE_IDS`` ids each.

    Shards follow each other in ranges of ids; the blocks of a shard are numbered.
    """
    order = ["doc_id", F.xxhash64("text")]
    dealt = documents.select(F.col("doc_id").cast("long"), "text")
    dealt = dealt.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    dealt = dealt.select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    schema = "shard int, block int, doc_ids array<long>, lengths binary, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_tokens(tokenizer)
        block, shard, doc_ids, parts, size = 0, None, [], [], 0

        def made() -> pa.RecordBatch:
            lengths = np.array([len(p) for p in parts], dtype="<u4").tobytes()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()), pa.array([block], pa.int32()),
                    pa.array([doc_ids], pa.list_(pa.int64())), pa.array([lengths]),
                    pa.array([np.concatenate(parts).tobytes()]),
                ],
                names=["shard", "block", "doc_ids", "lengths", "ids"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, lengths = tokens.encode_column(part.column(2))
                stops = np.cumsum(lengths + 1)
                # Each document with the end id behind it.
                ids = np.insert(ids, np.cumsum(lengths), np.array(end_id, dtype=tokens.kind))
                for number, doc_id, a, b in zip(
                    part.column(0).to_pylist(), part.column(1).to_pylist(),
                    (stops - lengths - 1).tolist(), stops.tolist(), strict=True,
                ):
                    shard = number
                    doc_ids.append(doc_id)
                    parts.append(ids[a:b])
                    size += b - a
                    if size >= FILE_IDS:
                        yield made()
                        block, doc_ids, parts, size = block + 1, [], [], 0
        if parts:
            yield made()

    return dealt.mapInArrow(run, schema)


def frequency_ranks(blocks: DataFrame, width: int) -> DataFrame:
    """Rows ``id, rank``: ids that occur, by descending frequency, then by id. As long as the vocabulary at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for ids in as_bytes(batch.column(0)):
                more = np.bincount(np.frombuffer(ids, dtype=f"<u{width}"))
                size = max(len(counts), len(more))
                counts = np.pad(counts, (0, size - len(counts))) + np.pad(more, (0, size - len(more)))
        found = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["id", "n"])

    counted = blocks.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return counted.select("id", (F.row_number().over(W.orderBy(F.desc("n"), "id")) - 1).alias("rank"))


def write_token_files(
    documents: DataFrame, folder: str, tokenizer: str, end_id: int, width: int, stash: Stash, partitions: int | None = None
) -> DataFrame:
    """Write the files below ``folder``; rows ``id, rank`` of the table that decodes them."""
    spark = documents.sparkSession
    blocks = encoded_blocks(documents, tokenizer, end_id, partitions or shuffle_partitions(spark))
    blocks = stash.save(blocks, "blocks")
    spark._jvm.System.gc()  # lets Spark delete the shuffle files of the finished job
    ranks = stash.save(frequency_ranks(blocks, width), "ranks")
    # Bounded by the vocabulary: two columns of numbers for each of its ids.
    table = np.zeros(1 + max([r.id for r in ranks.select("id").collect()], default=0), dtype="<u4")
    for r in ranks.collect():
        table[r.id] = r.rank
    rank_of = spark.sparkContext.broadcast(table.tobytes())
    Files(folder).make()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, to_rank = Files(folder), np.frombuffer(rank_of.value, dtype="<u4")
        for batch in batches:
            for i in range(batch.num_rows):
                shard, block, doc_ids, lengths, ids = (batch.column(k)[i].as_py() for k in range(5))
                ranks_of = to_rank[np.frombuffer(ids, dtype=f"<u{width}")]
                name = f"tokens-{shard:06d}-{block:06d}.svb"
                size = files.write(name, file_parts(doc_ids, np.frombuffer(lengths, dtype="<u4"), ranks_of))
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size])], names=["name", "size"])

    blocks.mapInArrow(run, "name string, size long").agg(F.sum("size")).collect()
    stash.drop(blocks)
    return ranks


def read_token_files(spark: SparkSession, folder: str, ranks: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``, and where it stands."""
    # As long as the vocabulary at most.
    id_of = spark.sparkContext.broadcast(
        np.array([r.id for r in ranks.orderBy("rank").collect()], dtype="<u4").tobytes()
    )
    content = spark.read.format("binaryFile").option("pathGlobFilter", "tokens-*.svb").load(folder)
    place = F.regexp_extract("path", r"tokens-(\d+)-(\d+)\.svb$", 1), F.regexp_extract("path", r"-(\d+)\.svb$", 1)
    content = content.select(place[0].cast("int").alias("shard"), place[1].cast("int").alias("block"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_id = np.frombuffer(id_of.value, dtype="<u4")
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, lengths, ranks_of = read_file(memoryview(batch.column(2)[i].as_buffer()))
                ids = to_id[ranks_of].astype("<u4").tobytes()
                ends = np.cumsum(lengths.astype(np.int64))
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column(0)[i].as_py()] * len(crc), pa.int32()),
                        pa.array([batch.column(1)[i].as_py()] * len(crc), pa.int32()),
                        pa.array(doc_ids, pa.int64()), pa.array(ends - lengths),
                        pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64()),
                    ],
                    names=["shard", "block", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    return content.mapInArrow(
        run, "shard int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )


def with_starts(found: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all documents before, by sums over blocks, then over shards."""
    blocks = found.groupBy("shard", "block").agg(F.sum("n_tokens").alias("n"))
    before = W.unboundedPreceding, -1
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("shard_n"))
    shards = shards.withColumn("base", F.coalesce(F.sum("shard_n").over(W.orderBy("shard").rowsBetween(*before)), F.lit(0)))
    inside = W.partitionBy("shard").orderBy("block").rowsBetween(*before)
    bases = blocks.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(shards, "shard")
    bases = bases.select("shard", "block", (F.col("base") + F.col("before")).alias("base"))
    return found.join(bases, ["shard", "block"]).withColumn("start", F.col("base") + F.col("inside"))


def token_file_digests(documents: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write all documents as token files and read them back: ``doc_id, start, n_tokens, ids_crc32``."""
    spark = documents.sparkSession
    stash = Stash(spark, "tokens")
    width = worker_tokens(tokenizer).width
    folder = stash.path("files")
    ranks = write_token_files(documents, folder, tokenizer, end_id, width, stash)
    # Decoded once: sums and rows both come from this table.
    found = stash.save(read_token_files(spark, folder, ranks), "documents")
    return with_starts(found).select("doc_id", "start", "n_tokens", "ids_crc32")
