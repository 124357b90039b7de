"""Token counts of documents in flat token files without an index.

A flat file is nothing but ids, each ``width`` bytes; a document ends with the end id. A
file is read in blocks by many tasks: each looks for end ids in its block by one array
comparison. What a block cannot know is where its first document began; that is the ids
behind the last end id of the blocks before, a prefix scan over one row per block.

Defined cases: ids behind the last end id of a file are a document that was not ended
(``ended`` false); an end id right behind another ends a document of length 1; an empty
file has no documents; a null text is written as the end id alone; strings of special
tokens in a text are written as ordinary text, so that no text holds the end id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docalign.llm.bpe import REMEMBERED, Bpe
from docalign.llm.common import Stash, as_bytes
from docalign.llm.store import Files

#: Ids in a block.
BLOCK_IDS = 4_000_000
#: Ids in a file that is written, about.
FILE_IDS = 16_000_000


def write_flat_files(documents: DataFrame, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Write texts as flat files of two-byte ids, one or more for each task, in the table's order.

    Gives rows ``name, n_ids, doc_ids``; a repeated task writes the same files again.
    """
    Files(folder).make()
    needed = documents.select(F.spark_partition_id().alias("part"), F.col("doc_id").cast("long"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known, files = Bpe(vocabulary), {}, Files(folder)
        if bpe.merger.size + len(bpe.special) > 1 << 16:
            raise ValueError("two-byte ids hold vocabularies up to 65,536")
        bpe.special_at = None
        end = np.array([end_id], dtype="<u2").tobytes()
        number, doc_ids, parts, size, part = 0, [], [], 0, 0

        def made() -> pa.RecordBatch:
            name = f"flat-{part:06d}-{number:06d}.bin"
            files.write(name, parts)
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([size]), pa.array([doc_ids], pa.list_(pa.int64()))],
                names=["name", "n_ids", "doc_ids"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                split = [bpe.pieces(t.decode("utf-8", "replace")) for t in as_bytes(rows.column(2))]
                new = set().union(*split).difference(known)
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                    new = set().union(*split)
                new = list(new)
                for chunk, ids in zip(new, bpe.learn(new), strict=True):
                    known[chunk] = np.array(ids, dtype="<u2").tobytes()
                part = rows.column(0)[0].as_py()
                for doc_id, chunks in zip(rows.column(1).to_pylist(), split, strict=True):
                    doc_ids.append(doc_id)
                    parts.append(b"".join(map(known.__getitem__, chunks)) + end)
                    size += len(parts[-1]) // 2
                    if size >= FILE_IDS:
                        yield made()
                        number, doc_ids, parts, size = number + 1, [], [], 0
        if parts:
            yield made()

    return needed.mapInArrow(run, "name string, n_ids long, doc_ids array<long>")


def file_blocks(spark: SparkSession, folder: str, pattern: str, width: int, block_ids: int) -> DataFrame:
    """Rows ``name, block, start, n``: the blocks of all files, in ids. File contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.floor(F.col("length") / width).alias("ids")
    )
    cut = listed.where("ids > 0").select(
        "name", "ids", F.explode(F.sequence(F.lit(0), F.floor((F.col("ids") - 1) / block_ids))).alias("block")
    )
    start = F.col("block") * block_ids
    return cut.select("name", "block", start.alias("start"), F.least(F.lit(block_ids), F.col("ids") - start).alias("n"))


def block_ends(blocks: DataFrame, folder: str, end_id: int, width: int) -> DataFrame:
    """Add ``ends``, the places of end ids within each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(folder)
        for batch in batches:
            for i in range(batch.num_rows):
                name, _, start, n = (batch.column(k)[i].as_py() for k in range(4))
                ids = np.frombuffer(files.read(name, start * width, n * width), dtype=f"<u{width}")
                ends = np.nonzero(ids == end_id)[0]
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(i, 1) for c in batch.columns], pa.array([ends], pa.list_(pa.int64()))],
                    names=[*batch.schema.names, "ends"],
                )

    # One block is one task's read; blocks are dealt out evenly, whatever file they come from.
    dealt = blocks.repartition("name", "block")
    return dealt.mapInArrow(run, "name string, block long, start long, n long, ends array<long>")


def count_tokens(
    spark: SparkSession, folder: str, end_id: int, width: int = 2, pattern: str = "*.bin", block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Rows ``name, doc_no, start, n_tokens, ended`` of all documents in flat files; counts include the end id."""
    stash = Stash(spark, "counts")
    found = stash.save(block_ends(file_blocks(spark, folder, pattern, width, block_ids), folder, end_id, width), "ends")
    blocks = found.select(
        "name", "block", "start", "n", F.size("ends").alias("k"), (F.col("start") + F.try_element_at("ends", F.lit(-1))).alias("last")
    )
    before = W.partitionBy("name").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = blocks.select(
        "name", "block",
        F.coalesce(F.sum("k").over(before), F.lit(0)).alias("docs_before"),
        (F.coalesce(F.max("last").over(before), F.lit(-1)) + 1).alias("open_start"),
    )
    ended = found.where(F.size("ends") > 0).join(carried, ["name", "block"])
    # A document begins behind the end before it, in this block or an earlier one.
    each = ended.select(
        "name", "start", "docs_before", "open_start", "ends", F.posexplode("ends").alias("k", "end")
    )
    begin = F.when(F.col("k") == 0, F.col("open_start")).otherwise(F.col("start") + F.get("ends", F.col("k") - 1) + 1)
    documents = each.select(
        "name", (F.col("docs_before") + F.col("k")).alias("doc_no"), begin.alias("start"),
        (F.col("start") + F.col("end") + 1 - begin).alias("n_tokens"), F.lit(True).alias("ended"),
    )
    files = blocks.groupBy("name").agg(F.sum("k").alias("doc_no"), (F.max("last") + 1).alias("start"), F.sum("n").alias("ids"))
    files = files.withColumn("start", F.coalesce("start", F.lit(0)))
    rest = files.select("name", "doc_no", "start", (F.col("ids") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return documents.unionByName(rest.where("n_tokens > 0"))


def document_token_counts(documents: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write all documents as flat files and count the tokens of each: ``doc_id, n_tokens`` and where it stands."""
    spark = documents.sparkSession
    stash = Stash(spark, "flat")
    folder = stash.path("files")
    written = stash.save(write_flat_files(documents, folder, vocabulary, end_id), "written")
    owners = written.select("name", F.posexplode("doc_ids").alias("doc_no", "doc_id"))
    counted = count_tokens(spark, folder, end_id)
    return counted.join(owners, ["name", "doc_no"]).select("doc_id", "name", "doc_no", "start", "n_tokens")
