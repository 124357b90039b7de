"""Prefix trie of conversations by vertical bitmaps.

A conversation is its turns in order; a node of the trie is a distinct sequence of first
turns, and conversations that begin with it are its members. Conversations are sorted by
range of their sequences of turn hashes, so the members of a node stand side by side and no
prefix, however common, makes a partition large. A partition is worked through in shards
of bounded size. A shard indexes each (position, turn) to the bitset of its conversations;
from the root, the bitset of a node is intersected with the posting of the next turn of its
lowest member, which gives a child, its popcount and, where sequences end, its end list.

A node whose members lie in one shard is finished there. Only nodes on the path of a shard's
first or last sequence can have members elsewhere; these few rows (at most two paths a shard)
are added up over the shards, and what hangs below them is carried along as sums.

Two turns are the same if the 128-bit hash of role and text is.

Defined cases: rows with a null id take no part; a null role or text is empty; turns are
taken by turn number, null first, rows of one number by role, first 64 characters and hash of
the text; repeated rows are turns of their own. A conversation without turns is a member of the root only. An empty
table has no node. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.llm.common import Stash, shuffle_partitions

#: Conversations and turns that one shard holds at most (one longer conversation is a shard).
SHARD_CONVERSATIONS = 4096
SHARD_TURNS = 100_000
#: Conversations for one partition of the sort.
PARTITION_CONVERSATIONS = 50_000
#: Ids in one fragment of an end list.
FRAGMENT = 1000
WIDTH = 16

SEQUENCES = "conv_id long, turns binary, sizes binary"
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, node binary, parent binary, is_open boolean, bytes long, shard string, "
    "ends array<long>, path array<binary>"
)


# --- sequences ------------------------------------------------------------------------------


def turn_rows(conversations: DataFrame) -> DataFrame:
    """Rows of turns with the hash of role and text, and the UTF-8 bytes of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.unhex(F.md5(whole)).alias("hash"),
        F.octet_length(text).cast("long").alias("size"),
        F.substring(text, 1, 64).alias("start"),
    )


def own_sequences(conversations: DataFrame) -> DataFrame:
    """Each conversation's own turns as one row: ``SEQUENCES``."""
    return _sequences(conversations, F.col("conv_id"), None)


def rebuilt_sequences(conversations: DataFrame, family: int = 5, longest: int = 9) -> DataFrame:
    """Conversations that take over the first turns of another one.

    The first h turns of conversation c are those of conversation c - c % ``family`` (all it
    has, if fewer), then follow its own after its first h; h is the unsigned CRC-32 of c in
    decimal modulo ``longest``. A family is at most twice ``family`` conversations.
    """
    return _sequences(conversations, F.col("conv_id") - F.col("conv_id") % family, longest)


def _sequences(conversations: DataFrame, base: Column, longest: int | None) -> DataFrame:
    spark = conversations.sparkSession
    turns = turn_rows(conversations).withColumn("base", base)
    ordered = turns.repartition(shuffle_partitions(spark), "base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "role", "start", "hash"
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, bytes, bytes]] = []
        family, first = None, (b"", b"")
        for conv_id, at, hashes, sizes in _conversations(batches):
            if longest is None:
                rows.append((conv_id, hashes, sizes))
            else:
                if at != family:
                    family, first = at, (b"", b"")
                if conv_id == at:
                    first = (hashes, sizes)
                h = crc32(conv_id) % longest
                rows.append((conv_id, first[0][: h * WIDTH] + hashes[h * WIDTH :], first[1][: h * 8] + sizes[h * 8 :]))
            if len(rows) >= 5000:
                yield _sequence_batch(rows)
                rows = []
        if rows:
            yield _sequence_batch(rows)

    return ordered.select("base", "conv_id", "hash", "size").mapInArrow(build, SEQUENCES)


def crc32(number: int) -> int:
    import zlib

    return zlib.crc32(str(number).encode())


def _sequence_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    ids, turns, sizes = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(turns, pa.binary()), pa.array(sizes, pa.binary())], ["conv_id", "turns", "sizes"]
    )


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, bytes]]:
    """``(conv_id, base, hashes, sizes)`` of rows in order, put together across batches."""
    held: tuple[int, int] | None = None
    hashes: list[bytes] = []
    sizes: list[bytes] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        base, ids = (np.asarray(batch.column(i)) for i in (0, 1))
        size = np.asarray(batch.column(3)).astype("<i8")
        flat = b"".join(batch.column(2).to_pylist())
        cut = np.flatnonzero((ids[1:] != ids[:-1]) | (base[1:] != base[:-1])) + 1
        starts = [0, *cut.tolist()]
        for s, e in zip(starts, [*starts[1:], len(ids)]):
            key = (int(ids[s]), int(base[s]))
            if held != key:
                if held is not None:
                    yield (*held, b"".join(hashes), b"".join(sizes))
                held, hashes, sizes = key, [], []
            hashes.append(flat[s * WIDTH : e * WIDTH])
            sizes.append(size[s:e].tobytes())
    if held is not None:
        yield (*held, b"".join(hashes), b"".join(sizes))


# --- one shard --------------------------------------------------------------------------------


class Shard:
    """Conversations side by side in the order of their sequences, and the trie of them."""

    def __init__(self, rows: list[tuple[int, bytes, bytes]]) -> None:
        self.ids = [r[0] for r in rows]
        self.turns = [r[1] for r in rows]
        self.sizes = [np.frombuffer(r[2], dtype="<i8").tolist() for r in rows]
        self.length = [len(s) for s in self.sizes]
        #: (position, turn) -> bitset of conversations.
        self.postings: dict[tuple[int, bytes], int] = {}
        postings = self.postings
        for k, (turns, n) in enumerate(zip(self.turns, self.length)):
            bit = 1 << k
            for p in range(n):
                key = (p, turns[p * WIDTH : p * WIDTH + WIDTH])
                postings[key] = postings.get(key, 0) | bit

    def nodes(self) -> list[dict]:
        """Nodes from the root down, a parent before its children."""
        ids, turns, sizes, length, postings = self.ids, self.turns, self.sizes, self.length, self.postings
        found: list[dict] = []
        # (bitset, depth, number of the parent, one member)
        todo = [((1 << len(ids)) - 1, 0, -1)]
        while todo:
            members, depth, parent = todo.pop()
            low = (members & -members).bit_length() - 1
            n = members.bit_count()
            place = len(found)
            ends, smallest, rest = [], None, members
            if n == 1:
                smallest = ids[low]
                if length[low] == depth:
                    ends, rest = [smallest], 0
            else:
                at = [k for k in _bits(members, low)]
                smallest = min(map(ids.__getitem__, at))
                # Sequences that end here sort first.
                for k in at:
                    if length[k] != depth:
                        break
                    ends.append(ids[k])
                    rest ^= 1 << k
            found.append(
                {
                    "members": n, "low": low, "depth": depth, "parent": parent, "conv_id": smallest,
                    "bytes": sizes[low][depth - 1] if depth else 0, "ends": ends, "children": 0,
                    "leaves": 0, "saved": 0,
                }
            )
            if parent >= 0:
                found[parent]["children"] += 1
            while rest:
                k = (rest & -rest).bit_length() - 1
                child = rest & postings[depth, turns[k][depth * WIDTH : (depth + 1) * WIDTH]]
                rest ^= child
                todo.append((child, depth + 1, place))
        return found

    def key(self, node: dict) -> bytes:
        """A hash of the node's whole sequence."""
        return hashlib.md5(self.turns[node["low"]][: node["depth"] * WIDTH]).digest()

    def rows(self, name: str) -> Iterator[dict]:
        """Nodes as rows; those on the first and the last path are open, all others whole.

        An open row holds what lies below it in this shard and is not open itself:
        leaves, saved bytes and number of whole children.
        """
        nodes = self.nodes()
        first, last = self.turns[0], self.turns[-1]
        opened = []
        for node in nodes:
            own = self.turns[node["low"]][: node["depth"] * WIDTH]
            opened.append(first.startswith(own) or last.startswith(own))
        for place in range(len(nodes) - 1, -1, -1):
            node = nodes[place]
            if not opened[place]:
                node["leaves"] += not node["children"]
                node["saved"] += (node["members"] - 1) * node["bytes"]
                if node["parent"] >= 0:
                    nodes[node["parent"]]["leaves"] += node["leaves"]
                    nodes[node["parent"]]["saved"] += node["saved"]
            elif node["parent"] >= 0:
                # Open children are counted where the shards are added up.
                nodes[node["parent"]]["children"] -= 1
        for node, is_open in zip(nodes, opened):
            up = nodes[node["parent"]] if node["parent"] >= 0 else None
            up_open = up is not None and opened[node["parent"]]
            turns = self.turns[node["low"]]
            yield {
                "conv_id": node["conv_id"], "depth": node["depth"],
                "parent_conv_id": None if up is None or up_open else up["conv_id"],
                "n_convs": node["members"], "n_children": node["children"], "n_leaves": node["leaves"],
                "saved_tokens": node["saved"], "node": self.key(node) if is_open else None,
                "parent": self.key(up) if up_open else None, "is_open": is_open, "bytes": node["bytes"], "shard": name,
                "ends": node["ends"],
                "path": [hashlib.md5(turns[: d * WIDTH]).digest() for d in range(node["depth"])] if is_open else None,
            }


def _bits(members: int, low: int) -> Iterator[int]:
    """Places of the bits that are set, ascending."""
    raw = np.frombuffer((members >> low).to_bytes((members.bit_length() - low + 7) // 8, "little"), dtype=np.uint8)
    return (np.flatnonzero(np.unpackbits(raw, bitorder="little")) + low).tolist()


def _shards(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[list[tuple[int, bytes, bytes]]]:
    rows: list[tuple[int, bytes, bytes]] = []
    turns = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
            more = len(row[1]) // WIDTH
            if rows and (len(rows) >= most or turns + more > SHARD_TURNS):
                yield rows
                rows, turns = [], 0
            rows.append(row)
            turns += more
    if rows:
        yield rows


# --- the whole trie ----------------------------------------------------------------------------


class Trie:
    """Tables of one trie; ``nodes`` and ``end_lists`` are the results."""

    def __init__(self, sequences: DataFrame, shard_conversations: int = SHARD_CONVERSATIONS) -> None:
        """``sequences`` has the columns of ``SEQUENCES``, one row per conversation."""
        self.spark = sequences.sparkSession
        self.stash = Stash(self.spark, "trie")
        stored = self.stash.save(sequences, "sequences")
        many = stored.count()
        parts = max(min(shuffle_partitions(self.spark), many), -(-many // PARTITION_CONVERSATIONS), 1)
        ordered = stored.repartitionByRange(parts, "turns", "conv_id").sortWithinPartitions("turns", "conv_id")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            task = TaskContext.get().partitionId()
            for k, rows in enumerate(_shards(batches, shard_conversations)):
                # Shards sort by name as their sequences do.
                made = list(Shard(rows).rows(f"{task:09d}-{k:09d}"))
                for at in range(0, len(made), 10_000):
                    yield _node_batch(made[at : at + 10_000])

        self.shards = self.stash.save(ordered.mapInArrow(work, NODES), "nodes")
        self.stash.drop(stored)
        self.opened = self.stash.save(self._added_up(), "open")

    def _added_up(self) -> DataFrame:
        """Open nodes over all shards, whole: one row a node."""
        part = self.shards.where("is_open")
        merged = part.groupBy("node").agg(
            F.min("conv_id").alias("conv_id"), F.any_value("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"), F.any_value("bytes").alias("bytes"),
            F.any_value("parent").alias("parent"), F.any_value("path").alias("path"),
        )
        open_children = merged.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("open_children"))
        merged = merged.join(open_children, "node", "left").withColumn(
            "n_children", F.col("n_children") + F.coalesce("open_children", F.lit(0))
        )
        own = F.struct(
            (F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        )
        merged = self.stash.save(merged.withColumn("own", own), "merged")
        below = (
            merged.select(F.explode("path").alias("node"), "own.leaves", "own.saved")
            .groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        )
        ids = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        return (
            merged.join(below, "node", "left").join(ids, "parent", "left")
            .select(
                "node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                (F.col("own.leaves") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"),
                (F.col("own.saved") + F.coalesce("saved", F.lit(0))).alias("saved_tokens"),
            )
        )

    def nodes(self) -> DataFrame:
        """One row per node: ``node`` (null where no other shard has members), ``ends`` (null for open nodes)
        and its figures. ``conv_id`` and ``depth`` tell nodes apart."""
        whole = self.shards.where("not is_open")
        # The parent's id, shard by shard: however many children an open node has, those of one shard are few.
        of_shard = self.shards.where("is_open").select("shard", "node").join(self.opened.select("node", "conv_id"), "node")
        of_shard = of_shard.select("shard", F.col("node").alias("parent"), F.col("conv_id").alias("up"))
        figures = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
        none = F.lit(None).cast("array<long>")
        inside = whole.where("parent is null").select("node", *figures, "ends")
        hanging = whole.where("parent is not null").join(of_shard, ["shard", "parent"]).withColumn("parent_conv_id", F.col("up"))
        return inside.unionByName(hanging.select("node", *figures, "ends")).unionByName(
            self.opened.select("node", *figures, none.alias("ends"))
        )

    def end_lists(self) -> DataFrame:
        """End lists of open nodes in fragments: ``node, shard, piece, ids``; a list goes on in this order."""
        pieces = F.transform(
            F.sequence(F.lit(0), F.floor((F.size("ends") - 1) / FRAGMENT).cast("int")),
            lambda i: F.struct(i.alias("piece"), F.slice("ends", i * FRAGMENT + 1, FRAGMENT).alias("ids")),
        )
        listed = self.shards.where("is_open and size(ends) > 0").select("node", "shard", F.explode(pieces).alias("p"))
        return listed.select("node", "shard", "p.piece", "p.ids")


def _node_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {
        "node": pa.binary(), "parent": pa.binary(), "is_open": pa.bool_(), "shard": pa.string(),
        "ends": pa.list_(pa.int64()), "path": pa.list_(pa.binary()),
    }
    names = [c.split()[0] for c in NODES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.int64())) for n in names], names)


def _joined(ids: Column) -> Column:
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), ",")


def digests(trie: Trie) -> DataFrame:
    """The nodes with ``ends_sha256``, the hash of their end list in decimal, joined by commas."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != node:
                    if node is not None:
                        out.append((node, state.hexdigest()))
                    node, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if node is not None:
            out.append((node, state.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.string())], ["node", "sha"]
        )

    fragments = (
        trie.end_lists().select("node", "shard", "piece", _joined(F.col("ids")).alias("text"))
        .repartition("node").sortWithinPartitions("node", "shard", "piece").select("node", "text")
    )
    of_open = fragments.mapInArrow(hashed, "node binary, sha string")
    empty = hashlib.sha256().hexdigest()
    nodes = trie.nodes().withColumn("own", F.sha2(_joined(F.col("ends")).cast("binary"), 256))
    figures = [c for c in nodes.columns if c not in ("node", "ends", "own")]
    inside = nodes.where("ends is not null").select(*figures, F.col("own").alias("ends_sha256"))
    shared = nodes.where("ends is null").join(of_open, "node", "left")
    return inside.unionByName(shared.select(*figures, F.coalesce("sha", F.lit(empty)).alias("ends_sha256")))


def rebuilt_trie(conversations: DataFrame, shard_conversations: int = SHARD_CONVERSATIONS) -> DataFrame:
    """The trie of rebuilt conversations, one row per node."""
    return digests(Trie(rebuilt_sequences(conversations), shard_conversations))
