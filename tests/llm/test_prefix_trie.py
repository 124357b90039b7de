"""The prefix trie against a plain version."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from docalign.llm import prefix_trie

FIGURES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def plain_trie(sequences):
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        children[node[:-1]] = children.get(node[:-1], 0) + bool(node)
    for node, inside in members.items():
        own = (len(inside) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children.get(node)
            saved[node[:d]] += own
    out = []
    for node, inside in members.items():
        ends = ",".join(str(c) for c in sorted(inside) if len(sequences[c]) == len(node))
        out.append((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), children.get(node, 0),
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r[c] for c in FIGURES) for r in frame.collect()), key=str)


@pytest.mark.parametrize("shard", [1, 3, 4096])
def test_trie_of_common_prefixes(spark, shard):
    """Prefixes that most conversations share, whole copies, and sequences that end inside others."""
    rng = random.Random(shard)
    rows = []
    for c in range(120):
        turns = ["hello", "hé"] * rng.randint(0, 4) if c % 3 else [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        rows += [(c, i, "user" if i % 2 else None, t) for i, t in enumerate(turns)]
    mixed = list(rows)
    rng.shuffle(mixed)
    table = spark.createDataFrame(mixed, SCHEMA).repartition(5)
    assert found(prefix_trie.rebuilt_trie(table, shard)) == plain_trie(rebuilt(rows))


@pytest.mark.parametrize("shard", [1, 2, 5, 1000])
def test_shards_of_any_size(shard):
    """Rows of shards, added up by hand, have the members of the whole."""
    rng = random.Random(7)
    sequences = [(c, b"".join(bytes([rng.randint(0, 1)]) * 16 for _ in range(rng.randint(0, 5)))) for c in range(60)]
    sequences.sort(key=lambda s: (s[1], s[0]))
    rows = [(c, t, b"\1\0\0\0\0\0\0\0" * (len(t) // 16)) for c, t in sequences]
    whole, total = {}, {}
    for c, t, _ in rows:
        for d in range(len(t) // 16 + 1):
            total[t[: 16 * d]] = total.get(t[: 16 * d], 0) + 1
    for at in range(0, len(rows), shard):
        part = prefix_trie.Shard(rows[at : at + shard])
        for node in part.nodes():
            key = part.turns[node["low"]][: node["depth"] * 16]
            whole[key] = whole.get(key, 0) + node["members"]
    assert whole == total


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "no id"), (1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "a", "x"),
        (5, 3, "user", "y" * 100_000), (6, 0, None, ""), (7, 0, "user", "z"), (10, 0, "u", "q"), (14, 9, "u", "q"),
    ]
    extra = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", base int, node int, shard int")
    assert found(prefix_trie.rebuilt_trie(extra)) == plain_trie(rebuilt(rows))
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark):
    from docalign.llm import queries

    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    got = queries.queries()["op13_prefix_trie"](spark, folder)
    assert found(got) == plain_trie(rebuilt([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]))
