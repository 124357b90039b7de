"""Near copies against all pairs of five-word shingle sets."""

from __future__ import annotations

import random
from functools import cache
from itertools import combinations

from docalign.llm import simhash


@cache
def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    both, union = len(shingles(a) & shingles(b)), len(shingles(a) | shingles(b))
    return both / union if union else 1.0


def firsts(docs, least=0.8):
    """Smallest id of each group that pairs of enough similarity link."""
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, a), (j, b) in combinations(docs, 2):
        if jaccard(a, b) >= least:
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return {find(i) for i in root}


def near_copies():
    rng = random.Random(21)
    docs = []
    for _ in range(30):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.randint(60, 200))]
        for _ in range(rng.choice([1, 3, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, len(copy) // 40)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            docs.append(" ".join(copy))
    docs += ["", "", "One TWO", "one two", "three"]
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_near_copies_equal_all_pairs(table):
    docs = near_copies()
    kept = sorted(r.doc_id for r in simhash.keep_one_of_near_copies(table(*docs)).collect())
    assert kept == sorted(firsts(docs))


def test_stage_removes_near_copies(spark, table):
    import corpus_pipeline as P

    rng = random.Random(22)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(40):
        copy = list(base)
        copy[rng.randrange(20, 100)] = f"x{i}"  # about five of 116 shingles
        docs.append((i, " ".join(copy)))
    docs += [(50, " ".join(f"y{i}" for i in range(90))), (None, "no id"), (None, "no id")]
    stage = dict(P.STAGES)["simhash"]
    got = stage(spark, table(*docs), "")
    assert sorted((r.doc_id is None, r.doc_id) for r in got.collect()) == [(False, 0), (False, 50), (True, None)]
    assert got.columns == table(*docs).columns and stage(spark, table(*docs).where("false"), "").count() == 0


def test_stage_on_given_documents(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = {r.doc_id for r in dict(P.STAGES)["simhash"](spark, docs, "").select("doc_id").collect()}
    want = firsts([(r.doc_id, r.text or "") for r in docs.collect()])
    assert kept == want and not kept & {145, 177}  # copies of 6 and 1 at a similarity of 0.83


def test_lists_that_stay_apart_are_compared_whole(spark, table, monkeypatch):
    """A large group around the limit of similarity: most pairs are candidates, some are links."""
    from docalign.llm import near_copies

    rng = random.Random(8)
    base = [f"b{i}" for i in range(80)]
    docs = []
    for i in range(160):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 2, 3])):
            copy[rng.randrange(80)] = f"x{rng.randrange(40)}"
        docs.append((i, " ".join(copy)))
    monkeypatch.setattr(near_copies, "BLOCK_NODES", 16)
    kept = sorted(r.doc_id for r in simhash.keep_one_of_near_copies(table(*docs)).collect())
    assert kept == sorted(firsts(docs))


def test_links_between_blocks_are_all_pairs():
    from docalign.llm import near_copies

    rng = random.Random(9)
    texts = [" ".join(rng.choice("ab") + str(i) for i in range(12)) for _ in range(60)] + ["", "one"]
    nodes = [{"fp": i, "root": i, "found": near_copies.shingles(t.encode()).tobytes()} for i, t in enumerate(texts)]
    found = set(near_copies.block_links(nodes, nodes))
    wanted = {(i, j) for i, j in combinations(range(len(texts)), 2) if jaccard(texts[i], texts[j]) >= 0.8}
    assert found == wanted


def test_fingerprints_link_near_copies_without_bands(table):
    """Texts of linked or equal bits are candidates, and those that are near copies are linked."""
    from pyspark.sql import functions as F

    from docalign.llm import near_copies
    from docalign.llm.common import Stash

    docs = near_copies_of_few_bits()
    keyed = table(*docs).withColumn("row", F.col("doc_id"))
    stash = Stash(keyed.sparkSession, "test")
    rows = stash.save(near_copies.shingle_sets(keyed, ("row",), simhash.fingerprint))
    pairs = stash.save(simhash.fingerprint_pairs(rows, stash))
    bits = {r.fp: r.bits % 2**64 for r in rows.collect()}
    met = [(r.u, r.v) for r in pairs.collect()]
    assert met and all((bits[u] ^ bits[v]).bit_count() <= 2 for u, v in met)
    without = rows.withColumn("keys", F.array().cast("array<long>"))
    links = near_copies.near_links(without, keyed.select("row", "text"), pairs, stash).collect()
    text = {r.fp: docs[r.row][1] for r in rows.collect()}
    assert {(r.u, r.v) for r in links} == {(u, v) for u, v in met if jaccard(text[u], text[v]) >= 0.8}
    assert 0 < len(links) < len(met)


def near_copies_of_few_bits():
    rng = random.Random(23)
    docs = []
    for _ in range(6):
        base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        docs += [" ".join(base), " ".join([*base, "x"]), " ".join(["y", *base])]
    # The same bits from three words, but no near copies by five: one shingle of three.
    return list(enumerate([*docs, "one two three " * 30, "one two three one two"]))
