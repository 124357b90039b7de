"""The operators against plain versions, and on odd input."""

from __future__ import annotations

import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from docalign.llm import html_text, licenses, line_rules, mixing, simhash, suffix_dedup, token_counts, token_files, topk
from docalign.llm.bpe import Bpe, bpe_digests
from docalign.llm.common import Stash
from docalign.llm.induced import InducedSort
from docalign.llm.library_tokens import LibraryTokens

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "é" * 300), (6, "word " * 9000), (7, "same text here"), (7, "same text here"), (None, "no id at all")]


def clashing(frame):
    """The same rows with extra columns of names that operators use."""
    return frame.withColumns({n: F.lit(1) for n in ("row", "size", "key", "own", "host", "line", "fp", "start", "rank", "n", "at")})


# --- mixing -----------------------------------------------------------------------------


def test_mix_reaches_targets(table):
    rng = random.Random(1)
    docs = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "b", "b", "b", None])) for i in range(3000)]
    rows = mixing.mix_counts(table(*docs)).collect()
    assert len(rows) == 3000
    taken, target = {}, {}
    for r in rows:
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        target[r.source_size] = r.target
        assert r.taken <= 3 * r.size
    assert sum(target.values()) == pytest.approx(sum(len(d[1]) // 2 for d in docs))
    for k, t in target.items():
        assert t <= 3 * k and abs(taken[k] - t) <= 40
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix_counts(table(*docs, partitions=7)).collect()))


def test_mix_follows_the_schedule(table):
    docs = [(i, "w w w w", s) for i in range(2000) for s in ("a", "b")]
    plan = mixing.Curriculum(times=(0, 1), weights=({"a": 3, "b": 1}, {"a": 1, "b": 3}))
    order = [r.source for r in mixing.mix_documents(table(*docs), plan).collect()]
    assert len(order) == 4000
    # By time t, a has 3t - t^2 of its 2, so three quarters of the first words and a quarter of the last.
    assert 0.70 < order[:400].count("a") / 400 < 0.80
    assert 0.20 < order[-400:].count("a") / 400 < 0.30


def test_mix_on_odd_input(table):
    assert len(mixing.mix_counts(clashing(table(*ODD))).collect()) == len(ODD)
    out = mixing.mix_documents(clashing(table(*ODD)))
    assert out.columns == clashing(table(*ODD)).columns and out.count() > 0
    assert mixing.mix_counts(table(*ODD).where("false")).count() == 0


# --- top k -------------------------------------------------------------------------------


def plain_top(rows, k, is_query):
    good = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if v is not None and i is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, qv in good:
        if is_query(q):
            scores = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in good if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e15])
def test_top_k_is_exact(spark, scale):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * scale for _ in range(6)]) for i in range(300)]
    rows += [(i, [0.5 * scale] * 6) for i in range(300, 500)]  # a large group of equal vectors
    rows += [(500, None), (501, [float("nan")] * 6), (502, [None] * 6), (None, [1.0] * 6), (505, [float("inf")] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("key", F.lit(1))
    if scale > 1:
        frame = frame.where("vec_id < 60")
        rows = [r for r in rows if r[0] is not None and r[0] < 60]
    got = topk.top_k(frame, F.col("vec_id") % 20 == 0, 20, blocks=topk.Blocks(queries=8, vectors=64))
    want = plain_top(rows, 20, lambda q: q % 20 == 0)
    if scale > 1:
        most = 2**63 - 1
        want = [(q, None, i, max(-most - 1, min(most, s))) for q, n, i, s in want]
        assert len(got.collect()) == len(want)
    else:
        assert sorted(map(tuple, got.collect())) == want


def test_top_k_cells_give_what_reaches_the_cutoff(spark, monkeypatch):
    """Pairs that reach a share of the cutoff in one list only do not leave their cell."""
    saved = {}

    class Kept(topk.Stash):
        def save(self, frame, name="t"):
            saved[name] = super().save(frame, name)
            return saved[name]

    monkeypatch.setattr(topk, "Stash", Kept)
    rng = random.Random(31)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, F.col("vec_id") % 20 == 0, 3, blocks=topk.Blocks(queries=8, vectors=64))
    assert got.count() == 60
    # Of 8,000 pairs; 20 queries with three, the query itself and what phase 1 could not rule out.
    assert 80 <= saved["sufficient"].count() <= 250


def test_top_k_of_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0, 1.0]), (2, [])], "vec_id long, embedding array<double>")
    got = topk.top_k(frame, F.col("vec_id") == 0, 20).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 64 * 128), (0, 2, 2, 0)]
    assert topk.top_k(frame.where("false"), F.lit(True), 3).count() == 0


def test_top_k_broadcasts_nothing(spark, monkeypatch):
    """Blocks and chunks are copied for many cells: where small files made one side a broadcast, the driver held all copies."""
    plans, rng = [], random.Random(7)

    class Seen(topk.Stash):
        def save(self, frame, name="t"):
            plans.append(frame._jdf.queryExecution().executedPlan().toString())
            return super().save(frame, name)

    monkeypatch.setattr(topk, "Stash", Seen)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, F.col("vec_id") % 20 == 0, 3, blocks=topk.Blocks(queries=8, vectors=64))
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert not [p for p in plans if "Broadcast" in p or "CartesianProduct" in p]


@pytest.mark.parametrize("scale", [1, 1e5])
def test_top_k_of_many_tiles(spark, scale):
    """Several bands of query blocks and spans of chunks, many equal scores, components of two and four bytes."""
    rng = random.Random(8)
    rows = [(i, [round(rng.gauss(0, 1)) / 64 * scale for _ in range(5)]) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(frame, F.col("vec_id") % 20 == 0, 3, blocks=topk.Blocks(queries=8, vectors=128, held=1))
    assert sorted(map(tuple, got.collect())) == plain_top(rows, 3, lambda q: q % 20 == 0)


def test_top_k_leaders_are_those_of_all_scores():
    rng = np.random.default_rng(9)
    for most in (4, 10**6):
        score = rng.integers(-most, most, (7, 400))
        best, near = topk.Leaders(np.full(7, -np.inf), 5), topk.Leaders(np.full(7, -np.inf), 5)
        for at in range(0, 400, 100):
            part = score[:, at : at + 100]
            best.add(*[x.ravel() for x in (np.indices(part.shape)[0], np.indices(part.shape)[1] + at, part)])
            row, c = np.nonzero(topk._leading(part.astype(np.float32), near.floor, 5))
            near.add(row, c + at, part[row, c])
        best.settle()
        near.settle()
        want = np.lexsort((np.indices(score.shape)[1], -score))[:, :5]
        for row in range(7):
            order = np.lexsort((best.key, -best.score, best.row))
            assert best.key[order][best.row[order] == row].tolist() == want[row].tolist()
        assert best.floor.tolist() == near.floor.tolist() == np.sort(score)[:, -5].tolist()


# --- token files --------------------------------------------------------------------------


def test_values_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 3, 4, 1001):
        values = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        control, data = token_files.encode_values(values)
        back = token_files.decode_values(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
        assert (back == values).all()


def test_token_files_hold_the_library_ids(table, vocabulary, monkeypatch):
    import zlib

    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    docs = [(i, t) for i, (_, t) in enumerate(ODD)] + [(100 + i, f"text {i}  of <|endoftext|> \n\n x" * i) for i in range(30)]
    got = {r.doc_id: tuple(r)[1:] for r in token_files.token_file_digests(table(*docs), path).collect()}
    start, library = 0, Tokenizer.from_file(path)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert got[doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(token_files.token_file_digests(clashing(table(*ODD)), path).collect()) == len(ODD)
    assert token_files.token_file_digests(table(*ODD).where("false"), path).count() == 0


def test_pieces_are_safe_cuts(vocabulary):
    tokens = LibraryTokens(vocabulary("byte_bpe_50k.json"))
    rng, pool = random.Random(4), [*"ab 's't  \n\té½12_\x1c\xa0日😀#", "<|endoftext|>", "  ", " \n"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    want = [e.ids for e in tokens.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, tokens.kind).tolist() for b in tokens.encode(texts)] == want


def test_columns_are_encoded_as_by_the_library(vocabulary, monkeypatch):
    """Joined pieces, a memory that starts anew, nulls, zero bytes, and pieces that end in white space."""
    import pyarrow as pa

    from docalign.llm import library_tokens

    monkeypatch.setattr(library_tokens, "JOINED", 3)
    monkeypatch.setattr(library_tokens, "REMEMBERED", 20)
    tokens = LibraryTokens(vocabulary("byte_bpe_50k.json"))
    rng, pool = random.Random(9), ["word", "été", "日本", "x\n", "\u3000", "\x00", "a\tb", "", "12,", "z" * 300]
    texts = [None, "", " ", "end\n", *[" ".join(rng.choice(pool) for _ in range(rng.randint(0, 9))) for _ in range(300)]]
    for at in range(0, len(texts), 50):
        part = texts[at : at + 50]
        ids, lengths = tokens.encode_column(pa.array(part, pa.string()))
        want = [e.ids for e in tokens.tokenizer.encode_batch([t or "" for t in part], add_special_tokens=False)]
        assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert [len(x) for x in tokens.encode_column(pa.array([], pa.string()))] == [0, 0]


# --- suffix order ---------------------------------------------------------------------------


def test_induced_order_and_prefixes(monkeypatch):
    from docalign.llm import induced

    rng = random.Random(5)
    for spool, block in ((1 << 20, 1 << 20), (32, 7)):
        monkeypatch.setattr(induced, "SPOOL", spool)
        monkeypatch.setattr(induced, "BLOCK", block)
        for _ in range(150):
            text = bytes(rng.choice([0, 1, 97, 255][: rng.randint(1, 4)]) for _ in range(rng.randint(1, 150))) * rng.choice([1, 2])
            sort = InducedSort(np.frombuffer(text, dtype=np.uint8))
            got = [(int(a), int(c)) for at, lcp in sort.descending() for a, c in zip(at, lcp, strict=True)]
            sort.close()
            order = sorted(range(len(text)), key=lambda i: text[i:], reverse=True)
            assert [g[0] for g in got] == order
            for (a, _), (b, lcp) in zip(got, got[1:]):
                same = next((n for n in range(100) if text[a + n : a + n + 1] != text[b + n : b + n + 1] or b + n >= len(text)), 100)
                assert lcp == same


def repeated_documents():
    rng = random.Random(6)
    line = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared, long = line(90), [line(rng.randint(100, 400)) for _ in range(6)]
    docs = [line(rng.randint(0, 300)) for _ in range(60)]
    docs += [line(rng.randint(0, 80)) + rng.choice(long)[rng.randint(0, 60) :] + shared + line(rng.randint(0, 80)) for _ in range(150)]
    docs += [long[0]] * 20 + ["a" * 500, "ab" * 300, "a" * 90, "\0" * 150, "\0" * 130]
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_suffix_dedup_is_exact(table):
    docs = repeated_documents()
    want = brute.repeats([(i, t.encode()) for i, t in docs])
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.suffix_dedup(table(*docs), suffix_dedup.Sharding(2000)).collect()}
    assert got == {i: w[:4] for i, w in want.items()}
    left = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(clashing(table(*docs))).collect()}
    assert left == {i: w[4].decode("utf-8", "ignore") for i, w in want.items()}


def test_suffix_dedup_on_odd_input(table):
    rows = suffix_dedup.suffix_dedup(clashing(table(*ODD, (8, "é" * 300)))).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed))
    assert len(rows) == len(ODD) + 1 and by_id[8] == [(600, 600)]
    # A string of two-byte characters repeats itself two bytes on.
    assert by_id[5] == [(600, 598)] and by_id[7] == [(14, 0)] * 2 and by_id[1] == [(0, 0)]
    twice = suffix_dedup.suffix_dedup(table((1, "x" * 30 + "y" * 30 + "z" * 60), (1, "x" * 30 + "y" * 30 + "z" * 60))).collect()
    assert [r.n_removed for r in twice] == [0, 0]
    assert suffix_dedup.suffix_dedup(table(*ODD).where("false")).count() == 0


# --- BPE --------------------------------------------------------------------------------------


def test_bpe_equals_the_library(table, vocabulary):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    rng, pool = random.Random(7), [*"abX 's İıΑΣς ́é½Ⅷ12_\x1c\xa0日ﬁ😀#\n", "<|endoftext|>", "<|StartOfText|>", "the"]
    docs = [(i, "".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))) for i in range(3000)]
    docs += [(3000, None), (3001, ""), (3002, "a" * 3000), (3003, "ab" * 500 + "é" * 300)]
    got = {r.doc_id: r for r in bpe_digests(clashing(table(*docs)), path, with_ids=True).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        r = got[doc_id]
        assert (r.ids, r.n_tokens) == (ids, len(ids))
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe_digests(table(*ODD).where("false"), path).count() == 0


# --- token counts -------------------------------------------------------------------------------


def test_token_counts_stitch_blocks(spark, tmp_path):
    rng = random.Random(8)
    want = []
    for f in range(3):
        ids = [rng.choice([9, 1, 2, 3, 4, 5, 6]) for _ in range(rng.randint(0, 400))]
        np.array(ids, dtype="<u2").tofile(tmp_path / f"f{f}.bin")
        start = 0
        for n, i in enumerate(ids):
            if i == 9:
                want.append((f"f{f}.bin", start, n + 1 - start, True))
                start = n + 1
        if start < len(ids):
            want.append((f"f{f}.bin", start, len(ids) - start, False))
    for block in (7, 64, 1000):
        got = token_counts.count_tokens(spark, str(tmp_path), 9, block_ids=block).collect()
        assert sorted((r.name, r.start, r.n_tokens, r.ended) for r in got) == sorted(want)
        for name in {r.name for r in got}:
            places = sorted((r.start, r.doc_no) for r in got if r.name == name)
            assert [p[1] for p in places] == list(range(len(places)))


def test_token_counts_of_documents(table, vocabulary):
    path = vocabulary("word_bpe_49k.json")
    docs = [(i, t) for i, (_, t) in enumerate(ODD)] + [(50, "a <|endoftext|> b")]
    got = {r.doc_id: r.n_tokens for r in token_counts.document_token_counts(clashing(table(*docs)), path, 49407).collect()}
    bpe = Bpe(path)
    bpe.special_at = None
    assert got == {i: 1 + sum(map(len, bpe.learn(bpe.pieces(t or "")))) for i, t in docs}
    assert token_counts.document_token_counts(table(*ODD).where("false"), path, 49407).count() == 0


# --- pages -----------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>Title</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body>
<nav><ul><li><a href="/a">Home page of the site</a></li><li><a href="/b">About us</a></li></ul></nav>
<div class="sidebar-left"><p>Some words in a sidebar that nobody reads at all</p></div>{open}<h1>The &amp; head</h1>
<p>First   paragraph with&nbsp;<b>bold</b> words<br>and more of them, quite a lot.<p>Second paragraph, not closed, but long enough to count.
<aside>Read this instead, please do</aside><!-- a comment --><p>Third &lt;one&gt; with a <a href="x">link</a> inside of it.</p>{close}
<section id="comments"><p>I think that this article is very bad indeed</p></section><form><p>Write to us here now</p></form>
<footer><p>All rights reserved by somebody somewhere</p></footer></body></html>"""
TEXT = """The & head
First paragraph with bold words and more of them, quite a lot.
Second paragraph, not closed, but long enough to count.
Third <one> with a link inside of it."""


@pytest.mark.parametrize("opened,closed", [("<article>", "</article>"), ('<div class="content">', "</div>"), ("<main>", "</main>")])
def test_main_text(opened, closed):
    page = PAGE.replace("{open}", opened).replace("{close}", closed)
    labelled = [PAGE.replace("{open}", "<article>").replace("{close}", "</article>")] * 3
    for weights in (html_text.DEFAULT_WEIGHTS, html_text.fit_weights(labelled)):
        assert html_text.main_text(page, weights) == TEXT


def test_headers_and_marks():
    words = " ".join(["word"] * 12)
    page = f"""<body><header><p>Site name and claim</p></header><article><header class="article-header"><h1>Head</h1></header>
<p>{words}</p><ol class="commentlist"><li><p>{words}</p></ol></article><div id="siteFooter"><p>{words}</p></div></body>"""
    assert html_text.main_text(page, html_text.DEFAULT_WEIGHTS) == f"Head\n{words}"


def test_best_region_is_the_largest_sum():
    rng = random.Random(9)
    for _ in range(300):
        scores = [float(rng.randint(-4, 4)) for _ in range(rng.randint(0, 12))]
        a, b = html_text.best_region(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        assert sum(scores[a:b]) == max([0.0, *sums])


def test_pages_on_odd_input(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "<p>" * 500), (4, "u", "plain words only"), (5, "u", "<p>broken <b"), (5, "u", "<p>broken <b"), (None, "u", "<nav>x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("z"))
    got = html_text.extract_text(frame, html_text.labelled_weights(frame)).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [
        (0, "", 0), (1, "", 0), (2, "", 0), (3, "", 0), (4, "plain words only", 16), (5, "broken <b", 9), (5, "broken <b", 9),
    ]


# --- SimHash -----------------------------------------------------------------------------------------


def near_copies():
    rng = random.Random(10)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(100, 250))]
        for _ in range(rng.choice([1, 1, 4])):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy))
    return list(enumerate(docs + ["", "One TWO", "one two", None]))


def test_near_duplicates(table):
    docs = near_copies()
    prints = {i: brute.fingerprint((t or "").encode()) for i, t in docs}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(table(*docs)).collect()}
    want = brute.linked(prints)
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}
    assert len(set(want.values())) < len(docs)
    kept = [r.doc_id for r in simhash.keep_one_of_each(clashing(table(*docs))).collect()]
    assert sorted(kept) == sorted(set(want.values()))


@pytest.mark.parametrize("short", [256, 3, 1])
def test_links_of_dense_fingerprints(spark, monkeypatch, short):
    monkeypatch.setattr(simhash, "SHORT_LIST", short)
    rng = random.Random(11)
    centers = [rng.getrandbits(64) for _ in range(3)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centers for _ in range(60)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    stash = Stash(spark, "test")
    frame = stash.save(spark.createDataFrame([(p,) for p in signed], "fp long"))
    got = {(min(r), max(r)) for r in simhash.links(frame, stash).collect()}
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert got == want


def test_near_duplicates_on_odd_input(table):
    rows = simhash.near_duplicates(clashing(table(*ODD))).collect()
    assert len(rows) == len(ODD)
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert simhash.keep_one_of_each(table(*ODD)).count() == len({r.fingerprint for r in rows})
    assert simhash.near_duplicates(table(*ODD).where("false")).count() == 0


# --- quality rules -------------------------------------------------------------------------------------


def test_measures(table):
    text = "a b c d e f\n\nx #$ y\nx #$ y\na b c d e g é|"
    r = line_rules.line_rules(table((1, text))).first()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (19, 22, 5, 1, 10)
    assert r.base_failed and not r.kept


def test_common_lines_deplete(table):
    bar, rng = "Accept all cookies to go on reading this page", random.Random(12)
    own = lambda: " ".join(f"{rng.randrange(10**9)}" for _ in range(30))
    docs = [(i, f"{own()}\n {bar.upper()} ", "h") for i in range(60)]
    docs += [(100, f"{bar}\nshort and own", "h"), (101, f"{bar}\nshort and own", "other")]
    copy = f"{own()}\n{own()}"
    docs += [(200 + i, copy, "h") for i in range(80)]  # many copies do not make their text boilerplate
    kept = {r.doc_id for r in line_rules.line_rules(table(*docs)).where("kept").collect()}
    assert kept == {d[0] for d in docs} - {100}
    left = line_rules.keep_by_rules(clashing(table(*docs)))
    assert {r.doc_id for r in left.collect()} == kept and left.columns == clashing(table(*docs)).columns


def test_quality_rules_on_odd_input(table):
    rows = line_rules.line_rules(clashing(table(*ODD))).collect()
    assert len(rows) == len(ODD) and not any(r.kept for r in rows)
    assert line_rules.line_rules(table(*ODD).where("false")).count() == 0


# --- licenses --------------------------------------------------------------------------------------------


def test_license_scan(table):
    docs = [
        (1, "Under CC-BY, the GNU General\nPublic License and cc by."), (2, "Released under the MIT License."),
        (3, "This little work is licensed under the GNU General Public License, version 3."),
        (4, "Copyright (c) 2020 Jane Doe. All rights reserved."), (5, "mit licenses; apache licensed"), (6, "Licensed under CC BY-NC 4.0!"),
    ]
    got = {r.doc_id: r for r in licenses.license_scan(clashing(table(*docs, *[(10 + i, t) for i, (_, t) in enumerate(ODD)]))).collect()}
    one = got[1]
    assert (one.n_words, one.n_base, one.first_word, one.last_word, one.base_labels, one.score) == (11, 3, 1, 9, "cc-by,gpl", 0.5)
    assert (got[2].labels, got[2].base_labels, got[2].score) == ("mit,mit-notice", "mit", 1.0)
    assert got[3].labels == "gpl,gpl-3.0" and got[3].matches[0].first == 0
    assert got[4].labels == "all-rights-reserved" and got[4].base_labels == ""
    assert (got[5].n_base, got[5].labels, got[5].score, got[5].first_word) == (0, "", 0.0, None)
    assert got[6].labels == "cc-by,cc-by-nc-4.0"
    assert (got[10].n_words, got[10].labels) == (0, "") and got[15].n_words == 9000
    assert licenses.license_scan(table(*ODD).where("false")).count() == 0


def test_template_automaton():
    a = licenses.compile_template("t", "the [[very]] big {{0-2}} dog [[barks]]")
    match = lambda text: a.match(text.encode().split(), 0)
    assert match("the big dog") == 3 and match("the very big dog barks now") == 5
    assert match("the big x y dog") == 5 and match("the big x y z dog") is None
    assert match("the very very big dog") is None
    with pytest.raises(ValueError):
        licenses.compile_template("t", "[[only optional]]")


# --- queries and the pipeline ------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op1_mixing", "op2_topk", "op9_line_rules", "op10_licenses"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from docalign.llm import oracle, queries

    folder, con = "/root/testdata/sf0.001", duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    wanted = con.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in wanted.description]
    found = queries.queries()[name](spark, folder)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(wanted.fetchall())


def test_pipeline(spark):
    """Stages on their own input: near copies by all pairs, repeats by all windows, ids by the tokenizers library;
    the quality rules and the mix by the operators that are held against SQL above."""
    import corpus_pipeline as P
    from test_near_copies import firsts
    from tokenizers import Tokenizer

    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    frames, stash = [docs], Stash(spark, "test-pipeline")
    for _, stage in P.STAGES:
        frames.append(stash.save(stage(spark, frames[-1], path)))
    rows = [{r.doc_id: r for r in f.collect()} for f in frames]
    judged = {r.doc_id: r.kept for r in line_rules.line_rules(docs).collect()}
    assert set(rows[1]) == {i for i, kept in judged.items() if kept}
    assert set(rows[2]) == firsts([(i, r.text or "") for i, r in sorted(rows[1].items())])
    left = brute.repeats([(i, r.text.encode()) for i, r in rows[2].items()])
    assert {i: r.text for i, r in rows[3].items()} == {i: w[4].decode("utf-8", "ignore") for i, w in left.items()}
    counts = {r.doc_id: r.repeats for r in mixing.mix_counts(frames[3]).collect()}
    taken = [r.doc_id for r in frames[4].collect()]
    assert {i: taken.count(i) for i in counts} == counts
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    assert frames[5].count() == len(taken)
    for r in frames[5].collect():
        assert r.ids == library.encode(rows[4][r.doc_id].text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_pipeline_on_odd_tables(spark, table):
    """Nulls, empty and long texts, repeated rows, names that stages use themselves, and no rows at all."""
    import corpus_pipeline as P

    names = ("kept_row", "kept_id", "own", "own_id", "own_row", "row", "fp", "node", "root", "gone", "left", "_text", "at", "ids")
    long = " ".join(f"w{i * 7919 % 5000}" for i in range(20_000))
    many = table(*ODD, (20, long, None), (21, long + " end", None), (22, " ".join(f"v{i}" for i in range(50)), "t"))
    for docs in (many.withColumns({n: F.lit(1) for n in names}), many.where("false").withColumns({n: F.lit(1) for n in names})):
        columns = docs.columns
        stash = Stash(spark, "odd-pipeline")
        for name, stage in P.STAGES:
            docs = stash.save(stage(spark, docs, ""))
            if name != P.STAGES[-1][0]:
                assert docs.columns == columns
        assert {r.doc_id for r in docs.collect()} <= {20, 22}


def test_ids_of_any_batch(table, vocabulary, monkeypatch):
    """Ids do not depend on what a worker remembers; null texts have none."""
    from tokenizers import Tokenizer

    from docalign.llm import bpe

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    texts = ["Don't <|endoftext|> stop", None, "", "é ß 12 word " * 500, "x" * 3000, "one two"] * 3
    found = bpe.encode_ids(table(*enumerate(texts)), vocabulary("word_bpe_49k.json")).collect()
    assert {r.doc_id: r.ids for r in found} == {
        i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)
    }
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 0)
    memo = bpe._WorkerMemo(vocabulary("word_bpe_49k.json"))
    twice = [memo.ids([t.encode()])[0].tolist() for t in ("one two", "two one", "one two")]
    assert twice == [library.encode(t, add_special_tokens=False).ids for t in ("one two", "two one", "one two")]
