"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are runs of three words, edges runs of four; an edge's weight is how often its words
stand together. Only edges are counted in the texts, with a correction where a piece of text
ends: the last three words begin no edge and the last two begin no node. What a node weighs
is the flow of its edges plus the corrections, and pairs come from nodes in the same way.
Frequent edges that can only follow each other are then compacted to paths, and which phrase
lies in which longer one is read off the paths.

Counting, in tasks: texts become arrays of 64-bit word hashes. Pieces are cut at words that
are too rare for any phrase. Up to ``NUMBERED`` frequent words, every task gets their hashes
and writes their ranks, which are short; beyond, a bitmap of fixed size tells rare words (one
that it lets through costs time only) and blobs of grams hold their own dictionary of hashes.
Equal grams of a task are added up before they are dealt out by a hash of the whole gram, so
neither a frequent word nor a frequent pair makes a partition large. Three shuffles carry
edges, nodes and pairs.

A hash stands for one word of one language. That is checked: all words are counted by their
text too, and if two share a hash another seed is taken.

Defined cases: a null text counts as empty, a null language as ``und``; repeated rows count
each; a text of any length is cut at no place but those named; an empty table has no phrase;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docalign.llm.common import Stash, shuffle_partitions

LONGEST = 4
#: Bytes of text and words that a task holds at once (one longer text is taken whole).
SLICE = 2 << 20
WAITING = 500_000
#: Words of text for one partition of the counts.
PARTITION_WORDS = 1_000_000
#: Different words that a task holds before it passes their counts on.
VOCABULARY = 150_000
#: Most frequent words that are sent to every task, 8 bytes each; beyond that many, a bitmap.
NUMBERED = 4_000_000
#: The bitmap of frequent words has 2 to this power bits.
BITS = 24
COUNTS = "level int, bucket int, blob binary, gram array<long>, f long"

# Bytes between words, and bytes between pieces.
BLANK, STOP = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(BLANK)], _KIND[list(STOP)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- words of texts ------------------------------------------------------------------------------


def slices(texts: pa.Array, langs: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """Bytes, offsets and languages of texts, some at a time."""
    texts = texts.fill_null("")
    names = [n if n is not None else "und" for n in langs.to_pylist()]
    if not len(texts):
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, side="right")) - 1)
        yield data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at], names[at:end]
        at = end


class Hasher:
    """Word hashes of one seed."""

    def __init__(self, seed: int) -> None:
        import xxhash

        self.text_hash = lambda name, salt: np.uint64(xxhash.xxh64_intdigest(name.encode(), 4 * seed + salt))
        # Odd multipliers, so that no byte of a word is lost.
        self.base = [self.text_hash("base", salt) | np.uint64(1) for salt in (0, 1)]
        self.powers = [np.ones(1, dtype=np.uint64) for _ in self.base]

    def _power(self, salt: int, size: int) -> np.ndarray:
        if len(self.powers[salt]) < size:
            factors = np.full(2 * size, self.base[salt], dtype=np.uint64)
            factors[0] = 1
            self.powers[salt] = np.cumprod(factors, dtype=np.uint64)
        return self.powers[salt]

    def words(
        self, data: np.ndarray, offsets: np.ndarray, langs: list[str], twice: bool = False
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Start, end, text and piece of each word, and its hash (a second one on request)."""
        kind = _KIND[data]
        inside = kind == 0
        opens = np.zeros(len(data) + 1, dtype=bool)
        opens[offsets] = True
        before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        start = np.flatnonzero(inside & (~before | opens[:-1]))
        end = np.flatnonzero(inside & (~after | opens[1:])) + 1
        piece = np.cumsum((kind == 2) | opens[:-1])[start]
        text = np.searchsorted(offsets, start, side="right") - 1
        hashes = []
        if len(start):
            place = np.flatnonzero(inside)
            within = place - np.repeat(start, end - start)
            letters = _LOWER[data[place]].astype(np.uint64) + np.uint64(1)
            firsts = np.cumsum(end - start) - (end - start)
            longest = int((end - start).max())
            for salt in range(2 if twice else 1):
                of_lang = {n: self.text_hash(n, salt + 2) for n in set(langs)}
                lang = np.array([of_lang[n] for n in langs], dtype=np.uint64)
                hashes.append(_mixed(np.add.reduceat(letters * self._power(salt, longest)[within], firsts) + lang[text]))
        else:
            hashes = [np.empty(0, dtype=np.uint64)] * 2
        return start, end, text, piece, hashes


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


# --- word counts -------------------------------------------------------------------------------------


def word_counts(documents: DataFrame, seed: int) -> DataFrame:
    """``h, lang, word, n``. A hash of two words has two rows or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(seed)
        known: dict[int, list] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            items = [(h, lang, word.decode(), n) for h, (lang, word, _, n) in known.items()]
            for at in range(0, len(items), 10_000):
                yield _rows(items[at : at + 10_000], ["h", "lang", "word", "n"], [pa.int64(), pa.string(), pa.string(), pa.int64()])
            known.clear()

        for batch in batches:
            for data, offsets, langs in slices(batch.column(0), batch.column(1)):
                start, end, text, _, hashes = hasher.words(data, offsets, langs, twice=True)
                found, first, which, many = np.unique(hashes[0], return_index=True, return_inverse=True, return_counts=True)
                lower = _LOWER[data].tobytes()
                odd = np.flatnonzero(hashes[1] != hashes[1][first][which])
                clash = {int(h) for h in hashes[0][odd].view(np.int64)}
                for h, i, n in zip(found.view(np.int64).tolist(), first.tolist(), many.tolist()):
                    check = int(hashes[1][i])
                    entry = known.get(h)
                    if entry is None:
                        known[h] = [langs[text[i]], lower[start[i] : end[i]], check, n]
                    else:
                        entry[3] += n
                        if entry[2] != check:
                            clash.add(h)
                if clash:
                    yield _rows([(h, None, "", 0) for h in clash], ["h", "lang", "word", "n"], [pa.int64(), pa.string(), pa.string(), pa.int64()])
                if len(known) > VOCABULARY:
                    yield from rows()
        yield from rows()

    return documents.mapInArrow(count, "h long, lang string, word string, n long").groupBy("h", "lang", "word").agg(F.sum("n").alias("n"))


def _rows(items: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in items], k) for i, k in enumerate(kinds)], names)


def frequent_bits(words: DataFrame) -> np.ndarray:
    """One bit for each value of a hash's first bits that a word of ``words`` has; 2 MB, whatever their number."""
    top = F.shiftrightunsigned("h", 64 - BITS)
    parts = (
        words.select(F.shiftright(top, 15).alias("part"), (top % 32768).alias("bit"))
        .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    )
    out = np.zeros(1 << BITS, dtype=bool)
    for r in parts:
        out[r.part << 15 : (r.part + 1) << 15] = np.unpackbits(np.frombuffer(bytes(r.bits), dtype=np.uint8), bitorder="little")
    return out


class Vocabulary:
    """The frequent words as tasks see them: numbered by rank, or as hashes that pass a bitmap."""

    def __init__(self, often: DataFrame, numbered: int = NUMBERED) -> None:
        self.size = often.count() if numbered else 0
        if 0 < self.size <= numbered:
            self.hashes = often.orderBy(F.desc("n"), "h").select("h").toArrow().column(0).to_numpy().view(np.uint64)
            self.bits = None
        else:
            self.hashes, self.bits = None, np.packbits(frequent_bits(often))

    def __setstate__(self, state: dict) -> None:
        """In a worker: what looking up needs."""
        self.__dict__ = state
        if self.hashes is not None:
            self.order = np.argsort(self.hashes).astype(np.uint32)
            self.sorted = self.hashes[self.order]
        else:
            self.known = np.unpackbits(self.bits).astype(bool)

    def numbers(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the frequent words among hashes, and a number for each of them."""
        if self.hashes is None:
            kept = np.flatnonzero(self.known[h >> np.uint64(64 - BITS)])
            return kept, h[kept]
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        kept = np.flatnonzero(self.sorted[at] == h)
        return kept, self.order[at[kept]].astype(np.uint64)

    def words(self, numbers: np.ndarray) -> np.ndarray:
        """Hashes of numbers."""
        return (numbers if self.hashes is None else self.hashes[numbers.astype(np.int64)]).view(np.int64)


# --- grams and their counts ----------------------------------------------------------------------------


def add_up(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ``grams`` and the sum of their counts."""
    if not len(grams):
        return grams, counts
    key = np.zeros(len(grams), dtype=np.int64)
    size = 1
    for column in grams.T:
        found, which = np.unique(column, return_inverse=True)
        if size * len(found) >= 1 << 62:
            # Numbers of rows met so far: never more than there are rows.
            distinct, key = np.unique(key, return_inverse=True)
            size = len(distinct)
        key = key * len(found) + which
        size *= len(found)
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    return grams[order[starts]], np.add.reduceat(counts[order], starts)


def pack(grams: np.ndarray, counts: np.ndarray) -> bytes:
    """Grams and counts as bytes, column by column; large numbers through a dictionary of their own.

    Bytes of one weight stand together and the first column as differences, which compresses well.
    """
    n, k = grams.shape
    words = np.empty(0, dtype=np.uint64)
    if grams.max(initial=0) >= 1 << 24:
        words, which = np.unique(grams, return_inverse=True)
        grams = which.reshape(grams.shape)
    columns = np.ascontiguousarray(grams.T).astype(np.int64)
    columns[0, 1:] -= columns[0, :-1].copy()
    planes = columns.astype("<i4").view(np.uint8).reshape(k, n, 4).transpose(0, 2, 1)
    amount = "<u1" if counts.max(initial=0) < 1 << 8 else "<u8"
    body = words.tobytes() + planes.tobytes() + counts.astype(amount).tobytes()
    return struct.pack("<IIBBI", n, len(words), k, int(amount[-1]), len(body)) + pa.compress(body, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, d, k, amount, size = struct.unpack_from("<IIBBI", blob)
    body = pa.decompress(blob[struct.calcsize("<IIBBI") :], decompressed_size=size, codec="zstd", asbytes=True)
    words = np.frombuffer(body, dtype="<u8", count=d)
    planes = np.frombuffer(body, dtype=np.uint8, count=4 * n * k, offset=8 * d).reshape(k, 4, n).transpose(0, 2, 1)
    columns = np.ascontiguousarray(planes).view("<i4").reshape(k, n).astype(np.int64)
    columns[0] = np.cumsum(columns[0])
    counts = np.frombuffer(body, dtype=f"<u{amount}", count=n, offset=8 * d + 4 * n * k)
    return (words[columns] if d else columns.astype(np.uint64)).T, counts.astype(np.int64)


def _dealt(grams: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Rows of ``COUNTS`` with blobs: each distinct gram to the bucket of its hash."""
    grams, counts = add_up(grams, counts)
    h = np.zeros(len(grams), dtype=np.uint64)
    for column in grams.T:
        h = _mixed(h * np.uint64(0x100000001B3) + column)
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts) if len(order) else ():
        yield (grams.shape[1], int(bucket[part[0]]), pack(grams[part], counts[part]), None, None)


def _count_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[2] or b"") + 50
        if size > 8 << 20 or len(held) >= 10_000:
            yield _rows(held, ["level", "bucket", "blob", "gram", "f"], kinds)
            held, size = [], 0
    if held:
        yield _rows(held, ["level", "bucket", "blob", "gram", "f"], kinds)


def edge_rows(documents: DataFrame, seed: int, vocabulary: Broadcast, buckets: int) -> DataFrame:
    """Edges, and nodes and pairs at which runs end, as rows of ``COUNTS``."""

    def grams_of(hashes: np.ndarray, piece: np.ndarray) -> dict[int, np.ndarray]:
        kept, h = vocabulary.value.numbers(hashes)
        piece = piece[kept]
        # on[k][i]: the k + 1 words from i on are one run.
        joined = (kept[1:] == kept[:-1] + 1) & (piece[1:] == piece[:-1])
        on = [np.ones(len(h), dtype=bool)]
        for k in range(1, LONGEST):
            on.append(np.append(on[-1][: len(h) - k] & joined[k - 1 :], np.zeros(min(k, len(h)), dtype=bool))[: len(h)])
        found = {}
        for k in range(2, LONGEST + 1):
            # All edges; of shorter grams only those that no longer one begins with.
            at = np.flatnonzero(on[k - 1] if k == LONGEST else on[k - 1] & ~on[k])
            found[k] = np.stack([h[at + i] for i in range(k)], axis=1) if len(at) else np.empty((0, k), dtype=np.uint64)
        return found

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(seed)

        def rows() -> Iterator[tuple]:
            held: dict[int, list[np.ndarray]] = {k: [] for k in range(2, LONGEST + 1)}
            waiting = 0
            for batch in batches:
                for data, offsets, langs in slices(batch.column(0), batch.column(1)):
                    _, _, _, piece, hashes = hasher.words(data, offsets, langs)
                    for k, grams in grams_of(hashes[0], piece).items():
                        held[k].append(grams)
                    waiting += len(piece)
                    if waiting >= WAITING:
                        yield from flush(held)
                        waiting = 0
            yield from flush(held)

        yield from _count_batches(rows())

    def flush(held: dict[int, list[np.ndarray]]) -> Iterator[tuple]:
        for k, parts in held.items():
            if parts:
                grams = np.concatenate(parts)
                parts.clear()
                yield from _dealt(grams, np.ones(len(grams), dtype=np.int64), buckets)

    return documents.mapInArrow(work, COUNTS)


def level_counts(rows: DataFrame, level: int, least: int, vocabulary: Broadcast, buckets: int) -> DataFrame:
    """Adds up the grams of one length. Frequent ones come out as rows with ``gram`` and ``f``;
    of all, the flow goes on to the gram without its last word. Other rows pass."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _count_batches(counted(batches))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        grams, counts = np.empty((0, level), dtype=np.uint64), np.empty(0, dtype=np.int64)
        waiting, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != level:
                    yield row
                    continue
                waiting.append(unpack(row[2]))
                size += len(waiting[-1][1])
                if size >= WAITING:
                    grams, counts = add_up(np.concatenate([grams, *[w[0] for w in waiting]]), np.concatenate([counts, *[w[1] for w in waiting]]))
                    waiting, size = [], 0
        grams, counts = add_up(np.concatenate([grams, *[w[0] for w in waiting]]), np.concatenate([counts, *[w[1] for w in waiting]]))
        often = counts >= least
        for gram, f in zip(vocabulary.value.words(grams[often]).tolist(), counts[often].tolist()):
            yield (0, f % buckets, None, gram, f)
        if level > 2:
            yield from _dealt(grams[:, :-1], counts, buckets)

    return rows.repartition(buckets, "bucket").mapInArrow(work, COUNTS)


# --- the graph of frequent edges ----------------------------------------------------------------------------


def compact_paths(stash: Stash, frequent: DataFrame) -> DataFrame:
    """Paths of frequent edges that can only follow each other: ``words array<long>, f``.

    An edge goes on in one way if it, the node it leads to and the next edge weigh the same:
    then nothing else comes to the node, leaves it, or ends at it. Such edges find the first
    edge of their path by pointer doubling. A circle of them cannot be: its texts begin
    somewhere, and the node there weighs more than the edge that leads to it.
    """
    edges = frequent.where(F.size("gram") == LONGEST)
    nodes = frequent.where(F.size("gram") == LONGEST - 1).select(F.col("gram").alias("node"), "f")
    into = edges.select(F.slice("gram", 2, LONGEST - 1).alias("node"), "f", F.col("gram").alias("before"))
    out = edges.select(F.slice("gram", 1, LONGEST - 1).alias("node"), "f", F.col("gram").alias("edge"))
    links = into.join(nodes, ["node", "f"]).join(out, ["node", "f"]).select("edge", "before")
    pointers = edges.select(F.col("gram").alias("edge"), "f").join(links, "edge", "left").select(
        "edge", "f", F.coalesce("before", "edge").alias("first"), F.col("before").isNotNull().cast("long").alias("steps")
    )
    pointers = stash.save(pointers, "pointers")
    while True:
        ahead = pointers.select(F.col("edge").alias("first"), F.col("first").alias("onward"), F.col("steps").alias("more"))
        going = pointers.where("steps > 0").join(ahead, "first").where("more > 0")
        if going.isEmpty():
            break
        moved = pointers.join(ahead, "first").select("edge", "f", F.col("onward").alias("first"), (F.col("steps") + F.col("more")).alias("steps"))
        last, pointers = pointers, stash.save(moved, "pointers")
        stash.drop(last)
    later = F.transform(F.array_sort(F.collect_list(F.struct("steps", F.element_at("edge", -1).alias("word")))), lambda x: x["word"])
    return (
        pointers.groupBy("first").agg(later.alias("last"), F.any_value("f").alias("f"))
        .select(F.concat(F.slice("first", 1, LONGEST - 1), "last").alias("words"), "f")
    )


def _parts(words: Column, size: int) -> Column:
    """All runs of ``size`` words."""
    count = F.size(words) - size + 1
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.slice(words, i, size))).otherwise(F.array().cast("array<array<bigint>>"))


def heaviest_longer(paths: DataFrame, frequent: DataFrame) -> DataFrame:
    """``gram, longer``: the weight of the heaviest longer phrase a frequent pair or node lies in."""
    inside = [F.struct(_parts(F.col("words"), k).alias("grams")) for k in range(2, LONGEST)]
    in_edges = paths.select(F.explode(F.flatten(F.array(*[i["grams"] for i in inside]))).alias("gram"), "f")
    nodes = frequent.where((F.size("gram") > 2) & (F.size("gram") < LONGEST))
    in_nodes = nodes.select(F.explode(_parts(F.col("gram"), 2)).alias("gram"), "f")
    return in_edges.unionByName(in_nodes).groupBy("gram").agg(F.max("f").alias("longer"))


# --- collocations ------------------------------------------------------------------------------------------


class PhraseGraph:
    """Tables of one corpus: ``words`` (h, lang, word, n), ``frequent`` (gram, f) and ``paths`` (words, f)."""

    def __init__(self, documents: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, numbered: int = NUMBERED) -> None:
        spark = documents.sparkSession
        self.least = least
        self.stash = stash = Stash(spark, "phrases")
        texts = documents.select(F.col(text).cast("string"), F.col(lang).cast("string"))
        seed = 0
        while True:
            self.words = stash.save(word_counts(texts, seed), "words")
            if self.words.groupBy("h").count().where("count > 1").isEmpty():
                break
            stash.drop(self.words)
            seed += 1
        often = self.words.where(F.col("n") >= least)
        total = self.words.agg(F.sum("n")).first()[0] or 0
        buckets = max(shuffle_partitions(spark), -(-total // PARTITION_WORDS))
        vocabulary = spark.sparkContext.broadcast(Vocabulary(often, numbered))
        rows = edge_rows(texts, seed, vocabulary, buckets)
        for level in range(LONGEST, 1, -1):
            rows = level_counts(rows, level, least, vocabulary, buckets)
        self.frequent = stash.save(rows.select("gram", "f"), "frequent")
        self.paths = stash.save(compact_paths(stash, self.frequent), "paths")

    def cuts(self, share: int = 80) -> DataFrame:
        """Candidates that no longer one covers, with their lowest-scoring cut: ``gram, a, l, r, score``."""
        covered = heaviest_longer(self.paths, self.frequent)
        kept = (
            self.frequent.join(covered, "gram", "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("f")))
            .select("gram", F.col("f").alias("a"))
        )
        singles = self.words.where(F.col("n") >= self.least).select(F.array("h").alias("gram"), F.col("n").alias("f"))
        counts = self.frequent.unionByName(singles)
        cut = kept.select("gram", "a", F.explode(F.sequence(F.lit(1), F.size("gram") - 1)).alias("k")).select(
            "gram", "a", "k", F.slice("gram", F.lit(1), F.col("k")).alias("first"),
            F.slice("gram", F.col("k") + 1, F.size("gram") - F.col("k")).alias("rest"),
        )
        left = counts.select(F.col("gram").alias("first"), F.col("f").alias("l"))
        right = counts.select(F.col("gram").alias("rest"), F.col("f").alias("r"))
        score = F.expr("(cast(a as decimal(28, 0)) * 2000000) div (cast(l as decimal(28, 0)) + r)")
        return (
            cut.join(left, "first").join(right, "rest").withColumn("score", score)
            .groupBy("gram", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
            .select("gram", "a", "c.l", "c.r", "c.score")
        )

    def named(self, grams: DataFrame) -> DataFrame:
        """Rows with a ``gram`` (any number of words) with ``lang`` and ``phrase``, the words joined by a space."""
        word = self.words.where(F.col("n") >= self.least).select("h", "lang", "word")
        spelled = (
            grams.select("gram", F.posexplode("gram").alias("pos", "h")).join(word, "h")
            .groupBy("gram").agg(F.any_value("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("w"))
            .select("gram", "lang", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))
        )
        return grams.join(spelled, "gram")


def collocations(
    documents: DataFrame, least: int = 30, share: int = 80, most: int = 2000, numbered: int = NUMBERED
) -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    graph = PhraseGraph(documents, least=least, numbered=numbered)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    # The best of each of 64 parts of a language first, so that no task gets all its phrases.
    best = graph.named(graph.cuts(share)).withColumn("in_part", F.row_number().over(part)).where(F.col("in_part") <= most)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    totals = graph.words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
