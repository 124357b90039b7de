"""Language identification by rank-order profiles of n-grams.

A profile is the most frequent n-grams of a language in order. A document's own most
frequent n-grams are compared with each profile by the out-of-place distance: how many
places each n-gram stands away from its place in the profile, and the profile's length for
one that is not in it. The language of the least distance is the answer.

N-grams are one to three characters of words, words being runs of letters in lower case
with a space before and behind. Up to three code points fit into 63 bits, so an n-gram is
an exact number and numbers sort as texts do.

Defined cases: a null text, or one without a letter, gives ``UNKNOWN`` with score 0, as does
every text if nothing was learned. Ties of frequency go to the smaller n-gram, ties of
distance to the smaller language. A row with a null id is neither learned from nor held out.
Texts are counted in blocks, however long they are; repeated rows are judged alike; other
columns are ignored, whatever their names; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Length of the profiles of languages and documents.
PLACES = 400
#: Characters that are looked at together.
BLOCK = 1 << 20
SPACE = 32


# --- n-grams -----------------------------------------------------------------------------------


@lru_cache
def _letters() -> np.ndarray:
    """For each code point the letter it counts as, or the space."""
    table = np.full(0x110000, SPACE, dtype=np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _words(points: np.ndarray) -> np.ndarray:
    """Letters with one space between, before and behind words."""
    mapped = _letters()[points]
    blank = mapped == SPACE
    follows = np.empty(len(blank), dtype=bool)
    follows[:1] = True
    follows[1:] = blank[:-1]
    kept = mapped[~(blank & follows)]
    if len(kept) and kept[-1] == SPACE:
        kept = kept[:-1]
    return np.concatenate(([SPACE], kept, [SPACE])).astype(np.uint64)


def ngrams(words: np.ndarray) -> np.ndarray:
    """All n-grams of words in the form of ``_words``, as numbers, unsorted."""
    if len(words) < 3:
        return np.empty(0, dtype=np.uint64)
    high, middle = words << np.uint64(42), words << np.uint64(21)
    letter = words != SPACE
    two = high[:-1] | middle[1:]
    three = (two[:-1] | words[2:])[letter[1:-1]]
    return np.concatenate((high[letter], two, three))


def counted(grams: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, ascending, and how often each occurs."""
    if weights is None:
        grams = np.sort(grams)
        starts = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.empty(0, dtype=np.int64)
        return grams[starts], np.diff(np.append(starts, len(grams)))
    order = np.argsort(grams, kind="stable")
    grams, weights = grams[order], weights[order]
    starts = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.empty(0, dtype=np.int64)
    return grams[starts], np.add.reduceat(weights, starts) if len(starts) else weights


def _blocks(points: np.ndarray) -> Iterator[np.ndarray]:
    """Words of a text in pieces that no word crosses, unless it is longer than a block."""
    start = 0
    while start < len(points):
        end = min(start + BLOCK, len(points))
        if end < len(points):
            blank = np.flatnonzero(_letters()[points[start:end]] == SPACE)
            if len(blank):
                end = start + int(blank[-1]) + 1
        yield _words(points[start:end])
        start = end


def text_counts(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of one text and how often each occurs. A word longer than a block is cut."""
    if len(points) <= BLOCK:
        return counted(ngrams(_words(points)))
    grams, counts = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    for words in _blocks(points):
        more, n = counted(ngrams(words))
        grams, counts = counted(np.concatenate((grams, more)), np.concatenate((counts, n)))
    return grams, counts


def ranked(grams: np.ndarray, counts: np.ndarray, places: int) -> np.ndarray:
    """The most frequent n-grams in order; ties by n-gram, in which order they come."""
    if len(grams) > 4 * places:
        # Only n-grams at least as frequent as the last place can be in it.
        least = np.partition(counts, len(counts) - places)[len(counts) - places]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.argsort(-counts, kind="stable")[:places]]


def _texts(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Code points of each text."""
    for value in column:
        text = value.as_py()
        yield None if text is None else np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


# --- profiles ---------------------------------------------------------------------------------


def ngram_counts(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, ngram, n`` over all rows: counted in the tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        known: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        none = (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))

        def fold(name: str) -> None:
            grams, counts = counted(np.concatenate(held.pop(name)))
            old = known.get(name, none)
            known[name] = counted(np.concatenate((old[0], grams)), np.concatenate((old[1], counts)))

        def rows() -> Iterator[pa.RecordBatch]:
            for name in list(held):
                fold(name)
            for name, (grams, counts) in known.items():
                for at in range(0, len(grams), 10_000):
                    part = grams[at : at + 10_000].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(part), pa.string()), pa.array(part), pa.array(counts[at : at + 10_000])],
                        ["lang", "ngram", "n"],
                    )
            known.clear()

        waiting = 0
        for batch in batches:
            for name, points in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                for words in _blocks(points) if points is not None else ():
                    held.setdefault(name, []).append(ngrams(words))
                    waiting += len(words)
                    if waiting >= BLOCK:
                        for n in list(held):
                            fold(n)
                        waiting = 0
                        if sum(len(g) for g, _ in known.values()) > 4 * BLOCK:
                            yield from rows()
        yield from rows()

    return (
        labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(F.col("lang").isNotNull())
        .mapInArrow(count, "lang string, ngram long, n long").groupBy("lang", "ngram").agg(F.sum("n").alias("n"))
    )


def profiles(counts: DataFrame, places: int = PLACES) -> DataFrame:
    """``lang, place, ngram``: the first ``places`` of each language, from 0."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "ngram")
    return counts.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < places).drop("n")


class Profiles:
    """Profiles by n-gram: for each, the languages that have it, and where."""

    def __init__(self, rows: list[tuple[str, int, int]], places: int = PLACES) -> None:
        """``rows`` are (language, place, n-gram)."""
        self.langs = sorted({r[0] for r in rows}, key=lambda x: x.encode())
        number = {name: i for i, name in enumerate(self.langs)}
        grams = np.array([r[2] for r in rows], dtype=np.uint64)
        order = np.argsort(grams, kind="stable")
        self.places = places
        self.lang = np.array([number[r[0]] for r in rows], dtype=np.int64)[order]
        self.place = np.array([r[1] for r in rows], dtype=np.int64)[order]
        grams = grams[order]
        self.starts = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.empty(0, dtype=np.int64)
        self.grams = grams[self.starts]
        self.many = np.diff(np.append(self.starts, len(grams)))

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of ranked n-grams from each profile."""
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        place = np.flatnonzero(self.grams[at] == own)
        at = at[place]
        many = self.many[at]
        # All entries of the n-grams found, one after the other.
        entry = np.repeat(self.starts[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
        near = self.places - np.abs(self.place[entry] - np.repeat(place, many))
        return self.places * len(own) - np.bincount(self.lang[entry], weights=near, minlength=len(self.langs)).astype(np.int64)

    def predict(self, points: np.ndarray | None) -> tuple[str, float]:
        """Language and score: how much nearer the profile is than the second one, from 0 to 1."""
        if points is None or not self.langs:
            return UNKNOWN, 0.0
        own = ranked(*text_counts(points), self.places)
        if not len(own):
            return UNKNOWN, 0.0
        distance = self.distances(own)
        best = int(distance.argmin())
        second = int(np.delete(distance, best).min()) if len(distance) > 1 else self.places * len(own)
        return self.langs[best], (second - int(distance[best])) / second if second else 0.0


def predict_language(documents: DataFrame, learned: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """Columns ``keep`` with ``lang_pred`` and ``score``; only the text is looked at.

    ``learned`` are rows of ``profiles``: at most its number of places for each language, which
    every worker gets whole.
    """
    model = Profiles([(r.lang, r.place, r.ngram) for r in learned.collect()])
    needed = documents.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in needed.schema[:-1]) + ", lang_pred string, score double"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(p) for p in _texts(batch.column(len(keep)))]
            made = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*keep, "lang_pred", "score"])

    return needed.mapInArrow(predict, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from learning: a third of all ids, by CRC-32."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def predict_held_out(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of all documents, learned from those not held out."""
    learned = profiles(ngram_counts(documents.where(~held_out() & F.col("lang").isNotNull())))
    found = predict_language(documents, learned, ("doc_id",))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
