"""BPE encoding and decoding by contiguous rank arrays.

Texts are cut into words as the vocabulary file says; each word not met before is
merged on arrays: one row per word holds the tokens between its part boundaries and the
ranks of adjacent parts. The least rank of each row is looked for by a scan, the boundary
is deleted by moving the rest of the row up, and the two ranks next to it are refreshed.
All words of a batch do this at once, so a step costs a few array operations.

Defined cases: a null text counts as empty, with no tokens and an empty decoded text;
null ids, repeated rows and extra columns are passed through; an empty table gives none.
Words longer than ``SHORT`` bytes (a scan per merge would be quadratic) take a heap of
ranks over the same boundaries; results are equal.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docalign.llm.common import as_bytes

#: Longest word, in bytes, that is merged by scans.
SHORT = 64
#: Words that one Python worker remembers; then it starts anew. 200 to 300 bytes each.
REMEMBERED = 400_000
NONE = np.int64(1 << 40)


def byte_characters() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    stands = {b: chr(b) for b in plain}
    spare = (b for b in range(256) if b not in stands)
    stands |= {b: chr(256 + k) for k, b in enumerate(spare)}
    return [stands[b] for b in range(256)]


def _class(test) -> str:
    """Character class of all code points that pass a test, as ranges."""
    ranges, start = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and not 0xD800 <= c < 0xE000 and test(chr(c))
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            ranges.append((start, c - 1))
            start = None
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in ranges)


@lru_cache
def _odd_characters() -> re.Pattern:
    """Characters on which Python's classes differ from letters, numbers and white space by property."""
    odd = lambda c: unicodedata.category(c) in ("Nl", "No") or "\x1c" <= c <= "\x1f"
    return re.compile(f"[{_class(odd)}]")


class WordSplitter:
    """Normalization and word pattern of the vocabulary file."""

    #: The word pattern of the vocabulary file, and the same in Python's classes.
    BY_PROPERTY = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    BY_CLASS = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+"

    def __init__(self, spec: dict) -> None:
        import regex

        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if split != self.BY_PROPERTY or [n["type"] for n in spec["normalizer"]["normalizers"]] != [
            "NFC", "Replace", "Lowercase",
        ]:
            raise ValueError("the vocabulary file asks for another normalization or word pattern")
        self.exact = regex.compile(self.BY_PROPERTY)
        self.fast = re.compile(self.BY_CLASS)
        self.odd = _odd_characters()

    def chunks(self, text: str) -> list[str]:
        """Normalized text, cut at white space; no word crosses it."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # Lower case code point by code point: Python's lower() also looks at the end of a word.
            text = text.lower() if "Σ" not in text else "".join(map(str.lower, text))
        else:
            text = text.lower()
        # Python also splits at these four separators, which are no white space by property.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.exact.findall(text)
        return text.split()

    def words(self, chunk: str) -> list[str]:
        return (self.exact if self.odd.search(chunk) else self.fast).findall(chunk)


class RankMerger:
    """Merges of a vocabulary on rows of parts."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = max(self.vocab.values()) + 1
        keys = np.array([self.vocab[a] * self.size + self.vocab[b] for a, b in merges], dtype=np.int64)
        made = np.array([self.vocab[a + b] for a, b in merges], dtype=np.int64)
        rank = np.arange(len(keys), dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        # A pair listed twice keeps its last rank, as a table filled in order does.
        keys, made, rank = keys[order], made[order], rank[order]
        last = np.append(keys[1:] != keys[:-1], True)
        self.keys, self.made, self.rank = keys[last], made[last], rank[last]
        self.pairs = dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.made.tolist())))
        stands = byte_characters()
        self.byte_id = np.array([self.vocab[c] for c in stands], dtype=np.int64)
        self.last_id = np.array([self.vocab[c + self.end] for c in stands], dtype=np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each adjacent pair; rank ``NONE`` where no merge exists (or no part, id -1)."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.rank[at], NONE), np.where(found, self.made[at], -1)

    def merge_rows(self, parts: np.ndarray) -> np.ndarray:
        """Merge rows of part ids (-1 behind a row's end) until no adjacent pair has a rank."""
        n, width = parts.shape
        done = np.full((n, width), -1, dtype=np.int64)
        alive = np.arange(n)
        parts = parts.copy()
        rank, made = np.full((n, width), NONE), np.full((n, width), -1, dtype=np.int64)
        rank[:, :-1], made[:, :-1] = self.ranks(parts[:, :-1], parts[:, 1:])
        column = np.arange(width)
        while len(alive):
            least = rank.argmin(axis=1)
            rows = np.arange(len(alive))
            going = rank[rows, least] < NONE
            if not going.all():
                done[alive[~going]] = parts[~going]
                alive, parts, rank, made, least = alive[going], parts[going], rank[going], made[going], least[going]
                rows = np.arange(len(alive))
                if not len(alive):
                    break
            parts[rows, least] = made[rows, least]
            # Delete the boundary behind the merged part: all later parts and ranks move up by one.
            take = np.minimum(column + (column[None, :] > least[:, None]), width - 1)
            parts, rank, made = (np.take_along_axis(x, take, axis=1) for x in (parts, rank, made))
            parts[:, -1], rank[:, -1], made[:, -1] = -1, NONE, -1
            after = np.minimum(least + 1, width - 1)
            right = np.where(least + 1 < width, parts[rows, after], -1)
            rank[rows, least], made[rows, least] = self.ranks(parts[rows, least], right)
            before = np.maximum(least - 1, 0)
            inner = least > 0
            r, m = self.ranks(parts[rows, before], parts[rows, least])
            rank[rows[inner], before[inner]], made[rows[inner], before[inner]] = r[inner], m[inner]
        return done

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges on one long row, the least rank from a heap."""
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = []

        def look(i: int) -> None:
            if i >= 0 and after[i] < len(parts):
                pair = self.pairs.get(parts[i] * self.size + parts[after[i]])
                if pair:
                    heapq.heappush(heap, (pair[0], i, parts[i], parts[after[i]], pair[1]))

        for i in range(len(parts)):
            look(i)
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= len(parts) or parts[j] != right:
                continue
            parts[i], parts[j] = made, -1
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            look(before[i])
            look(i)
        return [p for p in parts if p >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word."""
        out: list[list[int] | None] = [None] * len(words)
        by_width: dict[int, list[int]] = {}
        raw = [w.encode() for w in words]
        for i, b in enumerate(raw):
            if len(b) > SHORT:
                out[i] = self.merge_long([*self.byte_id[list(b[:-1])].tolist(), int(self.last_id[b[-1]])])
            else:
                by_width.setdefault(max(2, len(b)), []).append(i)
        for width, rows in by_width.items():
            parts = np.full((len(rows), width), -1, dtype=np.int64)
            flat = np.frombuffer(b"".join(raw[i].ljust(width, b"\0") for i in rows), dtype=np.uint8)
            flat = flat.reshape(len(rows), width)
            lengths = np.array([len(raw[i]) for i in rows])
            inside = np.arange(width)[None, :] < lengths[:, None]
            parts[inside] = self.byte_id[flat[inside]]
            at = np.arange(len(rows))
            parts[at, lengths - 1] = self.last_id[flat[at, lengths - 1]]
            for i, row in zip(rows, self.merge_rows(parts).tolist(), strict=True):
                out[i] = [p for p in row if p >= 0]
        return out


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["decoder"] is not None:
            raise ValueError("the vocabulary file asks for another model or decoder")
        self.splitter = WordSplitter(spec)
        self.merger = RankMerger(spec)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.token = {i: t for t, i in self.merger.vocab.items()} | {i: t for t, i in self.special.items()}

    def pieces(self, text: str) -> list[str]:
        """Chunks of a text; a special token, where its string stands in the text, behind a space."""
        if self.special_at is None or "<|" not in text:
            return self.splitter.chunks(text)
        found = []
        for part in self.special_at.split(text):
            found += [" " + part] if part in self.special else self.splitter.chunks(part)
        return found

    def learn(self, chunks: list[str]) -> list[list[int]]:
        """Token ids of each chunk."""
        split = [() if c[0] == " " else self.splitter.words(c) for c in chunks]
        distinct = list(dict.fromkeys(w for words in split for w in words))
        ids: dict[str, list[int]] = {}
        for i in range(0, len(distinct), 20_000):
            part = distinct[i : i + 20_000]
            ids.update(zip(part, self.merger.encode_words(part), strict=True))
        return [
            [self.special[c[1:]]] if c[0] == " " else [i for w in words for i in ids[w]]
            for c, words in zip(chunks, split, strict=True)
        ]

    def decode(self, ids: list[int]) -> str:
        """The tokens' strings with a space between; without a decoder in the file nothing else is done."""
        return " ".join(map(self.token.__getitem__, ids))


def bpe_digests(
    documents: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False
) -> DataFrame:
    """For each row its ``keep`` columns, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; the ids on request.

    ``vocabulary`` is the path of a vocabulary file that every executor can read.
    ``ids_sha256`` is the hash of the decimal ids joined by a space, ``decoded_sha256`` that
    of the decoded text. One pass without a shuffle.
    """
    needed = documents.select(*keep, text)
    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    schema = T.StructType([needed.schema[c] for c in keep] + fields)

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = Bpe(vocabulary), {}
        for batch in batches:
            split = [bpe.pieces(t.decode("utf-8", "replace")) for t in as_bytes(batch.column(len(keep)))]
            for at in range(0, len(split), 256):
                yield encode_rows(bpe, known, batch.slice(at, 256), split[at : at + 256])

    def encode_rows(bpe: Bpe, known: dict, batch: pa.RecordBatch, split: list[list[str]]) -> pa.RecordBatch:
        new = set().union(*split).difference(known)
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = set().union(*split)
        new = list(new)
        for chunk, ids in zip(new, bpe.learn(new), strict=True):
            known[chunk] = (len(ids), " ".join(map(str, ids)), bpe.decode(ids), ids if with_ids else None)
        columns: list[list] = [[], [], [], []]
        for chunks in split:
            # A chunk always has a token: every byte has one.
            found = list(map(known.__getitem__, chunks))
            columns[0].append(sum([f[0] for f in found]))
            columns[1].append(hashlib.sha256(" ".join([f[1] for f in found]).encode()).hexdigest())
            columns[2].append(hashlib.sha256(" ".join([f[2] for f in found]).encode()).hexdigest())
            if with_ids:
                columns[3].append([i for f in found for i in f[3]])
        made = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())]
        made += [pa.array(columns[3], pa.list_(pa.int32()))] if with_ids else []
        return pa.RecordBatch.from_arrays(
            [batch.column(i) for i in range(len(keep))] + made, names=[*keep, *[f.name for f in fields]]
        )

    return needed.mapInArrow(encode_batches, schema)


#: Bytes of chunks and ids that one Python worker remembers for ``encode_ids``, and of text in one step.
REMEMBERED_BYTES = 48 << 20
STEP = 1 << 20


class _WorkerMemo:
    """The encoder of a Python worker and the packed ids of chunks met before, shared by its tasks."""

    def __init__(self, vocabulary: str) -> None:
        self.bpe = Bpe(vocabulary)
        self.known: dict[str, bytes] = {}
        self.size = 0

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, one after the other, and where each begins."""
        split = [self.bpe.pieces(t.decode("utf-8", "replace")) for t in texts]
        if self.size > REMEMBERED_BYTES:
            self.known.clear()
            self.size = 0
        new = list(set().union(*split).difference(self.known))
        for chunk, found in zip(new, self.bpe.learn(new), strict=True):
            packed = np.array(found, dtype=np.int32).tobytes()
            self.known[chunk] = packed
            # Two objects and a slot of the table cost about 150 bytes beside what they hold.
            self.size += 150 + 4 * len(chunk) + len(packed)
        joined = [b"".join(map(self.known.__getitem__, chunks)) for chunks in split]
        starts = np.cumsum([0, *[len(j) // 4 for j in joined]], dtype=np.int32)
        return np.frombuffer(b"".join(joined), dtype=np.int32), starts


@lru_cache(maxsize=1)
def _worker_memo(vocabulary: str) -> _WorkerMemo:
    return _WorkerMemo(vocabulary)


def encode_ids(documents: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """For each row its ``keep`` columns, ``n_tokens`` and ``ids``, the token ids of the whole text.

    A worker holds texts of about ``STEP`` bytes at a time (one longer text is taken whole) and
    at most ``REMEMBERED_BYTES`` of chunks met before, whatever the batches hold.
    """
    needed = documents.select(*keep, F.col(text).alias("_text"))
    schema = T.StructType(
        [*needed.schema.fields[:-1], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _worker_memo(vocabulary)
        for batch in batches:
            held, size, start = [], 0, 0
            for at, t in enumerate(as_bytes(batch.column(len(keep)))):
                held.append(t)
                size += len(t)
                if size >= STEP or at + 1 == batch.num_rows:
                    ids, starts = memo.ids(held)
                    made = [pa.array(np.diff(starts).astype(np.int64)), pa.ListArray.from_arrays(pa.array(starts), pa.array(ids))]
                    columns = [batch.column(i).slice(start, len(held)) for i in range(len(keep))]
                    yield pa.RecordBatch.from_arrays([*columns, *made], names=[*keep, "n_tokens", "ids"])
                    held, size, start = [], 0, at + 1

    return needed.mapInArrow(encode_batches, schema)
