"""Token ids by the tokenizers library, each distinct piece of text encoded once.

A byte-level vocabulary never joins a word with a space behind it, so a text may be cut
before each space that stands behind another character. Pieces repeat; a worker
remembers their ids, up to a bound.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that one Python worker remembers; then it starts anew. About 150 bytes each.
REMEMBERED = 1_200_000
#: New pieces that go to the library as one text.
JOINED = 1_000
#: How a byte-level vocabulary writes a space.
SPACE = "\u0120"
#: White space as UTF-8.
_WHITE = tuple(c.encode() for c in map(chr, range(0x3001)) if c.isspace())
#: White space ahead of a space, where a cut at each space would change the pieces.
_ODD = "(?:" + "|".join(c.decode() for c in _WHITE) + ") |\\x00"
_CUT = re.compile(r"(?<=\S)(?= )")
#: Strings that the vocabulary's pre-tokenizer must be told by.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


@lru_cache(maxsize=2)
def worker_tokens(path: str) -> LibraryTokens:
    """The encoder of this Python worker: its tasks share what it remembers."""
    return LibraryTokens(path)


class LibraryTokens:
    """Ids of whole texts as bytes of little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        pre = spec["pre_tokenizer"] or {}
        self.cuts = spec["normalizer"] is None and all(pre.get(k) == v for k, v in _BYTE_LEVEL.items())
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        #: Pieces without the space that they begin with: where their ids begin in ``store``, and how many.
        self.known: dict[bytes, int] = {}
        self.store = np.zeros(1 << 20, dtype=self.kind)
        self.used = 0
        #: Whether a token begins with a space, as the first one of each piece does.
        self.begins = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, dtype=bool)
        self.begins[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith(SPACE)]] = True

    def pieces(self, text: str) -> list[str]:
        """A text cut where the pre-tokenizer cuts anyway; empty pieces are left out."""
        if not self.cuts or any(s in text for s in self.special):
            return [text]
        return [p for p in _CUT.split(text) if p]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        ids, lengths = self.encode_column(pa.array([t.encode() for t in texts], pa.large_binary()))
        ends = np.cumsum(lengths)
        return [ids[a:b].tobytes() for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of an Arrow column one after another, and how many each has; null is empty.

        Plain texts, whose spaces all stand behind another character, are cut at once and
        each distinct piece of the column is looked up once.
        """
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        odd = pc.match_substring_regex(texts, _ODD)
        for content in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, content))
        plain = np.zeros(len(texts), dtype=bool) if not self.cuts else ~odd.to_numpy(zero_copy_only=False)
        if plain.all():
            return self._encode_plain(texts)
        parts: list[np.ndarray] = [np.zeros(0, dtype=self.kind)] * len(texts)
        ids, lengths = self._encode_plain(texts.filter(pa.array(plain)))
        ends = np.cumsum(lengths)
        for i, a, b in zip(np.nonzero(plain)[0].tolist(), ends - lengths, ends, strict=True):
            parts[i] = ids[a:b]
        for i in np.nonzero(~plain)[0].tolist():
            found = self._library(self.pieces(texts[i].as_py().decode("utf-8", "replace")))
            parts[i] = np.concatenate([parts[i], *found])
        return np.concatenate([np.zeros(0, dtype=self.kind), *parts]), np.array([len(p) for p in parts], dtype=np.int64)

    def _encode_plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # The first piece of a text, which has no space ahead, is told apart by a zero byte.
        zero, nothing = pa.scalar(b"\0", pa.large_binary()), pa.scalar(b"", pa.large_binary())
        cut = pc.split_pattern(pc.binary_join_element_wise(zero, texts, nothing), " ")
        coded = cut.flatten().dictionary_encode()
        spans = self._spans(coded.dictionary.to_pylist())
        at = coded.indices.to_numpy()
        begin, size = spans[0][at], spans[1][at]
        ends = np.cumsum(size)
        # The place of each id in the store: the begin of its piece and what has passed of it.
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)
        pieces = np.diff(cut.offsets.to_numpy())
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(pieces)])]
        return self.store[places], np.diff(upto)

    def _spans(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of pieces begin in the store, and how many they are."""
        if len(self.known) > REMEMBERED:
            self.known, self.store, self.used = {}, np.zeros(1 << 20, dtype=self.kind), 0
        known = self.known
        found = list(map(known.get, pieces))
        new = [p for p, f in zip(pieces, found, strict=True) if f is None]
        if new:
            # Pieces that end in white space, and first ones, are no safe neighbours; the rest go in long texts.
            alone = [p for p in new if p[:1] == b"\0" or not p or p.endswith(_WHITE)]
            left = set(alone)
            joined = [p for p in new if p not in left]
            texts = [b" " + b" ".join(joined[k : k + JOINED]) for k in range(0, len(joined), JOINED)]
            made = self._library([t.decode("utf-8", "replace") for t in texts])
            self._remember(joined, made, np.nonzero(self.begins[np.concatenate(made)])[0] if made else np.zeros(0, np.int64))
            made = self._library([(p[1:] if p[:1] == b"\0" else b" " + p).decode("utf-8", "replace") for p in alone])
            sizes = np.array([len(m) for m in made], dtype=np.int64)
            self._remember(alone, made, np.cumsum(sizes) - sizes)
            found = list(map(known.__getitem__, pieces))
        packed = np.array(found, dtype=np.int64)
        return packed >> 31, packed & (1 << 31) - 1

    def _remember(self, pieces: list[bytes], made: list[np.ndarray], begins: np.ndarray) -> None:
        """Keep the ids of pieces, which begin at ``begins`` of all that was made."""
        size = sum(map(len, made))
        while self.used + size > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        if size:
            self.store[self.used : self.used + size] = np.concatenate(made)
        packed = self.used + begins << 31 | np.diff(np.append(begins, size))
        self.known.update(zip(pieces, packed.tolist(), strict=True))
        self.used += size

    def _library(self, pieces: list[str]) -> list[np.ndarray]:
        made = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(m.ids, dtype=self.kind) for m in made]
