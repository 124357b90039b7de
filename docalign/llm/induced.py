"""External induced suffix sorting with common prefixes.

Sorts the suffixes of a byte text that lies in a file. S* suffixes (smaller than their
right neighbor, which is smaller than their left one) are sorted first: their substrings
get names, the names form a shorter text, and that text's suffixes are sorted in turn.
From their order all other suffixes are induced in two scans. Each scan takes suffixes
from a priority queue in order and puts the suffix one to the left into the queue, with
the common prefix of neighbors carried along: one more than the least common prefix
between the two suffixes that caused them.

Queue keys come out in order of first byte, so the queue is one first-in-first-out spool
per byte. A spool keeps a bounded part in memory and the rest in a file, and the text is
mapped from its file; the reduced problem and the types are arrays in memory, so a shard
takes some 45 bytes for each of its bytes. All suffixes of a byte that are in the queue
are taken at once, as arrays.

Common prefixes are counted up to ``DEPTH``; the order of suffixes that share more is
still a full order of their bytes.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

DEPTH = 100
#: Entries that a spool keeps in memory before it writes them to its file.
SPOOL = 1 << 20
BLOCK = 1 << 20
ENTRY = np.dtype([("at", "<i8"), ("lcp", "u1")])


class Spool:
    """Entries first in, first out; all but a bounded part in a file."""

    def __init__(self, folder: str, name: str) -> None:
        self.path = os.path.join(folder, name)
        self.parts: list[np.ndarray] = []
        self.held = 0
        self.written = 0

    def put(self, at: np.ndarray, lcp: np.ndarray) -> None:
        part = np.empty(len(at), dtype=ENTRY)
        part["at"], part["lcp"] = at, lcp
        self.parts.append(part)
        self.held += len(part)
        if self.held > SPOOL:
            with open(self.path, "ab") as file:
                for p in self.parts:
                    p.tofile(file)
            self.written += self.held
            self.parts, self.held = [], 0

    def __len__(self) -> int:
        return self.written + self.held

    def blocks(self, backward: bool = False) -> Iterator[np.ndarray]:
        """Entries in order, or in reverse order."""
        held = np.concatenate(self.parts) if self.parts else np.empty(0, dtype=ENTRY)
        if backward and len(held):
            yield held[::-1]
        if self.written:
            stored = np.memmap(self.path, dtype=ENTRY, mode="r", shape=(self.written,))
            starts = range(0, self.written, BLOCK)
            for a in reversed(starts) if backward else starts:
                part = np.array(stored[a : a + BLOCK])
                yield part[::-1] if backward else part
        if not backward and len(held):
            yield held

    def take(self) -> Iterator[np.ndarray]:
        """Empty the spool and hand out what was in it."""
        taken = Spool.__new__(Spool)
        taken.path, taken.parts, taken.held, taken.written = f"{self.path}.taken", self.parts, self.held, self.written
        if self.written:
            os.replace(self.path, taken.path)
        self.parts, self.held, self.written = [], 0, 0
        yield from taken.blocks()
        if taken.written:
            os.unlink(taken.path)


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; filled block by block from the right."""
    n = len(text)
    smaller = np.zeros(n, dtype=bool)
    follow, kind = -1, False  # the byte and type of the suffix right of the block
    for a in reversed(range(0, n, BLOCK)):
        part = text[a : a + BLOCK].astype(np.int16)
        change = np.append(np.diff(part), follow - part[-1])
        last = np.where(change != 0, np.arange(len(part)), len(part))
        last = np.minimum.accumulate(last[::-1])[::-1]
        known = last < len(part)
        types = np.where(known, change[np.minimum(last, len(part) - 1)] > 0, kind)
        smaller[a : a + len(part)] = types
        follow, kind = int(part[0]), bool(types[0])
    return smaller


def _words(text: np.ndarray, at: np.ndarray, shift: int) -> np.ndarray:
    """Eight bytes from ``at + shift`` on as one number in text order; zeros behind the end."""
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(8):
        i = at + shift + k
        byte = np.where(i < len(text), text[np.minimum(i, len(text) - 1)], 0)
        out = (out << np.uint64(8)) | byte.astype(np.uint64)
    return out


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes at ``a`` and ``b`` share, up to DEPTH."""
    out = np.zeros(len(a), dtype=np.int64)
    open_ = np.arange(len(a))
    for shift in range(0, DEPTH, 8):
        if not len(open_):
            break
        x, y = a[open_], b[open_]
        differ = _words(text, x, shift) ^ _words(text, y, shift)
        equal = differ == 0
        out[open_[equal]] = shift + 8
        some = ~equal
        bits = np.floor(np.log2(np.maximum(differ[some].astype(np.float64), 1))).astype(np.int64)
        # The conversion may round up to the next power of two.
        bits -= (differ[some] >> np.minimum(bits, 63).astype(np.uint64)) == 0
        out[open_[some]] = shift + (63 - bits) // 8
        open_ = open_[equal]
    return np.minimum(np.minimum(out, DEPTH), len(text) - np.maximum(a, b)).astype(np.uint8)


def _names(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rank of each substring ``text[start:end]``; equal ones share a rank.

    A substring ends at the next S* suffix. Where a longer one goes on, it goes on with a
    suffix of the larger-left type, which is smaller: so the longer one comes first, and
    the rest of a word is filled with ones. The last substring ends with the text, which
    is smaller than anything that goes on: it is filled with zeros and comes first.
    """
    rank = np.zeros(len(starts), dtype=np.int64)
    active, shift = np.arange(len(starts)), 0
    while len(active):
        length = np.clip(ends[active] - starts[active] - shift, 0, 8)
        final = (active == len(starts) - 1) & (length < 8)
        keep = np.uint64(8) * (8 - length).astype(np.uint64)
        rest = np.where(length > 0, (np.uint64(1) << np.minimum(keep, np.uint64(63))) - np.uint64(1), np.uint64(2**64 - 1))
        word = _words(text, starts[active], shift)
        word = np.where(final, word & ~rest, word | rest)
        tie = np.where(final, -100, -length)
        order = np.lexsort((tie, word, rank[active]))
        r, w, m = rank[active][order], word[order], tie[order]
        fresh = np.append(True, (r[1:] != r[:-1]) | (w[1:] != w[:-1]) | (m[1:] != m[:-1]))
        first = np.append(True, r[1:] != r[:-1])
        place = np.arange(len(order))
        group = np.maximum.accumulate(np.where(first, place, 0))
        within = np.maximum.accumulate(np.where(fresh, place, 0))
        rank[active[order]] = r + within - group
        size = np.diff(np.append(np.nonzero(fresh)[0], len(order)))
        tied = np.repeat(size > 1, size) & (m == -8)
        active, shift = active[order[tied]], shift + 8
    return rank


def _reduced_order(names: np.ndarray) -> np.ndarray:
    """Suffix order of the reduced text: ranks of ever longer prefixes, for tied suffixes only."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    sorted_names = names[order]
    fresh = np.append(True, sorted_names[1:] != sorted_names[:-1])
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    step = 1
    while True:
        counts = np.diff(np.append(np.nonzero(fresh)[0], len(order)))
        tied = np.repeat(counts > 1, counts)
        order = order[tied]
        if not len(order):
            break
        second = rank[np.minimum(order + step, n)]
        by = np.lexsort((second, rank[order]))
        order = order[by]
        r, s = rank[order], second[by]
        fresh = np.append(True, (r[1:] != r[:-1]) | (s[1:] != s[:-1]))
        first = np.append(True, r[1:] != r[:-1])
        place = np.arange(len(order))
        group = np.maximum.accumulate(np.where(first, place, 0))
        within = np.maximum.accumulate(np.where(fresh, place, 0))
        rank[order] = r + within - group
        step *= 2
    result = np.empty(n, dtype=np.int64)
    result[rank[:n]] = np.arange(n)
    return result


class InducedSort:
    """Suffix order of ``text`` (bytes in a file or array), written to spools in ``folder``."""

    def __init__(self, text: np.ndarray, folder: str | None = None) -> None:
        self.text = text
        self.folder = tempfile.mkdtemp(prefix="suffixes-", dir=folder)
        self.small = suffix_types(text)

    def _spools(self, name: str) -> list[Spool]:
        return [Spool(self.folder, f"{name}-{c}") for c in range(256)]

    def _seeds(self) -> list[Spool]:
        """S* suffixes in order, by first byte, each with the common prefix with the one before."""
        seeds = self._spools("star")
        star = np.nonzero(self.small[1:] & ~self.small[:-1])[0] + 1
        if len(star):
            ends = np.minimum(np.append(star[1:] + 1, len(self.text)), len(self.text))
            order = star[_reduced_order(_names(self.text, star, ends))]
            lcp = np.zeros(len(order), dtype=np.uint8)
            for a in range(1, len(order), BLOCK):
                b = min(a + BLOCK, len(order))
                lcp[a:b] = common_prefix(self.text, order[a - 1 : b - 1], order[a:b])
            first = self.text[order]
            edges = np.searchsorted(first, np.arange(257))
            for c in range(256):
                a, b = edges[c], edges[c + 1]
                for i in range(a, b, BLOCK):
                    seeds[c].put(order[i : min(i + BLOCK, b)], lcp[i : min(i + BLOCK, b)])
        return seeds

    def _scan(self, seeds: list[Spool] | None, larger: list[Spool] | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """One inducing scan.

        With ``seeds``: first byte ascending, larger-type suffixes into ``larger_out``. With
        ``larger``: descending, smaller-type suffixes; hands out blocks of (places, common
        prefix with the suffix handed out before) over all suffixes.
        """
        up = seeds is not None
        queue = self._spools("up" if up else "down")
        gap = np.full(256, DEPTH, dtype=np.int64)  # least common prefix since the last entry of each byte
        last = np.full(256, -1, dtype=np.int64)  # last entry of each byte
        previous, joins = -1, True  # suffix scanned last in this byte's bucket
        text, small = self.text, self.small

        def push(at: np.ndarray, lcp: np.ndarray) -> None:
            """Queue the left neighbors of scanned suffixes that the scan is for."""
            have = at > 0
            left = np.where(have, at - 1, 0)
            byte = text[left].astype(np.int16)
            wanted = have & (~small[left] if up else small[left])
            keyed = np.where(wanted, byte, 256)
            order = np.argsort(keyed, kind="stable")
            counts = np.bincount(keyed, minlength=257)
            edges = np.append(0, np.cumsum(counts))
            lcp = lcp.astype(np.int64)
            running = np.minimum.accumulate(lcp)
            whole = int(running[-1])
            present = np.nonzero(counts[:256])[0]
            absent = np.ones(256, dtype=bool)
            absent[present] = False
            gap[absent] = np.minimum(gap[absent], whole)
            for d in present.tolist():
                found = order[edges[d] : edges[d + 1]]
                # Least common prefix from behind the entry before, up to the entry itself.
                least = np.minimum.reduceat(lcp[: found[-1] + 1], np.append(0, found[:-1] + 1))
                least[0] = min(int(running[found[0]]), int(gap[d]))
                common = np.minimum(least + 1, DEPTH)
                if last[d] < 0:
                    common[0] = 0
                queue[d].put(left[found], common)
                last[d] = left[found[-1]]
                rest = lcp[found[-1] + 1 :]
                gap[d] = int(rest.min()) if len(rest) else DEPTH

        def scanned(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Places and common prefixes of a block, the first one against what was scanned before it."""
            nonlocal previous, joins
            at, lcp = np.array(part["at"]), np.array(part["lcp"])
            if joins:
                lcp[0] = 0 if previous < 0 else int(common_prefix(text, np.array([previous]), at[:1])[0])
                joins = False
            previous = int(at[-1])
            push(at, lcp)
            return at, lcp

        if up:
            # The last suffix is larger than the empty one behind it, which comes first of all.
            queue[text[-1]].put(np.array([len(text) - 1]), np.array([0]))
            last[text[-1]] = len(text) - 1
            gap[text[-1]] = 0
        self.out = self._spools("larger") if up else None
        for c in range(256) if up else reversed(range(256)):
            gap[:] = 0 if previous >= 0 else gap
            previous = -1

            joins = True  # the next block follows one of another kind: its first common prefix is looked up
            while len(queue[c]):
                for block in queue[c].take():
                    if up:
                        self.out[c].put(block["at"], block["lcp"])
                        scanned(block)
                    else:
                        yield scanned(block)
            joins = True
            if up:
                for block in seeds[c].blocks():
                    scanned(block)
            else:
                for at, lcp in _backward(larger[c]):
                    part = np.empty(len(at), dtype=ENTRY)
                    part["at"], part["lcp"] = at, lcp
                    yield scanned(part)

    def descending(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes from the largest to the smallest, in blocks of places and the common
        prefix with the suffix before (the next larger one), counted up to DEPTH."""
        if not len(self.text):
            return
        for _ in self._scan(self._seeds(), None):
            pass
        yield from self._scan(None, self.out)

    def close(self) -> None:
        """Delete the spools."""
        for name in os.listdir(self.folder):
            os.unlink(os.path.join(self.folder, name))
        os.rmdir(self.folder)


def _backward(spool: Spool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Entries in reverse order, each with the common prefix with the entry behind it."""
    behind = DEPTH
    for block in spool.blocks(backward=True):
        lcp = np.append(behind, block["lcp"][:-1])
        behind = int(block["lcp"][-1])
        yield np.array(block["at"]), lcp.astype(np.uint8)
