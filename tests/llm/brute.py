"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib


def repeats(rows, length=100):
    """{doc_id: (bytes, removed, spans, sha256, kept)} of (doc_id, bytes), ids distinct."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            window = text[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(text)) if gone[i] and not (i and gone[i - 1]))
        out[doc_id] = (len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def fingerprint(text):
    import xxhash

    words = text.lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def linked(prints, most=2):
    """{node: smallest node reachable} of {node: fingerprint}."""
    parent = {n: n for n in prints}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    nodes = sorted(prints)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}
