"""Common lines leave the texts of the documents that stay."""

from __future__ import annotations

import random

from docalign.llm import line_rules


def test_kept_documents_lose_common_lines(table):
    bar, rng = "Accept all cookies to go on reading this page", random.Random(31)
    own = lambda: " ".join(f"{rng.randrange(10**9)}" for _ in range(30))
    parts = {i: (own(), own()) for i in range(60)}
    docs = [(i, f"{a}\n {bar.upper()} \n\n  {b}\n{bar}", "h") for i, (a, b) in parts.items()]
    docs += [(100, f"{bar}\n{own()}\n", "other"), (101, f"{own()}\r\n\n x ", None)]
    got = {r.doc_id: r for r in line_rules.keep_by_rules(table(*docs)).collect()}
    assert set(got) == {d[0] for d in docs}
    for i, (a, b) in parts.items():
        assert got[i].text == f"{a}\n\n  {b}" and got[i].n_chars == len(got[i].text)
    for i, text, _ in docs[60:]:
        assert (got[i].text, got[i].n_chars) == (text, len(text))
