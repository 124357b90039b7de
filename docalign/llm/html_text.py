"""Main text of web pages as a maximum-scoring subsequence.

A page is a sequence of tags and words. Each has a score, the logarithm of how much more
often it stands inside the main text than outside, on labelled pages: words are positive
and tags mostly negative. A linear scan finds the contiguous part with the largest sum.
Elements that are boilerplate by name or class (navigation, adverts, forms, comments) are
left out of the sequence; each counts as one token that closes a region.

Defined cases: a null page has no text; a page without words has none; of parts with equal
sums the first and longest is taken; broken markup is read as it comes: an end tag closes
the innermost open element of its name, if there is one; text in an element that is never
closed belongs to it only where it ends with its parent. Null ids, repeated rows and
extra columns are allowed; pages of any length are read whole, in linear time.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docalign.llm.common import as_bytes

#: Elements that hold no text to read.
HIDDEN = frozenset("script style noscript template iframe object svg math canvas audio video head title textarea select".split())
#: Elements that are no part of an article.
ASIDE = frozenset("nav aside footer form button menu dialog label input option fieldset".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand within a line.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: Elements that end where another one of the same kind begins.
CLOSED_BY = {
    "p": frozenset(
        "p div ul ol dl table article section header footer nav aside main h1 h2 h3 h4 h5 h6 pre blockquote form hr figure "
        "address".split()
    ),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
#: Words in a class, id or role that mark what is no part of an article.
MARKS = frozenset(
    "ad ads adv banner masthead consent notice notices alert modal overlay signup login reply replies respond discussion social "
    "widget widgets pager skip toolbar topbar copyright disclaimer tags search complementary contentinfo form menu nav "
    "header".split()
)
#: The same by beginning or end of the word: class names join words.
MARKED = re.compile(
    r"(?:comment|advert|adsby|sidebar|nav(?:bar|igation)|cookie|footer|newsletter|breadcrumb|sponsor|promo|subscri|shar(?:e|ing)"
    r"|related|recommend|paginat|disqus|popup).*|.*(?:nav|menu|sidebar|footer|comments?|banner|popup)"
)
#: Elements that a mark in the class does not turn into boilerplate: they hold the page or article.
KEPT = frozenset("html body article main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<slash>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?P<self>/?)>",
    re.S,
)
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDING = re.compile(r"""\s(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_PARTS = re.compile(r"[a-z]+")

#: A boilerplate element as a token.
BREAK = "#aside"
WORD = "#word"


def boilerplate(tag: str, rest: str, in_article: bool = False) -> bool:
    """Whether an element is no part of an article. A header inside an article is its own, with its title."""
    if tag in ASIDE or tag == "header" and not in_article:
        return True
    if tag in KEPT or not rest:
        return False
    if _HIDING.search(rest):
        return True
    parts = [part for value in _MARKED.findall(rest) for part in _PARTS.findall(value.lower())]
    return any((p in MARKS or MARKED.fullmatch(p)) and not (in_article and p == "header") for p in parts)


def tokens(page: str, every: bool = False) -> Iterator[tuple[str, str]]:
    """Pairs of kind and text: ``<tag`` and ``</tag`` for tags, ``WORD`` for a run of text, ``BREAK``
    for a boilerplate element. Text in hidden elements is left out, and that in boilerplate
    elements unless ``every`` asks for it."""
    stack: list[tuple[str, bool]] = []  # open elements; True if they leave text out
    out = 0  # open elements that leave text out
    at = 0
    end = len(page)
    lower: str | None = None
    while at < end:
        found = _TOKEN.search(page, at)
        stop = found.start() if found else end
        if stop > at and not out:
            yield WORD, page[at:stop]
        if not found:
            return
        at = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if found["slash"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    out -= sum(gone for _, gone in stack[k:])
                    del stack[k:]
                    break
            else:
                if out:
                    continue
            if not out:
                yield f"</{tag}", ""
            continue
        while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
            out -= stack.pop()[1]
        if tag in ("script", "style", "textarea", "title"):
            # Their content is no markup, up to their end tag.
            lower = page.lower() if lower is None else lower
            close = (lower if len(lower) == end else page).find(f"</{tag}", at)
            after = page.find(">", close) if close >= 0 else -1
            at = after + 1 if after >= 0 else end
            continue
        if tag in VOID or found["self"]:
            if not out:
                yield f"<{tag}", ""
            continue
        in_article = any(t in ("article", "main") for t, _ in stack)
        aside = tag not in HIDDEN and boilerplate(tag, found["rest"], in_article)
        gone = tag in HIDDEN or aside and not every
        if not out:
            yield (BREAK if aside else f"<{tag}"), ""
        stack.append((tag, gone))
        out += gone


def read_words(text: str) -> list[str]:
    return references.unescape(text).split()


def fit_weights(pages: Iterable[str]) -> dict[str, float]:
    """Scores of tokens from pages that mark their article by an element.

    Inside is what stands in ``article``; the element's own tags are not looked at. Scores
    are logarithms of the ratio of frequencies, with one added to each count. Pages without
    such an element are no labelled pages and are skipped.
    """
    inside, outside = Counter(), Counter()
    for page in pages:
        found, depth = [], 0
        for kind, text in tokens(page, every=True):
            if kind == "<article":
                depth += 1
            elif kind == "</article":
                depth -= 1
            else:
                found.append((depth > 0, kind, len(read_words(text)) if kind == WORD else 1))
        if any(x[0] for x in found):
            for is_inside, kind, n in found:
                (inside if is_inside else outside)[kind] += n
    if not inside:
        return dict(DEFAULT_WEIGHTS)
    kinds = set(inside) | set(outside)
    total_in, total_out = sum(inside.values()) + len(kinds), sum(outside.values()) + len(kinds)
    ratio = {k: math.log((inside[k] + 1) / total_in) - math.log((outside[k] + 1) / total_out) for k in kinds}
    # The method's signs: a word never counts against a region, a tag never for it. A tag that
    # no labelled page has inside is not proof, so its score has a floor.
    made = {k: max(min(v, 0.0), FLOOR) for k, v in ratio.items()}
    # Running text holds inline tags, also where the labelled pages happen to have none.
    made |= {k: 0.0 if k[1] == "/" else max(v, DEFAULT_WEIGHTS["<a"]) for k, v in made.items() if k.lstrip("</") in INLINE}
    return made | {WORD: max(ratio.get(WORD, 0.0), 0.1), BREAK: DEFAULT_WEIGHTS[BREAK]}


#: Scores where no page is labelled: a word is worth one, tags of lists and links cost more.
#: A boilerplate element costs little, since its text is left out and articles hold some.
DEFAULT_WEIGHTS = {WORD: 1.0, BREAK: -1.0, "<li": -3.0, "<a": -3.0, "<td": -2.0, "<ul": -3.0, "<div": -1.0, "</body": -3.0}
#: Lowest score of a tag.
FLOOR = -6.0
#: Elements of running text: their tags are worth nothing where no labelled page has them.
PROSE = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption header section br".split())


def tag_score(kind: str, weights: dict[str, float]) -> float:
    if kind in weights:
        return weights[kind]
    return 0.0 if kind.lstrip("</") in PROSE else min(weights.get("<div", -1.0), -0.5)


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and last place (exclusive) of the contiguous part with the largest sum; empty if none is positive."""
    best, begin, end, total, start = 0.0, 0, 0, 0.0, 0
    for i, score in enumerate(scores):
        if total < 0.0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, begin, end = total, start, i + 1
    return begin, end


def main_text(page: str, weights: dict[str, float]) -> str:
    """Blocks of the best region, each with single spaces, joined by newlines."""
    kinds, texts, scores = [], [], []
    word = weights[WORD]
    for kind, text in tokens(page):
        kinds.append(kind)
        texts.append(text)
        scores.append(word * len(read_words(text)) if kind == WORD else tag_score(kind, weights))
    begin, end = best_region(scores)
    blocks: list[list[str]] = [[]]
    for i in range(begin, end):
        kind = kinds[i]
        if kind == WORD:
            blocks[-1].append(texts[i])
        elif kind.lstrip("</") == "br":
            blocks[-1].append(" ")
        elif kind.lstrip("</") not in INLINE and blocks[-1]:
            blocks.append([])
    lines = (" ".join(read_words("".join(b))) for b in blocks)
    return "\n".join(x for x in lines if x)


def labelled_weights(pages: DataFrame, html: str = "html", sample: int = 500) -> dict[str, float]:
    """Scores from at most ``sample`` labelled pages: those with an ``article`` element, by hash of the page.

    ``sample`` bounds what is read to the driver; it is the only step that does not see all pages.
    """
    labelled = pages.where(F.col(html).contains("<article")).select(html, F.xxhash64(html).alias("h"))
    return fit_weights(r[0] for r in labelled.orderBy("h").limit(sample).collect())


def extract_text(
    pages: DataFrame, weights: dict[str, float], html: str = "html", keep: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """For each row its ``keep`` columns, ``text`` and ``n_chars``. One pass without a shuffle."""
    names = [f"k{i}" for i in range(len(keep))]
    needed = pages.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col(html).alias("html"))
    schema = T.StructType(
        [needed.schema[n] for n in names] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(h.decode("utf-8", "replace"), weights) for h in as_bytes(batch.column(len(names)))]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(names))],
                    pa.array(found, pa.string()), pa.array(map(len, found), pa.int64()),
                ],
                names=[f.name for f in schema.fields],
            )

    made = needed.mapInArrow(run, schema)
    renamed: list[Column] = [F.col(n).alias(c) for c, n in zip(keep, names, strict=True)]
    return made.select(*renamed, "text", "n_chars")
