"""Quality rules: measures of a text, and lines that too many documents of a host share.

DataFrame functions only. Texts never leave the scan: what is shuffled are hashes of
lines. One row per input row comes out; equal rows get equal results.

Defined cases: a null text counts as no words (it fails the base rules); a null source
is a host of its own; a null or repeated ``doc_id`` is allowed, since rows are told apart
by id, source and text together; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.llm.common import SPACES, row_key

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineLimits:
    """A line is over the limit in a host if more than ``min_documents`` and more than
    ``share`` of the host's documents hold it. A document is depleted if the lines that
    are not over the limit have fewer than ``min_chars`` characters or less than ``min_left``
    of its characters."""

    min_documents: int = 20
    share: float = 0.002
    min_chars: int = 50
    min_left: float = 0.2
    witness_left: float = 0.5


def repeat_words(words: Column, width: int = 5) -> Column:
    """Words inside windows of ``width`` words that the text has twice or more.

    Windows are compared by 64-bit hash. The hashes are sorted with their starts, so
    equal ones stand side by side; a window counts if a neighbor is equal. The covered
    words are the union of the intervals that begin at these starts.
    """
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(1), n - (width - 1)), lambda i: F.xxhash64(F.slice(words, i, width)))

    def covered(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # A field of a struct that is computed twice would be sorted twice: bind it by a lambda.
        return F.aggregate(
            F.array(ranked),
            F.lit(0),
            lambda _, s: F.aggregate(
                F.sort_array(
                    F.filter(
                        F.transform(
                            s,
                            lambda x, k: F.when(
                                (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"]
                            ),
                        ),
                        lambda i: i.isNotNull(),
                    )
                ),
                F.struct(F.lit(0).alias("sum"), F.lit(-width).alias("last")),
                lambda a, i: F.struct(
                    (a["sum"] + F.least(F.lit(width), i - a["last"])).alias("sum"), i.alias("last")
                ),
                lambda a: a["sum"],
            ),
        )

    def measured(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    bound = F.aggregate(F.array(windows), F.lit(0), lambda _, h: measured(h))
    return F.when(n < width, F.lit(0)).otherwise(bound)


def text_measures(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0)
    # One element bound by a lambda: the words are split once for all three measures.
    by_words = F.transform(
        F.array(words),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    by_lines = F.transform(F.array(lines), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    measured = (
        documents.withColumns({"by_words": F.get(by_words, F.lit(0)), "n_dup_lines": F.get(by_lines, F.lit(0))})
        .withColumn("n_symbols", F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long"))
        .withColumns({c: F.col(f"by_words.{c}") for c in ("n_words", "word_chars", "n_repeat_words")})
        .drop("by_words")
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def document_lines(documents: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """Rows ``doc_id, row, host, line, chars, total`` for each distinct line of a document.

    A line is normalized by trimming white space and lower case. Lines without a word
    are none. ``total`` is the sum of ``chars`` of the document's distinct lines.
    """
    clean = F.transform(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.lower(F.trim(x, F.lit(SPACES)))
    )
    hashed = F.array_distinct(
        F.transform(
            F.filter(clean, lambda x: x != ""),
            lambda x: F.struct(F.xxhash64(x).alias("line"), F.length(x).alias("chars")),
        )
    )
    lined = documents.select(
        "doc_id", row_key("doc_id", host, text).alias("row"), F.col(host).alias("host"), hashed.alias("lines")
    )
    each = lined.select(
        "doc_id", "row", "host",
        F.aggregate("lines", F.lit(0), lambda a, x: a + x["chars"]).alias("total"),
        F.explode("lines").alias("x"),
    )
    return each.select("doc_id", "row", "host", "x.line", "x.chars", "total")


def common_lines(documents: DataFrame, limits: LineLimits = LineLimits(), host: str = "source") -> DataFrame:
    """Rows ``doc_id, row, chars_left, gone, depleted`` of documents that hold common lines.

    ``gone`` has the hashes of these lines; a depleted document is left with too little.

    A line counts as common if enough *witnesses* hold it: documents of the host most of
    whose text stands in other lines. Copies of one text share all their lines, so they
    are no witnesses, and a large group of copies does not turn its own text into
    boilerplate.
    """
    lines = document_lines(documents, host)
    hosts = documents.groupBy(F.col(host).alias("of_host")).agg(F.count("*").alias("documents"))
    least = F.greatest(F.lit(limits.min_documents), F.col("documents") * limits.share)

    def over_limit(found: DataFrame) -> DataFrame:
        counted = found.groupBy("host", "line").agg(F.count("*").alias("n"))
        counted = counted.where(F.col("n") > limits.min_documents)
        counted = counted.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).where(F.col("n") > least)
        return counted.select(F.col("host").alias("common_host"), F.col("line").alias("common_line"))

    def held(found: DataFrame, common: DataFrame) -> DataFrame:
        on = (F.col("line") == F.col("common_line")) & F.col("host").eqNullSafe(F.col("common_host"))
        return found.join(common, on).drop("common_host", "common_line")

    def in_common(found: DataFrame) -> DataFrame:
        return found.groupBy("doc_id", "row").agg(F.sum("chars").alias("common"), F.max("total").alias("total"))

    # Equal rows of the table are one document. They are counted apart at first, which finds
    # too many lines but none too few, and merged among the few lines found.
    found = held(lines, over_limit(lines))
    found = found.groupBy("doc_id", "row", "host", "line").agg(F.max("chars").alias("chars"), F.max("total").alias("total"))
    frequent = held(found, over_limit(found))
    witnesses = in_common(frequent).where(F.col("total") - F.col("common") >= F.col("total") * limits.witness_left)
    witnesses = witnesses.select(F.col("doc_id").alias("w_id"), F.col("row").alias("w_row"))
    seen = frequent.join(
        witnesses, (F.col("row") == F.col("w_row")) & F.col("doc_id").eqNullSafe(F.col("w_id")), "left_semi"
    )
    left = held(frequent, over_limit(seen)).groupBy("doc_id", "row").agg(
        F.sum("chars").alias("common"), F.max("total").alias("total"), F.collect_set("line").alias("gone")
    ).withColumn("chars_left", F.col("total") - F.col("common"))
    depleted = (F.col("chars_left") < limits.min_chars) | (F.col("chars_left") < F.col("total") * limits.min_left)
    return left.select(
        "doc_id", "row", F.col("chars_left").cast("long").alias("chars_left"), "gone", depleted.alias("depleted")
    )


def depleted_documents(documents: DataFrame, limits: LineLimits = LineLimits(), host: str = "source") -> DataFrame:
    """Rows ``doc_id, row, chars_left`` of documents that common lines leave too little of."""
    return common_lines(documents, limits, host).where("depleted").select("doc_id", "row", "chars_left")


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines of these hashes; all other lines stay as they are, in order."""
    normal = lambda x: F.lower(F.trim(x, F.lit(SPACES)))
    left = F.filter(F.split(text, "\n"), lambda x: (normal(x) == "") | ~F.array_contains(gone, F.xxhash64(normal(x))))
    return F.array_join(left, "\n")


def line_rules(documents: DataFrame, limits: LineLimits = LineLimits(), host: str = "source") -> DataFrame:
    """Every row with its measures, ``base_failed``, ``depleted`` and ``kept``."""
    depleted = depleted_documents(documents, limits, host).select(
        F.col("doc_id").alias("d_id"), F.col("row").alias("d_row")
    )
    needed = documents.select("doc_id", F.col(host).alias("source"), "text")
    measured = text_measures(needed).withColumn("row", row_key("doc_id", "source", "text")).drop("text", "source")
    judged = measured.join(
        depleted, (F.col("row") == F.col("d_row")) & F.col("doc_id").eqNullSafe(F.col("d_id")), "left"
    ).withColumn("depleted", F.col("d_row").isNotNull())
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted")).drop("row", "d_id", "d_row")


def keep_by_rules(documents: DataFrame, limits: LineLimits = LineLimits(), host: str = "source") -> DataFrame:
    """The documents that no rule rejects, with their own columns, without the lines that are
    common in their host; ``n_chars``, if there is one, is the length of what is left."""
    columns = documents.columns
    names = [f"c{i}" for i in range(len(columns))]
    packed = documents.select(
        "doc_id", F.col(host).alias("source"), "text",
        F.struct(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)]).alias("own"),
    )
    common = common_lines(packed, limits).select(
        F.col("doc_id").alias("d_id"), F.col("row").alias("d_row"), "gone", "depleted"
    )
    good = text_measures(packed).where(~F.col("base_failed")).withColumn("row", row_key("doc_id", "source", "text"))
    kept = good.join(
        common, (F.col("row") == F.col("d_row")) & F.col("doc_id").eqNullSafe(F.col("d_id")), "left"
    ).where(~F.coalesce("depleted", F.lit(False)))
    cut = F.when(F.col("gone").isNull(), F.col("text")).otherwise(without_lines(F.col("text"), F.col("gone")))
    kept = kept.select("gone", "own", cut.alias("left"))
    kinds = dict(documents.dtypes)

    def column(c: str, n: str) -> Column:
        if c == "text":
            return F.col("left").alias(c)
        if c == "n_chars":
            return F.when(F.col("gone").isNull(), F.col(f"own.{n}")).otherwise(F.length("left").cast(kinds[c])).alias(c)
        return F.col(f"own.{n}").alias(c)

    return kept.select(*[column(c, n) for c, n in zip(columns, names, strict=True)])
