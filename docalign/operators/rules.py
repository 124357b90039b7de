"""Conditional updates: rules with a ``when`` and a ``then`` part.

Conditions look at the original body and are two-valued, so rules never see each
other's updates and a missing field never makes a result unknown. A list of rules is
compiled into boolean expressions; a DataFrame of rules, of any size, is joined
(``rule_index``).
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.functions.lookup import constant_array
from docalign.functions.rows import unfold
from docalign.operators.config import Config, Rows, constant_rows, is_joined
from docalign.operators.rule_index import MUST, SHOULD, attach_fired, items_of

ASSIGNMENT = "struct<rule_no:int,field:string,kind:string,text:string>"


def ordered_rules(rules: Config) -> Rows:
    """Rules in the order they apply, numbered from 1 within each profile."""
    found = sorted(
        constant_rows(rules),
        key=lambda r: (r["profile"] or "", r["part"], r["source_file"] or "", r["pos"]),
    )
    numbered: Rows = []
    count: dict[str | None, int] = {}
    for row in found:
        no = count[row["profile"]] = count.get(row["profile"], 0) + 1
        when, then = json.loads(row["when"]), json.loads(row["then"])
        if not isinstance(when, dict) or not isinstance(then, dict):
            raise ValueError(f"rule {no}: 'when' and 'then' must be objects")
        numbered.append(
            {"rule_no": no, "profile": row["profile"], "source_file": row["source_file"], "when": when, "then": then}
        )
    return numbered


def compile_condition(when: Any, cells: Column) -> Column:
    """A ``when`` part as a boolean expression."""
    if not isinstance(when, dict):
        raise ValueError(f"a condition must be an object, not {when!r}")
    unknown = set(when) - {MUST, SHOULD}
    if unknown:
        raise ValueError(f"a condition has {MUST} and {SHOULD} only, not {sorted(unknown)}")
    parts = []
    if MUST in when:
        parts.append(reduce(and_, [_item(i, cells) for i in items_of(when, MUST)], F.lit(True)))
    if SHOULD in when:
        parts.append(reduce(or_, [_item(i, cells) for i in items_of(when, SHOULD)], F.lit(False)))
    return reduce(and_, parts, F.lit(True))


def _item(item: dict[str, Any], cells: Column) -> Column:
    if MUST in item or SHOULD in item:
        return compile_condition(item, cells)
    return reduce(and_, [_equals(cells, f, v) for f, v in item.items()], F.lit(True))


def _equals(cells: Column, field: str, value: Any) -> Column:
    """Whether the field has exactly this value; null also means absent."""
    same = [
        F.array_contains(
            cells,
            C.cell(F.lit(field), F.lit(v["kind"]), F.lit(v["text"]).cast("string")),
        )
        for v in C.equal_values(value)
    ]
    if value is None:
        same.append(~F.array_contains(C.names(cells), F.lit(field)))
    return reduce(or_, same)


def apply_rules(
    documents: DataFrame,
    rules: Config,
    body: str = "metadata",
    into: str = "modified_metadata",
    log: str = "applied_rules",
    lookup: str | None = None,
) -> DataFrame:
    """Update the body by all rules whose condition holds.

    A new field is appended, a known one keeps its place; the last matching rule
    wins. ``log`` gets the fired assignments in order, as
    ``array<struct<rule_no, field, kind, text>>``. ``lookup`` is "constant" or "join",
    see ``operators.config``.
    """
    if is_joined(rules, lookup):
        documents, fired = attach_fired(documents, rules, body)

        def made(r: Column) -> Column:
            return F.transform(
                r["assigned"],
                lambda c: F.struct(
                    r["rule_no"].alias("rule_no"), c["field"].alias("field"), c["kind"].alias("kind"), c["text"].alias("text")
                ),
            )

        documents = documents.withColumn(log, F.flatten(F.transform(F.col(fired), made)).cast(f"array<{ASSIGNMENT}>"))
        return documents.withColumn(into, _updated(F.col(body), F.col(log))).drop(fired)
    compiled = ordered_rules(rules)
    if not compiled:
        return documents.withColumn(into, F.col(body)).withColumn(log, constant_array([], ASSIGNMENT))
    # Conditions outside of lambdas are compiled; the literals are shared.
    none = constant_array([], ASSIGNMENT)

    def assignments(of_profile: Rows) -> Column:
        made = [
            F.when(
                compile_condition(r["when"], F.col(body)),
                constant_array(
                    [{"rule_no": r["rule_no"], "field": f, **C.value_of(v)} for f, v in r["then"].items()],
                    ASSIGNMENT,
                ),
            ).otherwise(none)
            for r in of_profile
        ]
        return F.flatten(F.array(*made)) if made else none

    return documents.withColumn(log, _by_profile(documents, compiled, assignments, none)).withColumn(
        into, _updated(F.col(body), F.col(log))
    )


def fired_rules(documents: DataFrame, rules: Config, body: str = "metadata", lookup: str | None = None) -> DataFrame:
    """One row per document and rule that fired: ``rule_no`` and its texts."""
    if is_joined(rules, lookup):
        kept = [c for c in documents.columns if c not in (body, "source_file")]
        documents, fired = attach_fired(documents, rules, body)
        found = unfold(documents, kept, fired, "_rule")
        return found.select(*kept, *[f"_rule.{c}" for c in ("rule_no", "source_file", "conditions", "updates")])
    compiled = ordered_rules(rules)
    about = constant_array(
        [
            {
                "rule_no": r["rule_no"],
                "source_file": r["source_file"],
                "conditions": json.dumps(r["when"], ensure_ascii=False),
                "updates": json.dumps(r["then"], ensure_ascii=False),
            }
            for r in compiled
        ],
        "struct<rule_no:int,source_file:string,conditions:string,updates:string>",
    )
    kept = [c for c in documents.columns if c not in (body, "source_file")]
    return (
        unfold(documents, kept, _fired(documents, compiled, F.col(body)), "_rule")
        .withColumn("_about", F.get(about, F.col("_rule")))
        .select(*kept, "_about.*")
    )


def _by_profile(documents: DataFrame, compiled: Rows, make, none: Column) -> Column:
    """The shared rules' result, then that of the row's own profile: no other profile's
    rules are evaluated on a row. ``make`` turns rules into an array column."""
    of: dict[str | None, Rows] = {}
    for r in compiled:
        of.setdefault(r["profile"], []).append(r)
    shared = make(of.pop(None, []))
    if not of or "profile" not in documents.columns:
        return shared
    own = F
    for profile, rows in of.items():
        own = own.when(F.col("profile") == profile, make(rows))
    return F.concat(shared, own.otherwise(none))


def _fired(documents: DataFrame, compiled: Rows, cells: Column) -> Column:
    """Places, from 0, of the rules that fire on a row."""
    place = {id(r): i for i, r in enumerate(compiled)}

    def marks(rows: Rows) -> Column:
        if not rows:
            return none
        fired = [F.when(compile_condition(r["when"], cells), F.lit(place[id(r)])).otherwise(F.lit(-1)) for r in rows]
        return F.array_remove(F.array(*fired), -1)

    none = F.array().cast("array<int>")
    return _by_profile(documents, compiled, marks, none)


def _updated(cells: Column, applied: Column) -> Column:
    """The body after the assignments, in order, have been made."""
    def build(x: Column) -> Column:
        old, latest = x["old"], x["latest"]

        def newest(field: Column) -> Column:
            # The last assignment of a field comes first in the reversed list.
            found = F.get(F.filter(latest, lambda a: a["field"] == field), F.lit(0))
            return F.when(found.isNotNull(), C.cell(found["field"], found["kind"], found["text"]))

        overwritten = F.transform(old, lambda c: F.coalesce(newest(c["field"]), c))
        return F.concat(overwritten, F.transform(x["added"], newest))

    context = F.struct(
        cells.alias("old"),
        F.reverse(applied).alias("latest"),
        F.array_except(F.array_distinct(C.names(applied)), C.names(cells)).alias("added"),
    )
    return F.when(F.size(applied) == 0, cells).otherwise(C.let(context, build))
