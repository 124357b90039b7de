"""Rules as rows: an inverted index of conditions, for catalogs of any size.

A condition is a network of one-way edges from a first to a last vertex: what is joined by
"and" stands in series, what is joined by "or" side by side, and an edge is one comparison of
a field with a value. The condition holds if the last vertex can be reached on edges that
hold. Every vertex within a series is its own, so paths of different branches never mix, and
a condition nested to any depth is a list of edges, neither multiplied out nor evaluated
level by level.

The cells of documents are joined with the edges by profile, field and value; what a document
hits of a rule comes home as one small array. Edges that hold without a cell (a field that
must be null or absent, an empty list of demands) are kept with the rule and added there.
Rules that could hold without any hit are joined to documents by profile, as one row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docalign.functions import cells as C
from docalign.functions.lookup import constant_array
from docalign.functions.rows import unfold
from docalign.operators.config import Config, joined_table
from docalign.operators.joins import fresh, with_body_hash

MUST, SHOULD = "__must__", "__should__"
RULE_ROW = "profile string, part int, source_file string, pos int, when string, then string"
EDGES = "array<struct<a:int,b:int>>"
COMPILED = (
    f"scope string, own boolean, rule_no int, source_file string, conditions string, updates string, last int, "
    f"always {EDGES}, nulls array<struct<field:string,a:int,b:int>>, "
    f"atoms array<struct<field:string,kind:string,text:string,a:int,b:int>>, free boolean, assigned {C.CELLS}"
)


# --- one condition ------------------------------------------------------------------------


class Network:
    """A condition as edges ``(a, b, comparison)``; a comparison of None always holds."""

    def __init__(self, when: Any) -> None:
        self.edges: list[tuple[int, int, tuple[str, Any] | None]] = []
        self.vertices = 2
        self._condition(when, 0, 1)
        self._number()

    def _series(self, steps: list, a: int, b: int) -> None:
        """``steps`` draw themselves between two vertices."""
        if not steps:
            self.edges.append((a, b, None))
        for i, step in enumerate(steps):
            if i + 1 < len(steps):
                end, self.vertices = self.vertices, self.vertices + 1
            else:
                end = b
            step(a, end)
            a = end

    def _condition(self, when: Any, a: int, b: int) -> None:
        if not isinstance(when, dict):
            raise ValueError(f"a condition must be an object, not {when!r}")
        unknown = set(when) - {MUST, SHOULD}
        if unknown:
            raise ValueError(f"a condition has {MUST} and {SHOULD} only, not {sorted(unknown)}")
        steps = [self._drawn(i) for i in items_of(when, MUST)] if MUST in when else []
        if SHOULD in when:
            branches = [self._drawn(i) for i in items_of(when, SHOULD)]
            steps.append(lambda a, b: [branch(a, b) for branch in branches])
        self._series(steps, a, b)

    def _drawn(self, item: dict[str, Any]):
        if MUST in item or SHOULD in item:
            return lambda a, b: self._condition(item, a, b)
        equal = [lambda a, b, pair=pair: self.edges.append((a, b, pair)) for pair in item.items()]
        return lambda a, b: self._series(equal, a, b)

    def _number(self) -> None:
        """Number the vertices so that every edge leads to a larger one; the first is 0."""
        into = [0] * self.vertices
        out: list[list[int]] = [[] for _ in range(self.vertices)]
        for a, b, _ in self.edges:
            into[b] += 1
            out[a].append(b)
        ready = [v for v in range(self.vertices - 1, -1, -1) if not into[v]]
        number: dict[int, int] = {}
        while ready:
            v = ready.pop()
            number[v] = len(number)
            for w in out[v]:
                into[w] -= 1
                if not into[w]:
                    ready.append(w)
        self.edges = [(number[a], number[b], c) for a, b, c in self.edges]
        self.last = number[1]

    def always(self) -> list[tuple[int, int]]:
        return [(a, b) for a, b, c in self.edges if c is None]

    def nulls(self) -> list[tuple[str, int, int]]:
        """Edges that hold where a field is null or absent."""
        return [(c[0], a, b) for a, b, c in self.edges if c is not None and c[1] is None]

    def atoms(self) -> list[tuple[str, str, str, int, int]]:
        """Edges that hold where a field has a value, a row for each form of an equal value."""
        return [
            (c[0], v["kind"], v["text"], a, b)
            for a, b, c in self.edges
            if c is not None and c[1] is not None
            for v in C.equal_values(c[1])
        ]

    def reaches(self, edges: list[tuple[int, int]]) -> bool:
        found = {0}
        for a, b in sorted(edges):
            if a in found:
                found.add(b)
        return self.last in found


def items_of(when: dict[str, Any], key: str) -> list[Any]:
    if not isinstance(when[key], list) or not all(isinstance(i, dict) for i in when[key]):
        raise ValueError(f"{key} must be an array of objects")
    return when[key]


def compiled_rules(documents: DataFrame, rules: Config) -> DataFrame:
    """One row per rule, numbered from 1 within its profile in the order they apply."""
    order = Window.partitionBy("profile").orderBy("part", F.coalesce("source_file", F.lit("")), "pos")
    numbered = joined_table(documents, rules, RULE_ROW).select(
        F.coalesce(F.concat(F.lit("="), "profile"), F.lit("")).alias("scope"), F.col("profile").isNotNull().alias("own"),
        F.row_number().over(order).alias("rule_no"), "source_file", "when", "then",
    )

    def compile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _arrow_kinds()
        for batch in batches:
            rows = [compiled_row(r) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in kinds.items()], list(kinds))

    return numbered.mapInArrow(compile_batches, COMPILED)


def compiled_row(rule: dict[str, Any]) -> dict[str, Any]:
    when, then = json.loads(rule["when"]), json.loads(rule["then"])
    if not isinstance(when, dict) or not isinstance(then, dict):
        raise ValueError(f"rule {rule['rule_no']}: 'when' and 'then' must be objects")
    network = Network(when)
    always, nulls = network.always(), network.nulls()
    ends = lambda edges: [{"a": a, "b": b} for a, b in edges]
    return {
        "scope": rule["scope"], "own": rule["own"], "rule_no": rule["rule_no"], "source_file": rule["source_file"],
        "conditions": json.dumps(when, ensure_ascii=False), "updates": json.dumps(then, ensure_ascii=False),
        "last": network.last, "always": ends(always),
        "nulls": [{"field": f, "a": a, "b": b} for f, a, b in nulls],
        "atoms": [{"field": f, "kind": k, "text": t, "a": a, "b": b} for f, k, t, a, b in network.atoms()],
        "free": network.reaches(always + [(a, b) for _, a, b in nulls]),
        "assigned": [{"field": f, **C.value_of(v)} for f, v in then.items()],
    }


def _arrow_kinds() -> dict[str, pa.DataType]:
    text, number = pa.string(), pa.int32()
    edge = [("a", number), ("b", number)]
    return {
        "scope": text, "own": pa.bool_(), "rule_no": number, "source_file": text, "conditions": text, "updates": text,
        "last": number, "always": pa.list_(pa.struct(edge)), "nulls": pa.list_(pa.struct([("field", text), *edge])),
        "atoms": pa.list_(pa.struct([("field", text), ("kind", text), ("text", text), *edge])), "free": pa.bool_(),
        "assigned": pa.list_(pa.struct([("field", text), ("kind", text), ("text", text)])),
    }


# --- all documents --------------------------------------------------------------------------


def attach_fired(documents: DataFrame, rules: Config, body: str) -> tuple[DataFrame, str]:
    """Each document with the rules that fire on it, in their order, and the name of that column.

    ``array<struct<own, rule_no, source_file, conditions, updates, assigned, ...>>``: shared
    rules first, then those of the document's own profile. Documents are found again by a hash
    of profile and body, as in ``joins.attach_matches``; no side is broadcast by hint.
    """
    out, h1, h2, own, hit, free, shared = fresh(documents.columns, "_fired", "_h1", "_h2", "_own", "_hit", "_free", "_shared")
    compiled = compiled_rules(documents, rules)
    profile = F.col("profile") if "profile" in documents.columns else F.lit(None).cast("string")
    scoped = with_body_hash(documents.withColumn(own, F.concat(F.lit("="), profile)), body, own, h1, h2)
    scopes = F.array_compact(F.array(F.lit(""), own)).alias("scopes")
    cells = unfold(scoped, [h1, h2, scopes], body, "c").select(
        h1, h2, F.explode("scopes").alias("scope"), F.col("c.field").alias("field"), F.col("c.kind").alias("kind"), F.col("c.text").alias("text")
    )
    atoms = compiled.select("scope", "rule_no", F.explode("atoms").alias("e")).select("scope", "rule_no", "e.*")
    about = ["own", "rule_no", "source_file", "conditions", "updates", "last", "always", "nulls", "assigned"]
    candidate = F.struct(*about, "edges")
    hits = (
        cells.join(atoms, ["scope", "field", "kind", "text"])
        .groupBy(h1, h2, "scope", "rule_no").agg(F.collect_set(F.struct("a", "b")).alias("edges"))
        .join(compiled.select("scope", *about), ["scope", "rule_no"])
    )
    # What cannot hold even if every null edge does stays behind.
    possible = hits.where(_reaches(F.concat("edges", "always", F.transform("nulls", _ends)), F.col("last")))
    home = possible.groupBy(h1, h2).agg(F.collect_list(candidate).alias(hit))
    without_hit = compiled.where("free").withColumn("edges", F.from_json(F.lit("[]"), EDGES))
    of_own = without_hit.where("own").groupBy(F.col("scope").alias(own)).agg(F.collect_list(candidate).alias(free))
    of_all = without_hit.where("not own").agg(F.collect_list(candidate).alias(shared))  # always one row
    joined = scoped.join(home, [h1, h2], "left").join(of_own, own, "left").crossJoin(of_all)

    def firing(x: Column) -> Column:
        def holds(r: Column) -> Column:
            missing = F.filter(r["nulls"], lambda n: ~F.array_contains(x["present"], n["field"]))
            return _reaches(F.concat(r["edges"], r["always"], F.transform(missing, _ends)), r["last"])

        told = lambda r: F.struct(*[r[c].alias(c) for c in ("own", "rule_no", "source_file", "conditions", "updates", "assigned")])
        # A rule with a hit that could also hold without one is a candidate twice.
        return F.array_sort(F.array_distinct(F.transform(F.filter(x["candidates"], holds), told)))

    there = F.filter(F.col(body), lambda c: c["kind"] != "null")
    found = [F.coalesce(c, F.slice(shared, 1, 0)) for c in (hit, free)]
    context = F.struct(F.concat(shared, *found).alias("candidates"), C.names(there).alias("present"))
    fired = joined.withColumn(out, C.let(context, firing))
    return fired.drop(h1, h2, own, hit, free, shared), out


def _ends(edge: Column) -> Column:
    return F.struct(edge["a"].alias("a"), edge["b"].alias("b"))


def _reaches(edges: Column, last: Column) -> Column:
    """Whether vertex ``last`` can be reached from 0."""
    step = lambda found, e: F.when(
        F.array_contains(found, e["a"]) & ~F.array_contains(found, e["b"]), F.concat(found, F.array(e["b"]))
    ).otherwise(found)
    return F.array_contains(F.aggregate(F.array_sort(edges), constant_array([0], "int"), step), last)
