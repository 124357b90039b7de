"""Constant lookups: short and long levels, and the size of their expressions."""

from itertools import product

from pyspark.sql import functions as F

from docalign.functions.lookup import SHORT, constant_lookup


def test_levels_short_and_long(spark):
    for widths in product([2, SHORT, SHORT + 1, 40], repeat=2):
        entries = [((f"a{i}", f"b{j}"), i * 100 + j) for i in range(widths[0]) for j in range(widths[1] if i == 1 else 1)]
        asked = [*[k for k, _ in entries], ("a0", "b39"), ("z", "b0"), ("a0", None), (None, "b0"), ("a1", "")]
        rows = spark.createDataFrame(asked, "x string, y string")
        found = rows.select("x", "y", constant_lookup(entries, "int")(F.col("x"), F.col("y")).alias("n")).collect()
        assert [r.n for r in found] == [dict(entries).get(k) for k in asked]


def test_each_level_is_evaluated_once(spark):
    """The first key is in the expression as often with three long levels as with one."""
    keys = [F.col(c) for c in "xyz"]
    rows = spark.createDataFrame([("a", "b", "c")], "x string, y string, z string")

    def uses(depth):
        entries = [(tuple(f"k{(i >> (4 * d)) % 16}" for d in range(depth)), i) for i in range(16**depth)]
        plan = rows.select(constant_lookup(entries, "int")(*keys[:depth]).alias("n"))._jdf.queryExecution().analyzed().toString()
        return plan.split("Project [")[1].split("\n")[0].count("crc32(cast(x#")

    assert uses(1) == uses(2) == uses(3) == 1
