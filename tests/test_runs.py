"""Runs count as a whole or not at all."""

from __future__ import annotations

import pytest

from docalign.sources.runs import ReadRun, Run, unfinished_runs, whole_runs, written_run


def test_a_run_that_fails_between_two_tables_is_never_read(spark, tmp_path):
    path, rows = str(tmp_path), spark.range(5)
    with pytest.raises(FileNotFoundError):
        ReadRun(spark, path)
    first = written_run(spark, path, lambda run: (run.add("a", rows), run.add("b", rows.selectExpr("id % 2 AS g", "id"), by=("g",), sort=("id",))))

    def failing(run):
        run.add("a", spark.range(99))
        raise RuntimeError("between two tables")

    with pytest.raises(RuntimeError):
        written_run(spark, path, failing)
    now = ReadRun(spark, path)
    assert now.name == first.name and now.table("a").count() == 5
    assert whole_runs(spark, path) == [first.name] and len(unfinished_runs(spark, path)) == 1
    again = written_run(spark, path, lambda run: (run.add("a", spark.range(7)), run.add("empty", rows.where("false"))))
    assert ReadRun(spark, path).name == again.name and ReadRun(spark, path).table("a").count() == 7
    assert ReadRun(spark, path).table("empty").columns == ["id"] and ReadRun(spark, path, first.name).table("a").count() == 5
    assert sorted(map(tuple, first.table("b").collect())) == [(0, 0), (1, 1), (2, 0), (3, 1), (4, 0)]


def test_a_repeated_run_of_one_name_replaces_itself(spark, tmp_path):
    path = str(tmp_path)
    broken = Run(spark, path, "r1")
    broken.add("a", spark.range(3))
    written_run(spark, path, lambda run: run.add("a", spark.range(4)), name="r1")
    assert ReadRun(spark, path).table("a").count() == 4 and unfinished_runs(spark, path) == []
