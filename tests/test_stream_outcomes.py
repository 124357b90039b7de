"""A stream with dead letters and run rows: every file once, also after a failure between two tables."""

import pytest

from docalign.operators.config import rules
from docalign.plans.harmonize import harmonize, output_documents
from docalign.streaming import outcomes
from docalign.streaming.documents import read_document_stream


def _files(folder, names, text):
    folder.mkdir(exist_ok=True)
    for name in names:
        (folder / f"{name}.json").write_text(text)


@pytest.fixture
def run(spark, tmp_path):
    def start(folder="in", checkpoint="checkpoint"):
        read = read_document_stream(spark, str(tmp_path / folder), files_per_batch=2)
        done = output_documents(harmonize(read, rules([{"when": {}, "then": {"v": 1}}])))
        stream = outcomes.write_outcome_stream(done, str(tmp_path / "out"), str(tmp_path / checkpoint))
        stream.awaitTermination()

    return start


def _state(spark, tmp_path):
    path = str(tmp_path / "out")
    good = sorted(r.output_file for r in outcomes.read_output_documents(spark, path).collect())
    bad = sorted((r.input_file.rsplit("/", 1)[-1], r.error) for r in outcomes.read_dead_letters(spark, path).collect())
    return good, bad, tuple(outcomes.read_totals(spark, path).first())


def test_nothing_written_yet(spark, tmp_path):
    assert _state(spark, tmp_path) == ([], [], (0, 0, 0, 0, 0))


def test_failure_between_tables_is_made_good(spark, tmp_path, run, monkeypatch):
    _files(tmp_path / "in", "ab", '{"metadata":{"x":1}}')
    _files(tmp_path / "in", "c", "{broken")
    plain, calls = outcomes.run_row, []

    def stopped(rows):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped between two tables")
        return plain(rows)

    monkeypatch.setattr(outcomes, "run_row", stopped)
    with pytest.raises(Exception, match="stopped between two tables"):
        run()
    # The second batch has its outcomes but no run row: only the first one counts.
    assert outcomes.read_runs(spark, str(tmp_path / "out")).count() == 1
    assert _state(spark, tmp_path)[2][0] == 2
    monkeypatch.setattr(outcomes, "run_row", plain)
    run()
    want = (["a.json", "b.json"], [("c.json", "invalid JSON")], (3, 2, 1, 2, 0))
    assert _state(spark, tmp_path) == want
    run()  # no new files, nothing changes
    assert _state(spark, tmp_path) == want


def test_two_streams_share_a_path(spark, tmp_path, run):
    _files(tmp_path / "in", "a", '{"metadata":{}}')
    _files(tmp_path / "more", "b", '{"metadata":[]}')
    run()
    run("more", "checkpoint2")
    assert _state(spark, tmp_path) == (["a.json"], [("b.json", "metadata is not a JSON object")], (2, 1, 1, 1, 0))


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    rows = [("a", "a.json", "success", None, 1, 3, "{}"), ("b", None, "failed", "invalid JSON", 0, 0, None)]
    batch = spark.createDataFrame(rows, outcomes.OUTCOME.replace("error", "status string, error"))
    for _ in range(2):
        outcomes.write_batch(batch, str(tmp_path / "out"), "stream=s/batch=4")
    good, bad, totals = _state(spark, tmp_path)
    assert (len(good), len(bad), totals) == (1, 1, (2, 1, 1, 1, 3))
