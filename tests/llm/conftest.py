"""Small tables for the operators."""

from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def table(spark):
    """Function from (doc_id, text[, source]) to a table like ``documents``."""

    def make(*rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] else 0) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path
