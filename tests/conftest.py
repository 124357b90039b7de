from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("docalign-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bodies(spark):
    """Function from Python dicts to documents with these bodies, numbered."""
    import json

    from pyspark.sql import functions as F

    from docalign.functions.cells import parse_cells

    def make(*items, profile=None):
        rows = [(i, profile, json.dumps(b, ensure_ascii=False)) for i, b in enumerate(items)]
        frame = spark.createDataFrame(rows, "id int, profile string, text string")
        return frame.select("id", "profile", parse_cells(F.col("text")).alias("metadata"))

    return make


@pytest.fixture(scope="session")
def values_of():
    """Function from documents to Python dicts of a body column, in order."""
    import json

    from pyspark.sql import functions as F

    from docalign.functions.cells import json_object

    def read(documents, body="modified_metadata"):
        rows = documents.select("id", json_object(F.col(body)).alias("t")).orderBy("id").collect()
        return [json.loads(r.t) for r in rows]

    return read
