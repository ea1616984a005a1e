import os
import sys

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, id string, score int, n boolean, raw string, node string, keep int, component int"


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) of the small documents table."""
    table = pq.read_table(f"{SF_DIR}/documents.parquet")
    return list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True))


@pytest.fixture
def frame(spark):
    """Makes documents of (doc_id, text) rows, with other columns whose names clash."""

    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1, True, "r", None, 0, None) for i, t in rows], SCHEMA).repartition(3)

    return make


@pytest.fixture
def odd():
    """Rows that are null, empty, repeated, very long or strange."""
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "Same text HERE"), (5, "same TEXT here"), (5, "same TEXT here"),
        (None, "Same text here"), (None, None), (6, "É é ß x"), (7, "é é ß x"), (8, "word " * 60_000),
        (9, "x" * 300_000), (10, "!!! ??? ..."), (11, "CC-BY all  rights\nreserved"), (12, "a\x00b \x85 c\u2581d"),
    ]
