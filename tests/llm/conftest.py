"""Small frames with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import duckdb
import pytest
from llm.cases import AWKWARD, TINY



@pytest.fixture(scope="session")
def awkward(spark):
    """doc_id and text, and columns whose names the operators also make."""
    rows = [(i, t, 7, "x", "src") for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, part string, source string")


@pytest.fixture(scope="session")
def documents():
    """doc_id and text of the smallest table."""
    return duckdb.sql(f"select doc_id, text from read_parquet('{TINY}/documents.parquet')").fetchall()
