"""Fixtures of these tests (no second conftest, which would hide the first)."""

import pytest

TEXT = "doc_id long, text string"


@pytest.fixture()
def docs(spark):
    """Builds a documents-like table of (doc_id, text) rows."""
    def make(rows, schema=TEXT):
        return spark.createDataFrame(rows, schema)
    return make


@pytest.fixture()
def small():
    return "/root/testdata/sf0.001"
