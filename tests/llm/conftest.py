from __future__ import annotations

import pytest
from duebook.llm.queries import QUERIES
from duebook.llm.staging import shared_root


@pytest.fixture(scope="session", autouse=True)
def staging_folder(spark):
    return shared_root(spark)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.fixture(scope="session")
def result(spark, sf):
    """Rows of a query, each query run once."""
    kept = {}

    def rows(name):
        if name not in kept:
            kept[name] = QUERIES[name](spark, sf).collect()
        return kept[name]

    return rows
