from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """documents(["text", None, ...]) or documents([(7, "text"), ...]): a table with the columns of documents."""

    def build(texts, schema=DOCS):
        rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        return spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], schema)

    return build


@pytest.fixture(scope="session")
def real(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
