from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from cropledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, 4)


@pytest.fixture
def make(spark):
    """make("a string, v double", [("x", 1.0)]) -> DataFrame"""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


def rows(df, *columns):
    """Rows as sorted tuples, NULL first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is not None, x) for x in t))
