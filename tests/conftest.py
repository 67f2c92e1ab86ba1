from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from feira.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(4, 4, settings={"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """`rows("a int, b string", (1, "x"), ...)` as a DataFrame."""

    def make(schema: str, *values):
        return spark.createDataFrame(list(values), schema)

    return make


def values(df, *columns):
    """Sorted rows of `df` as plain tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
