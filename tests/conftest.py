from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threadloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=8, memory="6g", app="threadloom-tests")


@pytest.fixture
def lines(spark):
    """Rows of text as archive lines."""

    def make(*values: str, file: str = "RS_2008-03.zst"):
        return spark.createDataFrame([(value, file) for value in values], "value string, file string")

    return make


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)
