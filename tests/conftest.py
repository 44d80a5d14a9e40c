import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """``rows(ddl, *tuples)`` makes a DataFrame; dates may be given as text."""
    def make(ddl, *values):
        text = ", ".join(f"{c.split()[0]} string" for c in ddl.split(", "))
        raw = [tuple(None if v is None else str(v) for v in row) for row in values]
        frame = spark.createDataFrame(raw, text)
        return frame.selectExpr(
            *[f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in ddl.split(", ")]
        )

    return make


def as_set(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted(tuple(str(v) for v in row) for row in picked.collect())
