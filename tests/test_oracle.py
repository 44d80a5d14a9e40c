"""Every registered query against its SQL, over whole tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return str(value)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    found = [tuple(map(shown, r)) for r in frame.select(*[f"`{c}`" for c in columns]).collect()]
    plan = frame._jdf.queryExecution().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    result = duck.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    wanted = [tuple(shown(r[i]) for i in places) for r in result.fetchall()]
    assert found, "an empty result tests nothing"
    assert sorted(found) == sorted(wanted)


def test_entry(spark):
    frame = entry.entry(spark)
    assert "patient_class" in frame.columns
    assert frame.limit(1).count() == 1
