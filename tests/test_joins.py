import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tidemark.catalog import queries
from tidemark.catalog.plain import PLAIN, plain_frame
from tidemark.plans import joins

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def sides(spark):
    fact = spark.range(400).selectExpr(
        "case when id % 3 = 0 then 7 when id % 17 = 0 then null else id % 40 end as code",
        "id % 5 as day",
    )
    table = spark.createDataFrame(
        [(7, 0, 2, "a"), (7, 2, 4, "b"), (8, 1, 1, "c"), (9, 0, 9, "d"), (None, 0, 9, "n")],
        "key long, low long, high long, label string",
    )
    return fact, table


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_is_the_broadcast_join(sides, how, null_safe):
    fact, table = sides
    inside = F.col("day").between(F.col("low"), F.col("high"))
    keys = [("code", "key")]
    small = joins.lookup_join(fact, table, keys, inside, how, null_safe=null_safe)
    large = joins.lookup_join(fact, table, keys, inside, how, max_rows=2, null_safe=null_safe)
    assert as_set(small) == as_set(large)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert "salt" in large._jdf.queryExecution().optimizedPlan().toString()


def test_copies_of_one_row_are_spread(spark):
    fact = spark.range(0, 4000, 1, 16).selectExpr("1L as code")
    salts = joins.salted_join(
        fact, spark.createDataFrame([(1, "a")], "key long, label string"), [("code", "key")]
    )
    # The salt column is dropped from the result, so look at what it is made of.
    assert "SPARK_PARTITION_ID" in salts._jdf.queryExecution().analyzed().toString()
    assert salts.count() == 4000


def test_salted_join_refuses_other_kinds(sides):
    fact, table = sides
    with pytest.raises(ValueError):
        joins.salted_join(fact, table, [("code", "key")], how="right")


def test_fits_broadcast(spark):
    assert joins.fits_broadcast(spark.range(10), 10)
    assert not joins.fits_broadcast(spark.range(11), 10)


@pytest.mark.parametrize("values", [[1, 2, None], [1, 2], [], [None]])
def test_not_in_is_sql_not_in(spark, values):
    left = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    right = spark.createDataFrame([(v,) for v in values], "y int")
    wanted = spark.sql(
        "SELECT * FROM {l} WHERE x NOT IN (SELECT y FROM {r})", l=left, r=right
    )
    assert as_set(joins.not_in(left, "x", right, "y")) == as_set(wanted)


def test_either_key(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (None, 40)], "a int, b int")
    right = spark.createDataFrame([(1, 99), (5, 20), (1, 10), (None, 7)], "c int, d int")
    found = joins.either_key_matches(left, right, [[("a", "c")], [("b", "d")]], ["a", "b"])
    assert as_set(found) == [("1", "10"), ("2", "20")]
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan


@pytest.mark.parametrize("name", PLAIN)
def test_plain_forms_for_the_bench_give_the_same_rows(spark, name):
    plain, rewritten = plain_frame(name, spark, FOLDER), queries()[name](spark, FOLDER)
    names = [c for c in rewritten.columns if c in plain.columns]
    assert len(names) == len(plain.columns) == len(rewritten.columns)
    assert as_set(plain, *names) == as_set(rewritten, *names)
