"""What keeps the disk small: stored steps, one exchange of the record, numbers for codes, packed rows."""

import datetime as dt
import re
import sys
import time

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tidemark import catalog
from tidemark.catalog import registry
from tidemark.catalog.fixtures import FIXTURES, PLANNED
from tidemark.functions.text import CASELESS, caseless_key, caseless_value
from tidemark.operators import activity as A
from tidemark.operators import fixed as X
from tidemark.operators import history as H
from tidemark.operators.service_lines import service_lines
from tidemark.operators.snapshot import Span
from tidemark.session import store

SPAN = Span("S", dt.date(2000, 6, 30), dt.date(2000, 9, 16))


@pytest.fixture
def shuffled(spark):
    """No join is broadcast for its size."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, before)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan)]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().endswith(".data")}


def test_store_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    kept = store(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s")))
    assert {tuple(r) for r in kept.collect()} == {(k, sum(range(k, 1000, 7))) for k in range(7)}
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_lines_share_the_exchange_of_the_record(rows, shuffled):
    records = rows(
        "tenant string, record_id bigint, authority int, from_date date, thru_date date",
        ("t", 1, 5, "2000-01-01", "2041-01-01"), ("t", 2, 6, "2000-08-01", "2000-08-31"),
        ("t", 3, 7, "2000-01-01", "2041-01-01"), ("t", -4, 7, "2000-01-01", "2041-01-01"),
    )
    pending = rows("tenant string, record_id bigint", ("t", 1), ("t", 2), ("t", -4))
    grouper = rows(
        "tenant string, record_id bigint, from_date date, thru_date date, line_group string, "
        "line string, care_family string, procedure_text string",
        ("t", 1, "2000-01-01", "2000-07-31", "g", "l", None, "a:b"),
        ("t", 1, "1990-01-01", "2000-06-29", "never", None, None, None),
    )
    classes = rows(
        "tenant string, record_id bigint, snapshot_date date, patient_class string",
        ("t", 1, "2000-06-30", X.EXCLUDED), ("t", 1, "2000-06-30", X.EXCLUDED),
        ("t", 1, "2000-07-31", "other"), ("t", 1, "2000-07-31", X.LEGACY), ("t", 2, "2000-08-31", "other"),
    )
    out = service_lines(records, pending, grouper, classes, SPAN)
    assert as_set(out, "record_id", "from_date", "thru_date", "service_line_1", "procedure_category") == [
        ("1", "2000-06-30", "2000-07-31", X.EXCLUDED, "b"),
        ("1", "2000-07-31", "2000-07-31", X.LEGACY, "b"),
        ("1", "2000-07-31", "2000-07-31", "g", "b"),
        ("1", "2000-08-31", "None", X.L_UNCODED, "No Procedure"),
        ("1", "2000-09-15", "None", X.L_UNCODED, "No Procedure"),
        ("2", "2000-08-31", "None", X.L_UNCODED, "No Procedure"),
    ]
    assert exchanges(out) and not [x for x in exchanges(out) if "snapshot_date" in x]


def test_charges_travel_with_one_number_for_their_codes(rows):
    terms = rows("source_key string, term_key string", ("1", "u"))
    groups = rows(
        "source_key string, group_code string, family string, start_date date, end_date date",
        ("a", X.G_SURGERY, X.F_CHARGE, "1999-01-01", "2041-01-01"),
        ("d", X.G_SURGERY, X.F_DEPARTMENT, "1999-01-01", "2000-07-15"),
        ("e", X.G_REHAB, X.F_DEPARTMENT, "1999-01-01", "2041-01-01"),
    )
    names = "record_id bigint, post_date date, quantity decimal(19,3), " + ", ".join(f"{c} string" for c in A.CODES)
    charges = rows(
        names.replace("decimal(19,3)", "int"),
        (1, "2000-01-01", 1, "a", "d", "?", "1"), (1, "2000-02-01", 2, "a", "d", None, "1"),
        (1, "2000-02-01", 4, "x", "y", "z", "9"), (1, "2000-02-01", 8, "w", None, "v", "8"),
        (1, "2000-02-01", 16, "x", "e", "z", "9"),
    ).withColumn("quantity", F.col("quantity").cast("decimal(19,3)"))
    known, fit, sizes = A._map_spans(terms, groups, SPAN)
    assert fit and sizes == {"item": 1, "dept": 2, "location": 2, "procedure": 1}
    totals = A.charge_totals(charges, SPAN, ["record_id"], known, sizes)
    assert totals.columns == ["record_id", "point", "codes", "charges", "quantity_to_date"]
    parts = A._unpacked(totals, sizes)
    assert as_set(parts, *A.CODES, "charges", "quantity_to_date") == [
        ("0", "0", "0", "0", "2", "12.000"), ("0", "2", "0", "0", "1", "16.000"), ("1", "1", "0", "1", "2", "3.000"),
    ]


def test_fold_packs_the_rows_of_a_record(rows, shuffled):
    df = rows(
        "k string, n int, d date, c string, p string, q string",
        ("1", 1, "2000-01-31", "class", None, None), ("1", 1, "2000-01-31", None, "p1", None),
        ("1", 1, "2000-01-31", None, "p2", "q1"), ("1", 1, "2000-02-29", None, "p3", "q3"),
        ("1", 1, "2000-02-29", "other", None, None), ("1", 1, "2000-02-29", "other", None, None),
        ("1", 2, None, "class", "p4", None), ("1", 2, "2000-01-31", None, "p5", None), (None, 2, None, "x", "p6", None),
    )
    plain = H.fold_sparse_rows(df, ["k", "n", "d"], ["c"], "c", ["p", "q"])
    packed = H.fold_sparse_rows(df, ["k", "n", "d"], ["c"], "c", ["p", "q"], ["k", "n"])
    assert exchanges(packed) == ["k, n"]
    assert as_set(packed) == as_set(plain) == [
        ("1", "1", "2000-01-31", "class", "p1", "q1"), ("1", "1", "2000-01-31", "class", "p2", "q1"),
        ("1", "1", "2000-02-29", "other", "p3", "q3"), ("1", "2", "None", "class", "p4", "None"),
        ("None", "2", "None", "x", "p6", "None"),
    ]


def test_a_key_is_equal_where_caseless_texts_are(spark):
    cased = [c for c in map(chr, range(1, sys.maxunicode + 1)) if c.lower() != c or c.upper() != c]
    texts = [p + c + q for c in [*cased, " ", "x"] for p, q in (("", ""), ("a", "b"), ("A", ""), ("A ", "  "))]
    df = spark.createDataFrame([(x, caseless_value(x)) for x in texts], "x string, value string")
    df = df.withColumn("c", F.collate("x", CASELESS)).withColumn("k", caseless_key(F.col("c")))
    assert df.where(F.col("c") != F.collate("k", CASELESS)).count() == 0
    assert df.where(F.col("k") != F.col("value")).count() == 0
    assert df.select("c").distinct().count() == df.select("k").distinct().count()


@pytest.fixture
def folder(rows, tmp_path):
    """Few orders in all their kinds, one customer, part and line missing, lines out of order."""
    day = ["1999-03-01", "2000-07-31", "2000-12-31", "2001-03-31"]
    price = [9000, 20000, 30000, 100000, 485000, 492000, 496000]
    orders = [(k, k % 5, "FOP"[k % 3], price[k % 7], f"{day[k % 4]} 10:00:00", "1-URGENT" if k % 2 else "5-LOW") for k in range(1, 85)]
    lines = [(k, k * n % 11, n, 50 if k % 9 == 0 else n, 100 * n, "ANR"[k % 3], "OF"[n % 2], f"{day[(k + n) % 4]} 00:00:00") for n in (2, 1, 3) for k in range(84, 0, -1)]
    tables = {
        "orders": rows("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string", *orders, (90, None, None, None, None, None)),
        "lineitem": rows("l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz", *lines, (90, 1, 1, None, None, None, None, None)),
        "part": rows("p_partkey bigint, p_type string, p_brand string, p_size int", *[(k, ["PROMO", "STANDARD", "SMALL", "LARGE"][k % 4], f"Brand#{k % 6}", 18 + k % 4) for k in range(10)]),
        "customer": rows("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", *[(k, f"C{k}", n, b, s) for k, n, b, s in ((0, 16, 1, "BUILDING"), (1, 24, 9950, "MACHINERY"), (2, 12, 9850, "HOUSEHOLD"), (3, 3, None, "BUILDING"))]),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_planned_inputs_are_the_fixtures(spark, folder):
    t = registry.Inputs(spark, folder)
    for name in PLANNED:
        text = FIXTURES[name]
        plain = spark.sql(text, **{n: getattr(t, n) for n in registry._PLACEHOLDER.findall(text)})
        planned = getattr(t, name)
        assert [(f.name, f.dataType) for f in planned.schema] == [(f.name, f.dataType) for f in plain.schema]
        assert as_set(planned) == as_set(plain) and planned.count() > 60


def test_caseless_classes_meet_on_plain_keys(spark, folder, shuffled):
    found = catalog.queries()
    out = found["caseless_classes"](spark, folder)
    assert not [x for x in exchanges(out) if "collationkey" in x or "record_id, snapshot_date" in x]
    columns = sorted(out.columns)
    assert as_set(out, *columns) == as_set(found["classify_tiers"](spark, folder), *columns)
    assert out.count() > 60
