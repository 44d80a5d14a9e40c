import calendar
import datetime as dt
import random

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tidemark.operators import snapshot as N
from tidemark.operators.snapshot import Span


def brute_points(span):
    day, out = span.start, []
    while day <= span.last:
        last = calendar.monthrange(day.year, day.month)[1]
        if day.day == last or day == span.yesterday:
            out.append(day)
        day += dt.timedelta(days=1)
    return out


SPANS = [
    Span("S", dt.date(2000, 6, 30), dt.date(2001, 6, 16)),
    Span("H", dt.date(2000, 6, 15), dt.date(2000, 9, 1)),
    Span("I", dt.date(2000, 1, 31), dt.date(2000, 2, 29)),
    Span("H", dt.date(2000, 1, 31), dt.date(2000, 2, 29)),
    Span("S", dt.date(2000, 3, 2), dt.date(2000, 3, 20)),
    Span("H", dt.date(2000, 3, 10), dt.date(2000, 3, 5)),
]


@pytest.mark.parametrize("span", SPANS, ids=str)
def test_grid_is_the_range_join(spark, span):
    rng = random.Random(1)
    base = dt.date(1999, 11, 1)
    recs = []
    for i in range(150):
        a = base + dt.timedelta(days=rng.randrange(800))
        recs.append((i, a, a + dt.timedelta(days=rng.randrange(-5, 500))))
    recs += [(900, None, dt.date(2001, 1, 1)), (901, dt.date(1999, 1, 1), dt.date(2041, 1, 1))]
    frame = spark.createDataFrame(recs, "id int, from_date date, thru_date date")
    found = as_set(N.expand(frame, span), "id", "snapshot_date")
    wanted = sorted(
        (str(i), str(p))
        for i, a, b in recs if a and b
        for p in brute_points(span) if a <= p <= b
    )
    assert found == wanted


@pytest.mark.parametrize("span", SPANS, ids=str)
def test_calendar(spark, span):
    days = [(dt.date(1999, 12, 1) + dt.timedelta(days=i),) for i in range(700)]
    frame = spark.createDataFrame(days, "calendar_date date")
    assert as_set(N.snapshot_calendar(frame, span)) == sorted(
        (str(p),) for p in brute_points(span) if dt.date(1999, 12, 1) <= p <= days[-1][0]
    )


@pytest.mark.parametrize("span", SPANS[:5], ids=str)
def test_totals_to_date_are_the_theta_join(spark, span):
    rng = random.Random(2)
    base = dt.date(1999, 11, 1)

    def day(n):
        return base + dt.timedelta(days=rng.randrange(n))

    recs = [(i % 12, f := day(600), f + dt.timedelta(days=rng.randrange(400))) for i in range(30)]
    detail = [(rng.randrange(15), day(700), rng.choice([None, 1, 2, 5])) for _ in range(300)]
    records = spark.createDataFrame(recs, "id int, from_date date, thru_date date")
    charges = spark.createDataFrame(detail, "id int, day date, q int")
    measures = {"q": F.col("q"), "n": F.lit(1)}
    found = as_set(
        N.totals_to_date(records, charges, span, ["id"], "day", measures),
        "id", "snapshot_date", "q", "n",
    )
    wanted = []
    for i in {r[0] for r in recs}:
        for p in brute_points(span):
            covering = sum(1 for r in recs if r[0] == i and r[1] <= p <= r[2])
            seen = [q for k, d, q in detail if k == i and d <= p]
            if covering and seen:
                known = [q for q in seen if q is not None]
                total = sum(known) * covering if known else None
                wanted.append((str(i), str(p), str(total), str(len(seen) * covering)))
    assert found == sorted(wanted)


def test_run_types():
    assert N.start_date("H") == dt.date(2022, 7, 1)
    assert N.start_date("I") == dt.date(2013, 1, 1)
    assert N.start_date("I", high_water=dt.date(2020, 1, 1)) == dt.date(2020, 1, 1)
    assert N.start_date("S", given=dt.date(2021, 1, 1)) == dt.date(2021, 1, 1)
    for call in (lambda: N.start_date("X"), lambda: N.start_date("S")):
        with pytest.raises(ValueError):
            call()
    with pytest.raises(ValueError):
        Span("Q", dt.date(2020, 1, 1), dt.date(2021, 1, 1))


def test_full_run_ends_yesterday():
    assert Span("H", dt.date(2020, 1, 1), dt.date(2021, 1, 1)).last == dt.date(2020, 12, 31)
    assert Span("I", dt.date(2020, 1, 1), dt.date(2021, 1, 1)).last == dt.date(2021, 1, 1)


def test_grid_plan_has_no_nested_loop(spark):
    frame = spark.range(5).selectExpr(
        "id", "date'2000-01-01' as from_date", "date'2001-01-01' as thru_date"
    )
    days = spark.range(400).selectExpr("date_add(date'2000-01-01', cast(id as int)) calendar_date")
    plan = N.snapshot_grid(frame, SPANS[0], days)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan
