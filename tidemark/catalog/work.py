"""Work queue, semi and anti joins."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog.fixtures import RUN_DATE, SPAN
from tidemark.catalog.registry import Inputs, query
from tidemark.operators import workqueue as W
from tidemark.plans.joins import either_key_matches, not_in

NOW = dt.datetime(2001, 6, 16)
PENDING = """(result_date IS NULL OR result_date < extract_date
    OR coalesce(result_date, DATE '2041-01-01') >= DATE '2000-06-30')"""


@query(f"SELECT DISTINCT tenant, record_id FROM queue WHERE {PENDING}")
def pending_work(t: Inputs):
    return W.pending_keys(t.queue, SPAN.run_type, SPAN.start)


@query("""
    SELECT DISTINCT tenant, record_id FROM queue
    WHERE result_date IS NULL OR result_date < extract_date
""")
def pending_work_incremental(t: Inputs):
    return W.pending_keys(t.queue, "I", SPAN.start)


@query(f"""
    SELECT r.tenant, r.record_id, r.from_date FROM records r WHERE EXISTS (
      SELECT 1 FROM queue q WHERE q.tenant = r.tenant AND q.record_id = r.record_id
      AND {PENDING})
""")
def pending_work_semi(t: Inputs):
    pending = W.pending_keys(t.queue, SPAN.run_type, SPAN.start)
    return W.only_pending(t.records.select("tenant", "record_id", "from_date"), pending)


@query("""
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
      SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 12)
""")
def in_group_semi(t: Inputs):
    many = t.orders.groupBy("o_custkey").count().where("count >= 12").select("o_custkey")
    return t.orders.select("o_orderkey", "o_custkey").join(many, "o_custkey", "left_semi")


@query("""
    SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (
      SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R'
      AND CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE))
""")
def not_exists_anti(t: Inputs):
    # Only the last return of an order can decide, so an order with many lines is one row here.
    returned = (
        t.lineitem.where("l_returnflag = 'R'")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").cast("date").alias("last_return"))
    )
    test = (F.col("o_orderkey") == F.col("l_orderkey")) & (
        F.col("last_return") >= F.col("o_orderdate").cast("date")
    )
    return t.orders.join(returned, test, "left_anti").select("o_orderkey", "o_orderstatus")


@query("""
    SELECT o_orderkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    WHERE l_orderkey IS NULL
""")
def left_join_is_null(t: Inputs):
    keys = t.lineitem.select("l_orderkey").distinct()
    return t.orders.join(
        keys, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"
    ).select("o_orderkey")


@query("""
    SELECT o_orderkey, 'plain' AS list FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL
    SELECT o_orderkey, 'with null' FROM orders
    WHERE o_orderkey NOT IN (SELECT nullif(l_orderkey, 1) FROM lineitem)
""")
def not_in_null_aware(t: Inputs):
    listed = t.lineitem.select("l_orderkey")
    holed = listed.select(F.nullif(F.col("l_orderkey"), F.lit(1)).alias("l_orderkey"))
    keys = t.orders.select("o_orderkey")
    plain = not_in(keys, "o_orderkey", listed, "l_orderkey").withColumn("list", F.lit("plain"))
    with_null = not_in(keys, "o_orderkey", holed, "l_orderkey")
    return plain.unionByName(with_null.withColumn("list", F.lit("with null")))


NEWEST = """SELECT * FROM sources QUALIFY row_number() OVER (PARTITION BY source_key, tenant
    ORDER BY modified_at DESC, added_at DESC, record_id DESC) = 1"""


@query(f"""
    SELECT DISTINCT e.tenant, e.record_id FROM ({NEWEST}) e JOIN queue q ON q.tenant = e.tenant
      AND (q.record_id = e.record_id OR q.record_id = -TRY_CAST(e.source_key AS BIGINT))
""")
def or_key_join(t: Inputs):
    return W.already_queued(t.sources, t.queue)


@query("""
    SELECT DISTINCT c.c_custkey FROM customer c JOIN orders o
      ON o.o_custkey = c.c_custkey OR o.o_orderkey = c.c_nationkey
""")
def or_key_semi(t: Inputs):
    return either_key_matches(
        t.customer,
        t.orders,
        [[("c_custkey", "o_custkey")], [("c_nationkey", "o_orderkey")]],
        ["c_custkey"],
    )


@query(f"""
    SELECT DISTINCT r.record_id, r.authority, r.tenant FROM records r
    LEFT JOIN known_history h ON h.tenant = r.tenant AND h.record_id = r.record_id
    WHERE r.thru_date = DATE '2041-01-01' AND h.record_id IS NULL AND r.record_id > 0
    AND (r.tenant, r.record_id) NOT IN (SELECT e.tenant, e.record_id FROM ({NEWEST}) e
      JOIN queue q ON q.tenant = e.tenant
      AND (q.record_id = e.record_id OR q.record_id = -TRY_CAST(e.source_key AS BIGINT)))
""")
def missing_work_anti(t: Inputs):
    return W.missing_work(t.records, t.known_history, t.queue, t.sources)


RECENT = """SELECT DISTINCT r.tenant, r.record_id FROM records r JOIN charges c
    ON c.tenant = r.tenant AND c.record_id = r.record_id
    WHERE r.thru_date = DATE '2041-01-01' AND coalesce(c.quantity, 0) > 0
    AND c.post_date >= DATE '2001-05-16'"""


@query(f"""
    SELECT q.record_id, q.authority, q.tenant, q.extract_date,
           CASE WHEN r.record_id IS NULL THEN q.result_date END AS result_date,
           CASE WHEN r.record_id IS NULL THEN q.job_id ELSE 7 END AS job_id,
           CASE WHEN r.record_id IS NULL THEN q.modified_at
                ELSE TIMESTAMP '2001-06-16 00:00:00' END AS modified_at
    FROM queue q LEFT JOIN ({RECENT}) r ON r.tenant = q.tenant AND r.record_id = q.record_id
""")
def requeue_recent(t: Inputs):
    recent = W.recently_charged(t.records, t.charges, RUN_DATE)
    return W.requeue(t.queue, recent, NOW, 7).drop("added_at")


@query("""
    SELECT q.record_id, q.authority, q.tenant, q.extract_date,
           CASE WHEN hit THEN DATE '2001-06-16' ELSE result_date END AS result_date,
           CASE WHEN hit THEN 7 ELSE job_id END AS job_id
    FROM (SELECT q.*, (result_date IS NULL OR result_date < extract_date)
            AND EXISTS (SELECT 1 FROM known_history h WHERE h.tenant = q.tenant
                        AND h.record_id = q.record_id) AS hit FROM queue q) q
""")
def mark_processed(t: Inputs):
    return W.mark_done(t.queue, t.known_history, RUN_DATE, NOW, 7).drop(
        "added_at", "modified_at"
    )
