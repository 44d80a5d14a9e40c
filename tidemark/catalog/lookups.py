"""Lookups, one row per key, scalar functions and predicates."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog.fixtures import SPAN
from tidemark.catalog.registry import Inputs, query
from tidemark.functions import (
    fold,
    is_month_end,
    nth_token,
    replace_date,
    text_key,
)
from tidemark.operators import fixed as X
from tidemark.operators import lookup as L
from tidemark.operators.latest import latest_rows
from tidemark.operators.snapshot import snapshot_grid
from tidemark.plans.joins import lookup_join


@query(f"""
    SELECT c.tenant, c.record_id, c.post_date, c.item_code, g.group_code AS item_group
    FROM charges c LEFT JOIN groups g ON g.source_key = c.item_code
      AND g.family = '{X.F_CHARGE}' AND c.post_date BETWEEN g.start_date AND g.end_date
""")
def dated_code_lookup(t: Inputs):
    rows = t.charges.select("tenant", "record_id", "post_date", "item_code")
    return L.dated_lookup(rows, t.groups, X.F_CHARGE, "item_code", "item_group", "post_date")


@query(f"""
    SELECT c.tenant, c.record_id, c.post_date, g.group_code AS procedure_group
    FROM charges c LEFT JOIN terms m ON m.source_key = c.procedure_code
    LEFT JOIN groups g ON g.source_key = m.term_key AND g.family = '{X.F_SERVICE}'
      AND c.post_date BETWEEN g.start_date AND g.end_date
""")
def two_hop_lookup(t: Inputs):
    rows = t.charges.select("tenant", "record_id", "post_date", "procedure_code")
    return L.conformed_lookup(
        rows, t.terms, t.groups, X.F_SERVICE, "procedure_code", "procedure_group", "post_date"
    ).drop("procedure_code")


def _slot(i: int) -> str:
    return f"""LEFT JOIN groups g{i} ON g{i}.source_key = r.payer{i}_code
      AND g{i}.family = '{X.F_SERVICE}' AND r.from_date BETWEEN g{i}.start_date AND g{i}.end_date"""


@query(f"""
    SELECT r.tenant, r.record_id, r.from_date, g1.group_code AS payer1_group,
           g2.group_code AS payer2_group, g3.group_code AS payer3_group,
           g4.group_code AS payer4_group
    FROM records r {_slot(1)} {_slot(2)} {_slot(3)} {_slot(4)}
""")
def four_slot_lookup(t: Inputs):
    slots = {f"payer{i}_code": f"payer{i}_group" for i in (1, 2, 3, 4)}
    rows = t.records.select("tenant", "record_id", "from_date", *slots)
    return L.slot_lookup(rows, t.groups, X.F_SERVICE, slots, "from_date").drop(*slots)


@query("""
    SELECT r.tenant, r.record_id, r.from_date, c.class_kind
    FROM records r LEFT JOIN classes c ON c.source_key = r.class_code
""")
def class_kind_lookup(t: Inputs):
    rows = t.records.select("tenant", "record_id", "from_date", "class_code")
    return L.flat_lookup(
        rows, t.classes, "source_key", "class_kind", "class_code", "class_kind"
    ).drop("class_code")


@query("""
    SELECT l_orderkey, l_partkey, l_linenumber, p_type, p_brand
    FROM lineitem LEFT JOIN part ON CASE WHEN p_size <= 25 THEN p_partkey END = l_partkey
""")
def large_table_lookup(t: Inputs):
    """A lookup table past the broadcast bound: the salted shuffle join; large parts have no key."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    key = F.when(F.col("p_size") <= 25, F.col("p_partkey")).alias("__part")
    side = t.part.select(key, "p_type", "p_brand")
    return lookup_join(rows, side, [("l_partkey", "__part")], salts=8, small=False).drop("__part")


@query("""
    SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate
    FROM orders QUALIFY row_number() OVER
      (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_row_per_key(t: Inputs):
    rows = t.orders.select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date")
    )
    return latest_rows(
        rows, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    )


@query("""
    SELECT o.o_custkey, o.o_orderkey, n.o_orderkey AS newest_order
    FROM orders o LEFT JOIN (
      SELECT * FROM orders QUALIFY row_number() OVER
        (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) n
    ON n.o_custkey = o.o_custkey AND n.o_orderdate = o.o_orderdate
""")
def latest_version_join(t: Inputs):
    """Join the newest version only."""
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    newest = latest_rows(
        rows, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    ).withColumnRenamed("o_orderkey", "newest_order")
    return rows.join(newest, ["o_custkey", "o_orderdate"], "left").drop("o_orderdate")


@query("""
    SELECT tenant, record_id, snapshot_date, authority FROM (
      SELECT r.record_id, r.tenant, r.authority, m.snapshot_date
      FROM records r JOIN (
        SELECT calendar_date AS snapshot_date FROM period_calendar
        WHERE (calendar_date = last_day(calendar_date) OR calendar_date = DATE '2001-06-15')
        AND calendar_date BETWEEN DATE '2000-06-30' AND DATE '2001-06-16') m
      ON m.snapshot_date BETWEEN r.from_date AND r.thru_date)
    QUALIFY row_number() OVER
      (PARTITION BY tenant, record_id, snapshot_date ORDER BY authority DESC) = 1
""")
def top_authority_per_snapshot(t: Inputs):
    grid = snapshot_grid(t.records, SPAN, t.period_calendar)
    rows = grid.select("tenant", "record_id", "snapshot_date", "authority")
    return latest_rows(
        rows, ["tenant", "record_id", "snapshot_date"], [F.col("authority").desc()]
    )


@query("""
    SELECT record_id, tenant, from_date,
           coalesce(payer4_code, 'none') AS payer,
           class_code || '/' || payer4_code AS both_codes,
           upper(payer1_code) AS upper_code,
           trim('  ' || drg_code || ' ') AS trimmed,
           list_filter(string_split_regex(org1_code, '[|_]'), lambda x: x <> '')[2] AS token_2,
           list_filter(string_split_regex(org1_code, '[|_]'), lambda x: x <> '')[4] AS token_4,
           split_part(org1_code, '|', 3) AS part_3,
           -TRY_CAST(CASE WHEN class_code = 'X' THEN 'x' ELSE CAST(record_id AS VARCHAR) END
                     AS BIGINT) AS negated,
           strptime(strftime(from_date, '%Y%m%d'), '%Y%m%d')::DATE AS parsed_date,
           strftime(from_date, '%Y-%m-%d') AS date_text,
           CAST(record_id AS VARCHAR) AS number_text,
           last_day(from_date) AS month_end,
           from_date = last_day(from_date) AS at_month_end,
           CAST(from_date - 31 AS DATE) AS month_ago,
           coalesce(class_code, 'NA') || coalesce(payer4_code, 'NA') AS change_key,
           rtrim(upper('x' || lower(drg_code) || '  ')) = rtrim(upper('X' || drg_code)) AS same_text,
           class_code <> 'O' AS not_o, payer4_code <> 'F' AS not_f,
           payer4_code IN ('F', 'X') AS in_list,
           CASE WHEN payer4_code NOT IN ('F', 'X') THEN 1 ELSE 0 END AS not_in_list,
           starts_with(org1_code, '750|') AS has_prefix
    FROM records
""")
def scalar_functions(t: Inputs):
    token = nth_token(F.col("org1_code"), "|_", 2)
    text = F.when(F.col("class_code") == "X", "x").otherwise(F.col("record_id").cast("string"))
    day = F.col("from_date")
    return t.records.select(
        "record_id",
        "tenant",
        "from_date",
        F.coalesce("payer4_code", F.lit("none")).alias("payer"),
        F.concat("class_code", F.lit("/"), "payer4_code").alias("both_codes"),
        F.upper("payer1_code").alias("upper_code"),
        F.trim(F.concat(F.lit("  "), "drg_code", F.lit(" "))).alias("trimmed"),
        token.alias("token_2"),
        nth_token(F.col("org1_code"), "|_", 4).alias("token_4"),
        F.split_part("org1_code", F.lit("|"), F.lit(3)).alias("part_3"),
        (-text.try_cast("bigint")).alias("negated"),
        F.to_date(F.date_format(day, "yyyyMMdd"), "yyyyMMdd").alias("parsed_date"),
        F.date_format(day, "yyyy-MM-dd").alias("date_text"),
        F.col("record_id").cast("string").alias("number_text"),
        F.last_day(day).alias("month_end"),
        is_month_end(day).alias("at_month_end"),
        F.date_sub(day, 31).alias("month_ago"),
        text_key(["class_code", "payer4_code"]).alias("change_key"),
        (
            fold(F.concat(F.lit("x"), F.lower("drg_code"), F.lit("  ")))
            == fold(F.concat(F.lit("X"), "drg_code"))
        ).alias("same_text"),
        (F.col("class_code") != "O").alias("not_o"),
        (F.col("payer4_code") != "F").alias("not_f"),
        F.col("payer4_code").isin("F", "X").alias("in_list"),
        F.when(~F.col("payer4_code").isin("F", "X"), 1).otherwise(0).alias("not_in_list"),
        F.col("org1_code").startswith("750|").alias("has_prefix"),
    )


@query("""
    SELECT tenant, record_id, post_date, quantity FROM charges
    WHERE post_date >= DATE '2001-06-16' - 31 AND coalesce(quantity, 0) > 0
""")
def recent_activity(t: Inputs):
    since = SPAN.run_date - dt.timedelta(days=31)
    return t.charges.where(
        (F.col("post_date") >= F.lit(since)) & (F.coalesce(F.col("quantity"), F.lit(0)) > 0)
    ).select("tenant", "record_id", "post_date", "quantity")


@query("""
    SELECT person_id, name_type, family_name, given_name FROM names
    WHERE name_type = 'GVN_NM' AND (family_name IN ('TEST', 'Zztest')
      OR family_name || given_name LIKE '%HNAM%TEST%' OR upper(given_name) LIKE 'MACH%')
      AND family_name NOT LIKE 'Customer#%9'
""")
def like_and_lists(t: Inputs):
    full = F.concat("family_name", "given_name")
    return t.names.where(F.col("name_type") == "GVN_NM").where(
        (
            F.col("family_name").isin("TEST", "Zztest")
            | full.like("%HNAM%TEST%")
            | F.upper("given_name").like("MACH%")
        )
        & ~F.col("family_name").like("Customer#%9")
    )


@query("""
    SELECT tenant, record_id, CASE WHEN discharge_date = DATE '1111-11-11' THEN DATE '2001-06-15'
           ELSE discharge_date END AS discharged_on FROM admissions
""")
def sentinel_date(t: Inputs):
    on = replace_date(F.col("discharge_date"), X.UNKNOWN_DISCHARGE, F.lit(SPAN.yesterday))
    return t.admissions.select("tenant", "record_id", on.alias("discharged_on"))


@query("SELECT * FROM records WHERE tenant = '2-HIGH' AND record_id > 0")
def tenant_positive_ids(t: Inputs):
    return t.records.where((F.col("tenant") == "2-HIGH") & (F.col("record_id") > 0))
