"""Inputs of the operators, derived from the test tables.

Each is one SELECT that Spark and DuckDB read alike; ``{name}`` refers to a test table or to
another fixture. All rows of the tables take part.
"""

from __future__ import annotations

import datetime as dt

from tidemark.operators import fixed as X
from tidemark.operators.classify import Settings
from tidemark.operators.snapshot import Span

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# The run the snapshot queries stand for.
START = dt.date(2000, 6, 30)
RUN_DATE = dt.date(2001, 6, 16)
SPAN = Span("S", START, RUN_DATE)
SETTINGS = Settings(
    skilled_nursing_tenants=("1-URGENT", "2-HIGH"),
    skilled_nursing_after=dt.date(1999, 12, 31),
    balance_flag_exempt=("3-MEDIUM", "5-LOW"),
    excluded_authority=23,
    diagnoses_since=dt.date(1999, 1, 1),
)


def _extract(day: str) -> str:
    """The state as of ``day``: customers and priorities whose last order is not finished."""
    return f"""
    SELECT CAST(o_custkey AS STRING) AS client_id, o_orderpriority AS claim_id,
           max(o_orderstatus) AS status, nullif(min(o_orderstatus), 'F') AS first_status,
           max(c_mktsegment) AS segment
    FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
    WHERE CAST(o_orderdate AS DATE) <= DATE '{day}'
    GROUP BY o_custkey, o_orderpriority
    HAVING max_by(o_orderstatus, o_orderkey) <> 'F'
    """


# An order is a record, its priority the tenant; small orders have the negated id.
_ORDERED = """
    SELECT o_orderpriority AS tenant,
           CASE WHEN o_totalprice < 15000 THEN -o_orderkey ELSE o_orderkey END AS record_id,
           o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           CAST(o_orderdate AS DATE) AS day
    FROM {orders}
"""

_ORDER_FACTS = """
    SELECT *, CAST(c_nationkey AS SMALLINT) AS authority,
           'NATION_' || CAST(c_nationkey AS STRING) AS nation_name
    FROM {ordered} JOIN {customer} ON o_custkey = c_custkey
"""

_RECORDS = """
    SELECT tenant, record_id, authority, day AS from_date,
           CASE WHEN o_orderstatus = 'F' THEN day + 90 ELSE DATE '2041-01-01' END AS thru_date,
           CASE WHEN o_totalprice < 25000 THEN 'X' WHEN o_totalprice < 50000 THEN 'N'
                ELSE o_orderstatus END AS class_code,
           'T' || CAST(c_nationkey AS STRING) AS type_code, c_mktsegment AS drg_code,
           CASE WHEN c_nationkey = 16 THEN '750|' ELSE '100|' END || nation_name AS org1_code,
           nation_name AS org3_code,
           CASE WHEN c_nationkey = 24 THEN 'vita-' ELSE '' END || lower(nation_name)
             AS payer1_code,
           c_mktsegment AS payer2_code, tenant AS payer3_code,
           nullif(o_orderstatus, 'O') AS payer4_code,
           CASE WHEN o_orderstatus = 'F' THEN day + 10 END AS discharge_date,
           CASE WHEN o_totalprice > 490000 THEN 'Y' ELSE 'N' END AS extra_balance_flag
    FROM {order_facts}
    UNION ALL
    SELECT tenant, record_id, authority, day + 91, DATE '2041-01-01', 'O',
           'T' || CAST(c_nationkey AS STRING), c_mktsegment, '100|' || nation_name, nation_name,
           lower(nation_name), c_mktsegment, tenant, CAST(NULL AS STRING), day + 10, 'N'
    FROM {order_facts} WHERE o_orderstatus = 'F'
"""

_LINE_FACTS = """
    SELECT tenant, record_id, o_custkey, day, CAST(l_shipdate AS DATE) AS ship_date, l_linenumber,
           CAST(nullif(l_quantity, 50) AS DECIMAL(19, 3)) AS quantity,
           CAST(l_extendedprice AS DECIMAL(20, 2)) AS amount,
           l_returnflag, l_linestatus, p_type, p_brand, CAST(p_size AS STRING) AS p_size
    FROM {lineitem}
    JOIN {part} ON l_partkey = p_partkey
    JOIN {ordered} ON l_orderkey = o_orderkey
"""

_TERMS = """
    SELECT * FROM (VALUES
      ('T0', 'TT0'), ('T1', 'TT1'), ('T2', 'TT2'), ('T3', 'TT3'), ('T4', 'TT4'), ('T5', 'TT5'),
      ('T6', 'TT6'), ('T7', 'TT7'), ('T8', 'TT8'), ('T9', 'TY1'), ('T10', 'TY1'),
      ('T12', 'TY2'), ('T13', 'TY2'), ('T14', 'TY2'), ('T15', 'HI|TY3|X'), ('T16', 'HI|TY3|X'),
      ('T17', 'HI|TY3|X'), ('T18', 'TY4'), ('T19', 'TY4'), ('T20', 'TY5'), ('T21', 'TY5'),
      ('T22', 'TY6'),
      ('BUILDING', 'SEG1'), ('MACHINERY', 'SEG2'), ('FURNITURE', 'SEG3'),
      ('PROMO', 'DX1'), ('SMALL', 'DX2'), ('MEDIUM', 'DX3'),
      ('19', 'PX1'), ('20', 'PX2'), ('21', 'PX1')
    ) AS t(source_key, term_key)
"""


def _groups() -> str:
    low, high = "1900-01-01", "2041-01-01"
    rows = [
        ("PROMO", X.G_SURGERY, X.F_CHARGE, low, "2000-12-31"),
        ("PROMO", X.G_EMERGENCY, X.F_CHARGE, "2001-01-01", high),
        ("ECONOMY", X.G_ER_VISIT, X.F_CHARGE, low, "2000-11-14"),
        ("SMALL", "WATCH", X.F_CHARGE, low, high),
        ("LARGE", X.G_COVID, X.F_CHARGE, "2000-09-01", "2000-12-31"),
        ("MEDIUM", X.G_SURGERY, X.F_CHARGE, "2001-03-01", high),
        ("STANDARD", X.G_SURGERY, X.F_CHARGE, low, high),
        ("STANDARD", X.G_COVID, X.F_CHARGE, "2001-02-01", high),
        ("Brand#1", X.G_SURGERY, X.F_DEPARTMENT, low, high),
        ("Brand#2", X.G_SURGERY, X.F_DEPARTMENT, low, "2001-04-30"),
        ("Brand#3", X.G_EMERGENCY, X.F_DEPARTMENT, low, high),
        ("Brand#4", X.G_REHAB, X.F_DEPARTMENT, low, high),
        ("Brand#5", X.G_OUT_BEHAVIORAL, X.F_DEPARTMENT, low, high),
        ("A", X.G_BEHAVIORAL_LOCATION, X.F_DEPARTMENT, "2000-10-15", high),
        ("PX1", X.G_COVID, X.F_SERVICE, "2000-08-01", high),
        ("PX2", X.G_COVID_TEST, X.F_SERVICE, low, high),
        ("DX1", X.G_COVID, X.F_SERVICE, "2000-01-01", "2000-12-31"),
        ("DX2", X.G_COVID_TEST, X.F_SERVICE, low, high),
        ("DX3", "OTHER", X.F_SERVICE, low, high),
        ("SEG1", X.G_NORMAL_NEWBORN, X.F_SERVICE, low, high),
        ("SEG2", X.G_UNCODED, X.F_SERVICE, low, high),
        ("SEG3", X.G_DELIVERY, X.F_SERVICE, low, "2001-01-15"),
        ("nation_3", X.G_COVID, X.F_SERVICE, "2000-07-01", "2001-01-31"),
        ("MACHINERY", "OTHER", X.F_SERVICE, low, high),
        ("HOUSEHOLD", X.G_COVID, X.F_SERVICE, "2000-08-15", "2000-10-31"),
        ("P", X.G_COVID, X.F_SERVICE, "2001-05-01", high),
        ("TY1", X.G_EMERGENCY, X.F_TYPE, low, high),
        ("TY2", X.G_ACUTE, X.F_TYPE, low, high),
        ("TY2", X.G_BEHAVIORAL, X.F_TYPE, "2001-01-01", high),
        ("HI|TY3|X", X.G_NEWBORN, X.F_TYPE, low, high),
        ("TY4", X.G_BEHAVIORAL, X.F_TYPE, low, "2000-12-31"),
        ("TY5", X.G_SERIES, X.F_TYPE, low, "2001-02-28"),
        ("TT0", X.G_JOINT_VENTURE, X.F_TYPE, low, high),
        ("TT1", X.G_LONG_TERM, X.F_TYPE, low, high),
        ("TT2", X.G_RESPITE, X.F_TYPE, low, high),
        ("TT3", X.G_REHAB, X.F_TYPE, low, high),
        ("TT4", X.G_SKILLED_NURSING, X.F_TYPE, low, high),
        ("TT5", X.G_HEAD_PAIN, X.F_TYPE, low, high),
        ("TT6", X.G_URGENT_CARE, X.F_TYPE, low, high),
        ("TT7", X.G_EXCLUDE, X.F_TYPE, low, high),
        ("TT8", X.G_NONPATIENT, X.F_TYPE, low, high),
        ("NATION_7", X.G_NONPATIENT, X.F_TYPE, low, "2000-12-31"),
    ]
    values = ",\n".join(
        f"('{s}', '{g}', '{f}', DATE '{a}', DATE '{b}')" for s, g, f, a, b in rows
    )
    return (
        f"SELECT * FROM (VALUES {values}) "
        "AS t(source_key, group_code, family, start_date, end_date)"
    )


# Customers' orders by day as history rows; a day with several orders is one row.
_CUSTOMER_DAYS = """
    SELECT c_mktsegment AS tenant, o_custkey AS record_id, day AS from_date,
           max(authority) AS authority, min(o_orderstatus) AS first_status,
           max(o_orderstatus) AS last_status, nullif(min(tenant), '5-LOW') AS priority,
           max(o_orderdate) AS seen_at
    FROM {order_facts} GROUP BY c_mktsegment, o_custkey, day
"""


def _stored(until: str) -> str:
    return f"""
    SELECT record_id, from_date, authority, tenant, CAST(1 AS BIGINT) AS job_id,
           seen_at AS added_at, seen_at AS modified_at,
           coalesce(lead(from_date) OVER (PARTITION BY tenant, record_id ORDER BY from_date) - 1,
                    DATE '2041-01-01') AS thru_date,
           first_status AS patient_class, priority AS service_line_1
    FROM {{customer_days}} WHERE from_date <= DATE '{until}'
    """


# The type-2 target's 31 text columns, of a customer (c) and a row of an extract (e).
_SURVEY = {
    "Survey_Designator": "'S' || e.status",
    "Client_ID": "e.client_id",
    "Hosp_Service_Code": "substr(e.segment, 1, 3)",
    "Medical_Rec_No": "c.c_name",
    "Claim_Id": "e.claim_id",
    "Race": "nullif(substr(e.claim_id, 1, 1), '4')",
    "Carrier": "e.segment",
    "DOB": "CAST(DATE '1950-01-01' + c.c_nationkey AS STRING)",
    "Gender": "CASE WHEN c.c_acctbal < 0 THEN 'F' WHEN c.c_acctbal < 9000 THEN 'M' END",
    "Last_Name": "c.c_name",
    "First_Name": "c.c_mktsegment",
    "Middle_Name": "CAST(NULL AS STRING)",
    "Address1": "CAST(c.c_custkey AS STRING) || ' Main St'",
    "Address2": "CAST(NULL AS STRING)",
    "City": "'City ' || CAST(c.c_nationkey AS STRING)",
    "State": "CAST(c.c_nationkey AS STRING)",
    "Zip": "CAST(10000 + c.c_nationkey AS STRING)",
    "Discharge_Date": "CAST(NULL AS STRING)",
    "Discharge_status_id": "e.first_status",
    "Time_of_arrival": "'0800'",
    "Pt_type": "e.status",
    "Nursing_station": "'N' || CAST(c.c_nationkey AS STRING)",
    "Sub_Group": "lower(e.segment)",
    "Minor_pt_type": "e.first_status",
    "Attending_Physician": "'Dr ' || CAST(c.c_nationkey AS STRING)",
    "Marital_Status": "CAST(NULL AS STRING)",
    "Patient_Phone_Nbr": "'555-' || CAST(c.c_custkey AS STRING)",
    "Financial_Class": "substr(c.c_mktsegment, 1, 1)",
    "Room": "substr(e.claim_id, 3, 2)",
    "Bed": "e.status",
}


def _surveys(extract: str, file: str) -> str:
    columns = ",\n           ".join(f"{text} AS {name}" for name, text in _SURVEY.items())
    return f"""
    SELECT {columns}, '{file}' AS file_name
    FROM {{{extract}}} e JOIN {{customer}} c ON CAST(c.c_custkey AS STRING) = e.client_id
    """


FIXTURES = {
    "jobs": """
    SELECT event_id AS run_id, event_type AS application,
           event_type || '-' || CAST(user_id AS STRING) AS job_member_name, ts AS start_time,
           CAST(floor(value * 20) AS INT) AS runtime,
           CASE WHEN event_type = 'error' AND value > 40 THEN 'ended not ok'
                WHEN value < 0.5 THEN NULL ELSE 'ended ok' END AS completion_status
    FROM {events}
    """,
    "stage": _extract("2001-12-31"),
    "open_extract": _extract("1999-06-30"),
    "closed_extract": _extract("1998-12-31"),
    "target": """
    SELECT client_id, claim_id, status, first_status, segment,
           DATE '1999-06-30' AS effective_date, '9999-12-31' AS termination_date
    FROM {open_extract}
    UNION ALL
    SELECT client_id, claim_id, status, first_status, segment,
           DATE '1998-12-31', '1999-06-30'
    FROM {closed_extract}
    """,
    # The same with one priority unknown: keys with a NULL part, several of them per customer.
    "null_stage": """
    SELECT client_id, nullif(claim_id, '5-LOW') AS claim_id, status, first_status, segment
    FROM {stage}
    """,
    "null_target": """
    SELECT client_id, nullif(claim_id, '5-LOW') AS claim_id, status, first_status, segment,
           effective_date, termination_date
    FROM {target}
    """,
    "period_calendar": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS calendar_date FROM {orders}",
    "ordered": _ORDERED,
    "order_facts": _ORDER_FACTS,
    "line_facts": _LINE_FACTS,
    "records": _RECORDS,
    "charges": """
    SELECT tenant, record_id, ship_date AS post_date, quantity, amount, p_type AS item_code,
           p_brand AS dept_code, l_returnflag AS location_code, p_size AS procedure_code
    FROM {line_facts}
    """,
    "balances": """
    SELECT tenant, record_id, day AS from_date, day + 180 AS thru_date,
           CASE WHEN o_orderstatus = 'O' THEN NULL
                WHEN o_totalprice < 300000 THEN CAST(0 AS DECIMAL(20, 2))
                ELSE CAST(o_totalprice AS DECIMAL(20, 2)) END AS total_charge
    FROM {ordered}
    UNION ALL
    SELECT tenant, record_id, day + 181, DATE '2041-01-01',
           CASE WHEN o_totalprice < 150000 THEN CAST(0 AS DECIMAL(20, 2))
                ELSE CAST(o_totalprice AS DECIMAL(20, 2)) END
    FROM {ordered}
    """,
    "admissions": """
    SELECT tenant, record_id, day AS admit_date,
           CASE WHEN o_totalprice NOT BETWEEN 480000 AND 490000 THEN o_orderdate
                END AS admitted_at,
           CASE WHEN o_orderstatus = 'P' THEN DATE '1111-11-11' ELSE day + 10
                END AS discharge_date,
           CASE WHEN o_totalprice NOT BETWEEN 480000 AND 490000 AND o_orderstatus <> 'P'
                THEN o_orderdate END AS discharged_at,
           CASE WHEN o_totalprice > 495000 THEN 'N' ELSE 'Y' END AS active
    FROM {ordered}
    """,
    "diagnoses": """
    SELECT tenant, record_id, nullif(p_type, 'LARGE') AS diagnosis_code,
           CASE WHEN l_returnflag = 'R' THEN 'W' ELSE '' END || l_linestatus AS diagnosis_type,
           l_linenumber - 1 AS sequence
    FROM {line_facts}
    """,
    "transactions": """
    SELECT tenant, record_id, p_brand || '/' || p_size AS item_code FROM {line_facts}
    """,
    "sources": """
    SELECT CASE WHEN o_totalprice > 450000 THEN 'X' ELSE '' END || CAST(l_orderkey AS STRING)
             AS source_key,
           tenant, l_orderkey AS record_id, o_custkey AS person_id,
           l_shipdate AS modified_at, o_orderdate AS added_at
    FROM {lineitem} JOIN {ordered} ON l_orderkey = o_orderkey
    """,
    "names": """
    SELECT c_custkey AS person_id, 'GVN_NM' AS name_type,
           CASE WHEN c_acctbal > 9900 THEN 'TEST' WHEN c_acctbal > 9800 THEN 'xHNAM'
                ELSE c_name END AS family_name,
           CASE WHEN c_acctbal > 9800 THEN 'myTESTer' ELSE c_mktsegment END AS given_name
    FROM {customer}
    UNION ALL
    SELECT c_custkey, 'ALIAS', 'TEST', c_mktsegment FROM {customer}
    WHERE c_mktsegment = 'BUILDING'
    """,
    "grouper": """
    SELECT tenant, record_id, day AS from_date, day + 400 AS thru_date,
           nullif(tenant, '5-LOW') AS line_group, nullif(c_mktsegment, 'HOUSEHOLD') AS line,
           CASE WHEN c_nationkey >= 3 THEN nation_name END AS care_family,
           CASE WHEN o_totalprice < 60000 THEN NULL
                WHEN o_orderstatus = 'F' THEN 'Ungroupable'
                WHEN o_orderstatus = 'O' THEN 'Outpatient:: ' || c_mktsegment || ' :x'
                ELSE c_mktsegment END AS procedure_text
    FROM {order_facts}
    """,
    "queue": """
    SELECT record_id, CAST(1 AS SMALLINT) AS authority, tenant, CAST(1 AS BIGINT) AS job_id,
           o_orderdate AS added_at, o_orderdate AS modified_at, day + 1 AS extract_date,
           CASE WHEN o_orderstatus = 'F' THEN day WHEN o_orderstatus = 'P' THEN day + 6
                END AS result_date
    FROM {ordered} WHERE o_orderstatus <> 'P' OR o_totalprice >= 60000
    """,
    "known_history": """
    SELECT tenant, record_id, day AS from_date FROM {ordered}
    WHERE o_orderstatus <> 'P'
    """,
    "classes": """
    SELECT * FROM (VALUES ('F', 'I'), ('P', 'I'), ('O', 'O'), ('N', 'N'))
      AS t(source_key, class_kind)
    """,
    "terms": _TERMS,
    "groups": _groups(),
    "item_groups": f"""
    SELECT * FROM (VALUES ('Brand#13/7', '{X.T_LEGACY}'), ('Brand#9/12', '{X.T_LEGACY}'),
      ('Brand#2/30', 'OTHER'), ('Brand#20/41', '{X.T_LEGACY}')) AS t(source_key, term_key)
    """,
    "customer_days": _CUSTOMER_DAYS,
    "active_customers": """
    SELECT tenant, record_id, min(from_date) AS from_date, DATE '2041-01-01' AS thru_date
    FROM {customer_days} GROUP BY tenant, record_id
    """,
    "staged_days": """
    SELECT tenant, record_id, from_date, authority, DATE '2041-01-01' AS thru_date,
           last_status AS patient_class, priority AS service_line_1
    FROM {customer_days} WHERE from_date > DATE '1999-12-31'
    """,
    "all_days": """
    SELECT tenant, record_id, from_date, authority, DATE '2041-01-01' AS thru_date,
           last_status AS patient_class, priority AS service_line_1
    FROM {customer_days}
    """,
    # Several orders of a customer in a month share a key.
    "month_rows": """
    SELECT c_mktsegment AS tenant, o_custkey AS record_id,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS from_date, authority,
           o_orderstatus AS patient_class, nullif(tenant, '5-LOW') AS line_1,
           nullif(nation_name, 'NATION_1') AS line_2
    FROM {order_facts}
    """,
    "surveys": _surveys("stage", "second.csv"),
    "old_surveys": f"""
    SELECT *, DATE '1999-06-30' AS effective_date, '9999-12-31' AS termination_date
    FROM ({_surveys("open_extract", "first.csv")}) x
    """,
    # Codes and keys written in either case and with trailing blanks.
    "mixed_charges": """
    SELECT tenant, record_id, post_date, quantity,
           CASE WHEN record_id % 2 = 0 THEN lower(item_code) || '  ' ELSE item_code END AS item_code,
           procedure_code || CASE WHEN record_id % 3 = 0 THEN ' ' ELSE '' END AS procedure_code
    FROM {charges}
    """,
    "mixed_groups": f"""
    SELECT CASE WHEN family = '{X.F_CHARGE}' THEN upper(source_key) || ' '
                ELSE lower(source_key) END AS source_key, group_code, family, start_date, end_date
    FROM {{groups}}
    """,
    "mixed_terms": "SELECT lower(source_key) || ' ' AS source_key, term_key FROM {terms}",
    "mixed_names": """
    SELECT person_id, lower(name_type) || ' ' AS name_type,
           CASE WHEN person_id % 2 = 0 THEN lower(family_name) ELSE family_name || ' ' END
             AS family_name, upper(given_name) AS given_name
    FROM {names}
    """,
    "mixed_stage": """
    SELECT client_id, lower(claim_id) || ' ' AS claim_id, status, lower(first_status) AS first_status,
           lower(segment) || '  ' AS segment
    FROM {stage}
    """,
    # Ten columns of the job report.
    "job_runs": """
    SELECT event_type AS application, event_type || '-' || CAST(user_id % 4 AS STRING)
             AS sub_application_name, CAST(user_id % 10 AS STRING) AS folder,
           event_type || '-' || CAST(user_id AS STRING) AS job_member_name,
           CASE WHEN event_id % 13 <> 0 THEN ts END AS order_date, ts AS start_time,
           CASE WHEN value >= 0.5 THEN ts END AS end_time, CAST(floor(value * 20) AS INT) AS runtime,
           CASE WHEN user_id % 5 <> 0 THEN 'user' || CAST(user_id AS STRING) END AS run_as_user,
           CASE WHEN event_type = 'error' AND value > 40 THEN 'ended not ok'
                WHEN value < 0.5 THEN NULL ELSE 'ended ok' END AS completion_status
    FROM {events}
    """,
    "stored_days": _stored("2000-03-31"),
    "stored_before": _stored("1999-12-31"),
}

# For Spark, the same rows of some of them, joined so that less is shuffled: a row's texts, dates and marks
# are made before a join where they are shorter than what they come from, and after it where not.
PLANNED = {
    "line_facts": """
    SELECT tenant, CASE WHEN low THEN -o_orderkey ELSE o_orderkey END AS record_id, o_custkey, day,
           ship_date, l_linenumber, CAST(nullif(l_quantity, 50) AS DECIMAL(19, 3)) AS quantity,
           CAST(l_extendedprice AS DECIMAL(20, 2)) AS amount,
           l_returnflag, l_linestatus, p_type, p_brand, CAST(p_size AS STRING) AS p_size
    FROM (SELECT l_orderkey, l_partkey, CAST(l_shipdate AS DATE) AS ship_date, l_linenumber,
                 l_quantity, l_extendedprice, l_returnflag, l_linestatus FROM {lineitem})
    JOIN {part} ON l_partkey = p_partkey
    JOIN (SELECT o_orderkey, o_custkey, o_orderpriority AS tenant, o_totalprice < 15000 AS low,
                 CAST(o_orderdate AS DATE) AS day FROM {orders}) ON l_orderkey = o_orderkey
    """,
    "records": """
    WITH joined AS (
      SELECT tenant, CASE WHEN low THEN -o_orderkey ELSE o_orderkey END AS record_id,
             CAST(c_nationkey AS SMALLINT) AS authority, day, o_orderstatus = 'F' AS finished,
             CASE WHEN below_25 THEN 'X' WHEN below_50 THEN 'N' ELSE o_orderstatus END AS class_code,
             o_orderstatus, c_nationkey, c_mktsegment,
             'NATION_' || CAST(c_nationkey AS STRING) AS nation_name,
             CASE WHEN high THEN 'Y' ELSE 'N' END AS flag
      FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority AS tenant,
                   CAST(o_orderdate AS DATE) AS day, o_totalprice < 15000 AS low,
                   o_totalprice < 25000 AS below_25, o_totalprice < 50000 AS below_50,
                   o_totalprice > 490000 AS high FROM {orders})
      JOIN {customer} ON o_custkey = c_custkey)
    SELECT tenant, record_id, authority, CASE WHEN again THEN day + 91 ELSE day END AS from_date,
           CASE WHEN finished AND NOT again THEN day + 90 ELSE DATE '2041-01-01' END AS thru_date,
           CASE WHEN again THEN 'O' ELSE class_code END AS class_code,
           'T' || CAST(c_nationkey AS STRING) AS type_code, c_mktsegment AS drg_code,
           CASE WHEN c_nationkey = 16 AND NOT again THEN '750|' ELSE '100|' END || nation_name
             AS org1_code,
           nation_name AS org3_code,
           CASE WHEN c_nationkey = 24 AND NOT again THEN 'vita-' ELSE '' END || lower(nation_name)
             AS payer1_code,
           c_mktsegment AS payer2_code, tenant AS payer3_code,
           CASE WHEN NOT again THEN nullif(o_orderstatus, 'O') END AS payer4_code,
           CASE WHEN finished THEN day + 10 END AS discharge_date,
           CASE WHEN again THEN 'N' ELSE flag END AS extra_balance_flag
    FROM joined LATERAL VIEW explode(CASE WHEN finished THEN array(false, true)
                                          ELSE array(false) END) e AS again
    """,
}
