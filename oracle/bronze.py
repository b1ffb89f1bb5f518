"""DuckDB CTEs for the bronze tables: text columns derived from the star-schema views."""

from __future__ import annotations

_HALF = "CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END"
_SEM = f"'S' || year(o_orderdate) || '-' || ({_HALF})"
_DAY = "CAST(o_orderdate AS DATE)"
_EXT = "CAST(l_extendedprice AS DECIMAL(12,2))"
_CENTS = f"CAST({_EXT} * 100 AS BIGINT)"
_QTY = "CAST(l_quantity AS BIGINT)"
_LINE = "l_orderkey || '-' || l_linenumber"


def _pick(index: str, *values: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


def _day(start: str, offset: str) -> str:
    return f"CAST(CAST(DATE '{start}' + CAST({offset} AS INTEGER) AS DATE) AS VARCHAR)"


BRONZE = {
    "b_students": f"""
SELECT CAST(c_custkey AS VARCHAR) AS student_id,
       upper(c_mktsegment) || ' ' AS first_name,
       'nation ' || c_nationkey AS last_name,
       ' ' || upper(c_name) || '@Campus.EDU' AS email,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE {_day('1980-01-01', 'c_custkey * 7 % 9000')} END AS birth_date,
       CASE WHEN c_custkey % 97 = 5 THEN 'soon'
            ELSE {_day('2000-01-01', 'c_custkey % 3000')} || ' 09:30:00' END AS enrolled_at,
       ' nation_' || c_nationkey AS country
FROM customer""",
    "b_professors": f"""
SELECT CAST(s_suppkey AS VARCHAR) AS professor_id, ' prof' AS first_name, upper(s_name) AS last_name,
       s_name || '@Campus.EDU ' AS email,
       {_pick('s_suppkey % 4', 'cs ', 'math', ' bio', 'law')} AS department,
       CASE WHEN s_suppkey % 10 = 3 THEN '??'
            ELSE {_day('1995-02-01', 's_suppkey % 4000')} || ' 00:00:00' END AS hired_at
FROM supplier""",
    "b_courses": """
SELECT CAST(p_partkey AS VARCHAR) AS course_id, 'c-' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS code,
       ' ' || p_name AS name,
       CASE WHEN p_partkey % 19 = 4 THEN 'three' ELSE CAST(p_size % 6 AS VARCHAR) END AS credits,
       p_type AS department,
       CASE WHEN p_partkey % 23 = 5 THEN ' ' WHEN p_partkey % 17 = 0 THEN 'X' || p_partkey
            ELSE CAST(p_partkey // 20 AS VARCHAR) END AS professor_id
FROM part""",
    "b_semesters": f"""
SELECT 'S' || y || '-' || h AS semester_id, ' s' || y || '-' || h AS code, CAST(y AS VARCHAR) AS year,
       CASE WHEN y % 5 = 0 THEN '3' ELSE CAST(h AS VARCHAR) END AS half,
       y || CASE WHEN h = 1 THEN '-01-10' ELSE '-07-10' END AS start_date,
       CASE WHEN y % 7 = 0 THEN NULL WHEN y % 4 = 0 AND h = 2 THEN y || '-05-01'
            ELSE y || CASE WHEN h = 1 THEN '-06-20' ELSE '-12-20' END END AS end_date
FROM (SELECT DISTINCT year(o_orderdate) AS y, {_HALF} AS h FROM orders)""",
    "b_enrollments": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS enrollment_id,
       CASE WHEN o_orderkey % 29 = 0 THEN 'bad' ELSE CAST({_DAY} AS VARCHAR) END AS enrolled_at,
       CASE WHEN o_orderkey % 31 = 0 THEN 'unknown'
            ELSE {_pick('CAST(left(o_orderpriority, 1) AS INTEGER) - 1', 'Completed', ' completed', 'FAILED', 'dropped ', 'active')} END AS status,
       o_custkey || ' ' AS student_id,
       CASE WHEN o_orderkey % 37 = 0 THEN 'X' || o_orderkey WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey // 512 * 64 AS VARCHAR)
            ELSE CAST(o_orderkey // 8 AS VARCHAR) END AS course_id,
       {_SEM} AS semester_id
FROM orders""",
    "b_grades": f"""
SELECT {_LINE} AS grade_id,
       {_pick('l_linenumber - 1', 'Exam', ' quiz', 'Project ', ' ', 'exam', 'Quiz', 'essay')} AS assessment,
       CASE WHEN l_partkey % 53 = 0 THEN '101' WHEN l_partkey % 59 = 0 THEN 'abs'
            ELSE CAST(CAST(l_quantity * 2 AS DECIMAL(6,2)) AS VARCHAR) END AS score,
       CASE WHEN l_partkey % 61 = 0 THEN NULL
            ELSE CAST(CAST(CAST(l_discount AS DECIMAL(4,2)) * 10 AS DECIMAL(5,4)) AS VARCHAR) END AS weight,
       CASE WHEN l_partkey % 67 = 0 THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS graded_at,
       ' ' || l_orderkey AS enrollment_id
FROM lineitem""",
    "b_customers": f"""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       CASE WHEN c_custkey % 20 = 1 THEN '  ' WHEN c_custkey % 6 = 0 THEN 'X' || c_custkey
            WHEN c_custkey % 2 = 0 THEN CAST(c_custkey // 2 AS VARCHAR) END AS external_ref,
       ' ' || lower(c_mktsegment) AS first_name, 'NATION ' || c_nationkey AS last_name,
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN ''
            ELSE upper(c_name) || '@Example.COM ' END AS email,
       ' nation_' || c_nationkey AS country,
       CASE WHEN c_custkey % 13 = 0 THEN 'not-a-date'
            ELSE {_day('2020-01-01', 'c_custkey % 1000')} || ' 08:30:00' END AS created_at,
       CASE WHEN c_custkey % 19 = 0 THEN ' ' ELSE c_mktsegment END AS segment
FROM customer""",
    "b_products": """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN p_partkey % 89 = 0 THEN '' ELSE lower(p_brand) END AS sku,
       p_name AS name, upper(p_type) || ' ' AS category,
       CASE WHEN p_partkey % 101 = 0 THEN '-5.00' WHEN p_partkey % 103 = 0 THEN 'free'
            ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS monthly_price,
       CASE WHEN p_partkey % 97 = 0 THEN 'maybe' WHEN p_size > 7 THEN ' True' ELSE 'FALSE' END AS active
FROM part""",
    "b_subscriptions": f"""
SELECT 'SUB-' || o_orderkey AS subscription_id,
       CASE WHEN o_orderkey % 43 = 0 THEN 'trial' WHEN o_orderstatus = 'P' THEN 'Active'
            WHEN o_orderstatus = 'F' THEN 'cancelled ' ELSE 'PAUSED' END AS status,
       CAST({_DAY} AS VARCHAR) AS start_date,
       CASE WHEN o_orderkey % 10 = 7 THEN NULL
            ELSE CAST(CAST({_DAY} + CAST((o_orderkey % 9 - 2) * 30 AS INTEGER) AS DATE) AS VARCHAR) END AS end_date,
       CASE WHEN o_orderkey % 41 = 0 THEN 'X' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
       CASE WHEN o_orderkey % 47 = 0 THEN ' ' ELSE CAST(o_orderkey // 8 AS VARCHAR) END AS product_id
FROM orders""",
    "b_invoices": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS invoice_id,
       CAST(CAST(CASE WHEN summed THEN first_day ELSE o_orderdate END AS DATE) AS VARCHAR) AS issued_at,
       CASE WHEN summed THEN CAST(CAST(last_day AS DATE) AS VARCHAR) WHEN o_orderkey % 39 = 0 THEN NULL
            ELSE CAST(CAST({_DAY} + CAST((o_orderkey % 12 - 1) * 10 AS INTEGER) AS DATE) AS VARCHAR) END AS due_at,
       CASE WHEN summed THEN CAST(CAST(line_sum AS DECIMAL(12,2)) AS VARCHAR)
            WHEN o_orderkey % 111 = 0 THEN 'tbd' WHEN o_orderkey % 113 = 0 THEN '-10.00'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS total,
       CASE WHEN summed AND flag = 'A' THEN 'pending' WHEN summed AND flag = 'N' THEN ' PAID' WHEN summed THEN 'overdue'
            WHEN o_orderkey % 59 = 0 THEN 'void' WHEN o_orderstatus = 'F' THEN 'Paid'
            WHEN o_orderstatus = 'O' THEN 'pending ' ELSE 'OVERDUE' END AS status,
       CASE WHEN summed AND o_orderkey % 3 = 0 THEN 'usd' WHEN summed THEN 'eur'
            ELSE {_pick('CAST(left(o_orderpriority, 1) AS INTEGER) - 1', 'usd', 'EUR ', 'gbp', 'mxn', 'Brl')} END AS currency,
       CASE WHEN o_orderkey % 79 = 0 OR o_custkey % 10 = 0 THEN 'X' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS customer_id
FROM (SELECT *, o_orderkey % 10 = 1 AND line_sum IS NOT NULL AS summed
      FROM orders LEFT JOIN (SELECT l_orderkey, sum({_EXT}) AS line_sum, min(l_shipdate) AS first_day, max(l_shipdate) AS last_day,
                                    min(l_returnflag) AS flag FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)""",
    "b_invoice_items": f"""
SELECT {_LINE} AS invoice_item_id,
       CASE WHEN l_partkey % 61 = 0 THEN '0' WHEN l_partkey % 67 = 0 THEN 'two' ELSE CAST({_QTY} AS VARCHAR) END AS quantity,
       CAST(CAST((({_CENTS} * 2 + {_QTY}) // (2 * {_QTY})) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS VARCHAR) AS unit_price,
       CAST({_EXT} AS VARCHAR) AS line_total,
       CASE WHEN l_linenumber = 3 THEN ' ' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END AS invoice_id,
       CASE WHEN l_partkey % 71 = 0 THEN 'X' || l_partkey ELSE CAST(l_partkey AS VARCHAR) END AS product_id
FROM lineitem""",
    "b_payments": f"""
SELECT {_LINE} AS payment_id,
       CASE WHEN l_partkey % 73 = 0 THEN '0' WHEN l_partkey % 79 = 0 THEN '-1.00'
            WHEN l_orderkey % 20 = 1 THEN CAST({_EXT} AS VARCHAR)
            ELSE CAST(CAST({_EXT} * (1 - CAST(l_discount AS DECIMAL(4,2))) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
       CASE WHEN l_partkey % 83 = 0 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS paid_at,
       {_pick('l_linenumber - 1', 'Card', 'PAYPAL ', 'bank_transfer', 'cash', 'crypto', 'card', 'cash')} AS method,
       CAST(CASE WHEN l_orderkey % 4 = 3 THEN l_orderkey - 1 ELSE l_orderkey END AS VARCHAR) AS invoice_id
FROM lineitem""",
    "b_accounts": f"""
SELECT CAST(s_suppkey AS VARCHAR) AS account_id, CASE WHEN s_suppkey % 41 = 7 THEN ' ' ELSE s_name END AS name,
       CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE {_pick('s_suppkey % 5', 'RETAIL', 'tech ', 'Health', 'energy', 'media')} END AS industry,
       lower(n_name) || ' ' AS country, CAST(CAST(s_acctbal AS DECIMAL(16,2)) AS VARCHAR) AS annual_revenue,
       CASE WHEN s_suppkey % 13 = 0 THEN 'many' WHEN s_suppkey % 17 = 0 THEN '-3'
            ELSE CAST(s_suppkey * 37 % 500 AS VARCHAR) END AS employees,
       CASE WHEN s_suppkey % 19 = 0 THEN NULL
            ELSE {_day('2019-05-01', 's_suppkey % 900')} || ' 07:15:00' END AS created_at
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "b_contacts": f"""
SELECT CAST(c_custkey AS VARCHAR) AS contact_id, lower(c_mktsegment) || ' ' AS first_name,
       CASE WHEN c_custkey % 43 = 0 THEN ' ' ELSE 'nation ' || c_nationkey END AS last_name,
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '  ' ELSE c_name || '@Firm.COM' END AS email,
       CASE WHEN c_custkey % 9 = 0 THEN '' ELSE '+1-' || c_custkey END AS phone,
       {_pick('c_custkey % 5', 'CEO', 'cto', ' buyer', 'CEO ', 'analyst')} AS title,
       CASE WHEN c_custkey % 23 = 0 THEN 'n.d.'
            ELSE {_day('2021-01-01', 'c_custkey % 700')} || ' 10:00:00' END AS created_at,
       CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 'X' || c_custkey
            ELSE CAST(c_custkey // 15 AS VARCHAR) END AS account_id
FROM customer""",
    "b_leads": f"""
SELECT 'L' || c_custkey AS lead_id, CASE WHEN c_custkey % 61 = 0 THEN NULL ELSE c_mktsegment END AS first_name,
       'nation ' || c_nationkey AS last_name,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_name || '@Mail.COM' END AS email,
       CASE WHEN c_custkey % 59 = 0 THEN 'radio' ELSE CASE c_mktsegment WHEN 'MACHINERY' THEN 'Web'
            WHEN 'BUILDING' THEN ' referral' WHEN 'AUTOMOBILE' THEN 'ADS' WHEN 'FURNITURE' THEN 'event'
            ELSE 'cold_call ' END END AS source,
       CASE WHEN c_custkey % 37 = 0 THEN 'stale'
            ELSE {_pick('c_custkey % 5', 'New', 'contacted', ' qualified', 'CONVERTED', 'lost')} END AS status,
       CASE WHEN c_custkey % 41 = 0 THEN 'hot' ELSE CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR) END AS score,
       CASE WHEN c_custkey % 53 = 0 THEN ''
            ELSE {_day('2022-03-01', 'c_custkey % 500')} || ' 12:00:00' END AS created_at
FROM customer""",
    "b_opportunities": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS opportunity_id,
       CASE WHEN o_orderkey % 65 = 0 THEN ' ' ELSE 'Deal ' || o_orderkey END AS name,
       CASE WHEN o_orderkey % 85 = 0 THEN 'limbo'
            ELSE {_pick('o_orderkey % 6', 'Prospect', 'qualification', ' proposal', 'NEGOTIATION', 'won', 'Lost')} END AS stage,
       CASE WHEN o_orderkey % 75 = 0 THEN '0' ELSE CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) END AS amount,
       CASE WHEN o_orderkey % 55 = 0 THEN NULL
            ELSE CAST(CAST({_DAY} + CAST((o_orderkey % 7 - 2) * 15 AS INTEGER) AS DATE) AS VARCHAR) END AS close_date,
       CAST({_DAY} AS VARCHAR) || ' 15:45:00' AS created_at,
       CASE WHEN o_orderkey % 95 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'X' || o_custkey
            ELSE CAST(o_custkey // 15 AS VARCHAR) END AS account_id
FROM orders""",
    "b_opportunity_contacts": f"""
SELECT CAST(l_orderkey AS VARCHAR) AS opportunity_id,
       CASE WHEN l_suppkey % 33 = 0 THEN 'X' || l_suppkey ELSE CAST(l_suppkey AS VARCHAR) END AS contact_id,
       CASE WHEN l_partkey % 83 = 0 THEN 'observer'
            ELSE {_pick('l_linenumber - 1', 'Influencer', 'end_user', ' financial', 'TECHNICAL', 'decision_maker', 'end_user ', 'technical')} END AS role
FROM lineitem""",
    "b_activities": """
SELECT CAST(event_id AS VARCHAR) AS activity_id,
       CASE WHEN event_id % 89 = 0 THEN 'fax' ELSE CASE event_type WHEN 'click' THEN 'Email' WHEN 'view' THEN ' call'
            WHEN 'purchase' THEN 'MEETING' WHEN 'signup' THEN 'note' ELSE 'demo' END END AS type,
       CASE WHEN event_id % 71 = 0 THEN ' ' ELSE event_type END AS subject,
       CASE WHEN event_id % 67 = 0 THEN 'later' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS occurred_at,
       CASE WHEN event_id % 4 IN (0, 1) THEN CASE WHEN event_id % 47 = 0 THEN 'X' || user_id ELSE user_id || ' ' END
            WHEN event_id % 4 = 2 THEN '  ' END AS contact_id,
       CASE WHEN event_id % 4 IN (0, 2) THEN CASE WHEN event_id % 53 = 0 THEN 'X' || event_id
            ELSE CAST(event_id // 2 AS VARCHAR) END END AS opportunity_id
FROM events""",
}
