"""Bronze frames derived from star-schema Parquet tables (customer, orders, lineitem, ...).

Every business column is text, with the blanks, stray spaces, mixed case, unconvertible values,
orphans and out-of-range numbers the silver rules look for. All are functions of the row itself,
so the frames grow with the tables and need no extra shuffle, apart from `semesters` (distinct
half-years) and `invoices`, a tenth of which are made of their lines. Keys point at real rows of their
parents and reach further as the tables grow.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.catalogue import source_file
from tierline.operators.measures import aggregate, named
from tierline.sources.csv import with_lineage

BATCH = "star"
STAMP = datetime(2024, 1, 1, tzinfo=timezone.utc)

_HALF = "if(month(o_orderdate) <= 6, 1, 2)"
_SEMESTER = f"concat('S', year(o_orderdate), '-', {_HALF})"
_EXT = "cast(l_extendedprice AS decimal(12,2))"
_CENTS = f"cast({_EXT} * 100 AS bigint)"
_QTY = "cast(l_quantity AS bigint)"
_LINE_ID = "concat(l_orderkey, '-', l_linenumber)"
_DAY = "cast(o_orderdate AS date)"

# Half of the courses have a few enrollments each; every 64th takes a quarter of its neighbours' as well.
_COURSE = "if(o_orderkey % 4 = 0, o_orderkey div 512 * 64, o_orderkey div 8)"

# table -> (source table, {column: SQL}); every row of the source table becomes a row
_SIMPLE: dict[str, tuple[str, dict[str, str]]] = {
    "students": (
        "customer",
        {
            "student_id": "cast(c_custkey AS string)",
            "first_name": "concat(upper(c_mktsegment), ' ')",
            "last_name": "concat('nation ', c_nationkey)",
            "email": "concat(' ', upper(c_name), '@Campus.EDU')",
            "birth_date": "if(c_custkey % 17 = 0, null, cast(date_add(date'1980-01-01', cast(c_custkey * 7 % 9000 AS int)) AS string))",
            "enrolled_at": "if(c_custkey % 97 = 5, 'soon', concat(date_add(date'2000-01-01', cast(c_custkey % 3000 AS int)), ' 09:30:00'))",
            "country": "concat(' nation_', c_nationkey)",
        },
    ),
    "professors": (
        "supplier",
        {
            "professor_id": "cast(s_suppkey AS string)",
            "first_name": "' prof'",
            "last_name": "upper(s_name)",
            "email": "concat(s_name, '@Campus.EDU ')",
            "department": "element_at(array('cs ', 'math', ' bio', 'law'), cast(s_suppkey % 4 AS int) + 1)",
            "hired_at": "if(s_suppkey % 10 = 3, '??', concat(date_add(date'1995-02-01', cast(s_suppkey % 4000 AS int)), ' 00:00:00'))",
        },
    ),
    "courses": (
        "part",
        {
            "course_id": "cast(p_partkey AS string)",
            "code": "concat('c-', lpad(cast(p_partkey AS string), 5, '0'))",
            "name": "concat(' ', p_name)",
            "credits": "if(p_partkey % 19 = 4, 'three', cast(p_size % 6 AS string))",
            "department": "p_type",
            "professor_id": "case when p_partkey % 23 = 5 then ' ' when p_partkey % 17 = 0 then concat('X', p_partkey) else cast(p_partkey div 20 AS string) end",
        },
    ),
    "enrollments": (
        "orders",
        {
            "enrollment_id": "cast(o_orderkey AS string)",
            "enrolled_at": f"if(o_orderkey % 29 = 0, 'bad', cast({_DAY} AS string))",
            "status": "case when o_orderkey % 31 = 0 then 'unknown' else element_at(array('Completed', ' completed', 'FAILED', 'dropped ', 'active'), cast(substr(o_orderpriority, 1, 1) AS int)) end",
            "student_id": "concat(o_custkey, ' ')",
            "course_id": f"if(o_orderkey % 37 = 0, concat('X', o_orderkey), cast({_COURSE} AS string))",
            "semester_id": _SEMESTER,
        },
    ),
    "grades": (
        "lineitem",
        {
            "grade_id": _LINE_ID,
            "assessment": "element_at(array('Exam', ' quiz', 'Project ', ' ', 'exam', 'Quiz', 'essay'), cast(l_linenumber AS int))",
            "score": "case when l_partkey % 53 = 0 then '101' when l_partkey % 59 = 0 then 'abs' else cast(cast(l_quantity * 2 AS decimal(6,2)) AS string) end",
            "weight": "if(l_partkey % 61 = 0, null, cast(cast(cast(l_discount AS decimal(4,2)) * 10 AS decimal(5,4)) AS string))",
            "graded_at": "if(l_partkey % 67 = 0, '', cast(cast(l_shipdate AS date) AS string))",
            "enrollment_id": "concat(' ', l_orderkey)",
        },
    ),
    "customers": (
        "customer",
        {
            "customer_id": "cast(c_custkey AS string)",
            "external_ref": "case when c_custkey % 20 = 1 then '  ' when c_custkey % 6 = 0 then concat('X', c_custkey) when c_custkey % 2 = 0 then cast(c_custkey div 2 AS string) end",
            "first_name": "concat(' ', lower(c_mktsegment))",
            "last_name": "concat('NATION ', c_nationkey)",
            "email": "case when c_custkey % 7 = 0 then null when c_custkey % 11 = 0 then '' else concat(upper(c_name), '@Example.COM ') end",
            "country": "concat(' nation_', c_nationkey)",
            "created_at": "if(c_custkey % 13 = 0, 'not-a-date', concat(date_add(date'2020-01-01', cast(c_custkey % 1000 AS int)), ' 08:30:00'))",
            "segment": "if(c_custkey % 19 = 0, ' ', c_mktsegment)",
        },
    ),
    "products": (
        "part",
        {
            "product_id": "cast(p_partkey AS string)",
            "sku": "if(p_partkey % 89 = 0, '', lower(p_brand))",
            "name": "p_name",
            "category": "concat(upper(p_type), ' ')",
            "monthly_price": "case when p_partkey % 101 = 0 then '-5.00' when p_partkey % 103 = 0 then 'free' else cast(cast(p_retailprice AS decimal(10,2)) AS string) end",
            "active": "case when p_partkey % 97 = 0 then 'maybe' when p_size > 7 then ' True' else 'FALSE' end",
        },
    ),
    "subscriptions": (
        "orders",
        {
            "subscription_id": "concat('SUB-', o_orderkey)",
            "status": "case when o_orderkey % 43 = 0 then 'trial' when o_orderstatus = 'P' then 'Active' when o_orderstatus = 'F' then 'cancelled ' else 'PAUSED' end",
            "start_date": f"cast({_DAY} AS string)",
            "end_date": f"if(o_orderkey % 10 = 7, null, cast(date_add({_DAY}, cast((o_orderkey % 9 - 2) * 30 AS int)) AS string))",
            "customer_id": "if(o_orderkey % 41 = 0, concat('X', o_custkey), cast(o_custkey AS string))",
            "product_id": "if(o_orderkey % 47 = 0, ' ', cast(o_orderkey div 8 AS string))",
        },
    ),
    "invoice_items": (
        "lineitem",
        {
            "invoice_item_id": _LINE_ID,
            "quantity": f"case when l_partkey % 61 = 0 then '0' when l_partkey % 67 = 0 then 'two' else cast({_QTY} AS string) end",
            "unit_price": f"cast(cast((({_CENTS} * 2 + {_QTY}) div (2 * {_QTY})) * 0.01 AS decimal(12,2)) AS string)",
            "line_total": f"cast({_EXT} AS string)",
            "invoice_id": "if(l_linenumber = 3, concat(' ', l_orderkey), cast(l_orderkey AS string))",
            "product_id": "if(l_partkey % 71 = 0, concat('X', l_partkey), cast(l_partkey AS string))",
        },
    ),
    "payments": (
        "lineitem",
        {
            "payment_id": _LINE_ID,
            "amount": f"case when l_partkey % 73 = 0 then '0' when l_partkey % 79 = 0 then '-1.00' when l_orderkey % 20 = 1 then cast({_EXT} AS string) else cast(cast({_EXT} * (1 - cast(l_discount AS decimal(4,2))) * (1 + cast(l_tax AS decimal(4,2))) AS decimal(12,2)) AS string) end",
            "paid_at": "if(l_partkey % 83 = 0, null, cast(cast(l_shipdate AS date) AS string))",
            "method": "element_at(array('Card', 'PAYPAL ', 'bank_transfer', 'cash', 'crypto', 'card', 'cash'), cast(l_linenumber AS int))",
            "invoice_id": "cast(if(l_orderkey % 4 = 3, l_orderkey - 1, l_orderkey) AS string)",
        },
    ),
    "contacts": (
        "customer",
        {
            "contact_id": "cast(c_custkey AS string)",
            "first_name": "concat(lower(c_mktsegment), ' ')",
            "last_name": "if(c_custkey % 43 = 0, ' ', concat('nation ', c_nationkey))",
            "email": "case when c_custkey % 7 = 0 then null when c_custkey % 11 = 0 then '  ' else concat(c_name, '@Firm.COM') end",
            "phone": "if(c_custkey % 9 = 0, '', concat('+1-', c_custkey))",
            "title": "element_at(array('CEO', 'cto', ' buyer', 'CEO ', 'analyst'), cast(c_custkey % 5 AS int) + 1)",
            "created_at": "if(c_custkey % 23 = 0, 'n.d.', concat(date_add(date'2021-01-01', cast(c_custkey % 700 AS int)), ' 10:00:00'))",
            "account_id": "case when c_custkey % 31 = 0 then null when c_custkey % 29 = 0 then concat('X', c_custkey) else cast(c_custkey div 15 AS string) end",
        },
    ),
    "leads": (
        "customer",
        {
            "lead_id": "concat('L', c_custkey)",
            "first_name": "if(c_custkey % 61 = 0, null, c_mktsegment)",
            "last_name": "concat('nation ', c_nationkey)",
            "email": "if(c_custkey % 6 = 0, null, concat(c_name, '@Mail.COM'))",
            "source": "case when c_custkey % 59 = 0 then 'radio' when c_mktsegment = 'MACHINERY' then 'Web' when c_mktsegment = 'BUILDING' then ' referral' when c_mktsegment = 'AUTOMOBILE' then 'ADS' when c_mktsegment = 'FURNITURE' then 'event' else 'cold_call ' end",
            "status": "case when c_custkey % 37 = 0 then 'stale' else element_at(array('New', 'contacted', ' qualified', 'CONVERTED', 'lost'), cast(c_custkey % 5 AS int) + 1) end",
            "score": "if(c_custkey % 41 = 0, 'hot', cast(cast(floor(c_acctbal / 100) AS bigint) AS string))",
            "created_at": "if(c_custkey % 53 = 0, '', concat(date_add(date'2022-03-01', cast(c_custkey % 500 AS int)), ' 12:00:00'))",
        },
    ),
    "opportunities": (
        "orders",
        {
            "opportunity_id": "cast(o_orderkey AS string)",
            "name": "if(o_orderkey % 65 = 0, ' ', concat('Deal ', o_orderkey))",
            "stage": "case when o_orderkey % 85 = 0 then 'limbo' else element_at(array('Prospect', 'qualification', ' proposal', 'NEGOTIATION', 'won', 'Lost'), cast(o_orderkey % 6 AS int) + 1) end",
            "amount": "if(o_orderkey % 75 = 0, '0', cast(cast(o_totalprice AS decimal(16,2)) AS string))",
            "close_date": f"if(o_orderkey % 55 = 0, null, cast(date_add({_DAY}, cast((o_orderkey % 7 - 2) * 15 AS int)) AS string))",
            "created_at": f"concat({_DAY}, ' 15:45:00')",
            "account_id": "case when o_orderkey % 95 = 0 then null when o_orderkey % 13 = 0 then concat('X', o_custkey) else cast(o_custkey div 15 AS string) end",
        },
    ),
    "opportunity_contacts": (
        "lineitem",
        {
            "opportunity_id": "cast(l_orderkey AS string)",
            "contact_id": "if(l_suppkey % 33 = 0, concat('X', l_suppkey), cast(l_suppkey AS string))",
            "role": "case when l_partkey % 83 = 0 then 'observer' else element_at(array('Influencer', 'end_user', ' financial', 'TECHNICAL', 'decision_maker', 'end_user ', 'technical'), cast(l_linenumber AS int)) end",
        },
    ),
    "activities": (
        "events",
        {
            "activity_id": "cast(event_id AS string)",
            "type": "case when event_id % 89 = 0 then 'fax' when event_type = 'click' then 'Email' when event_type = 'view' then ' call' when event_type = 'purchase' then 'MEETING' when event_type = 'signup' then 'note' else 'demo' end",
            "subject": "if(event_id % 71 = 0, ' ', event_type)",
            "occurred_at": "if(event_id % 67 = 0, 'later', date_format(ts, 'yyyy-MM-dd HH:mm:ss'))",
            "contact_id": "case when event_id % 4 in (0, 1) then if(event_id % 47 = 0, concat('X', user_id), concat(user_id, ' ')) when event_id % 4 = 2 then '  ' end",
            "opportunity_id": "case when event_id % 4 in (0, 2) then if(event_id % 53 = 0, concat('X', event_id), cast(event_id div 2 AS string)) end",
        },
    ),
}

# Orders whose invoice is made of their lines, where they have any.
_BY_LINES = "o_orderkey % 10 = 1 AND lines IS NOT NULL"

_INVOICES = {
    "invoice_id": "cast(o_orderkey AS string)",
    "issued_at": f"cast(cast(if({_BY_LINES}, first_day, o_orderdate) AS date) AS string)",
    "due_at": f"case when {_BY_LINES} then cast(cast(last_day AS date) AS string) when o_orderkey % 39 <> 0 then cast(date_add({_DAY}, cast((o_orderkey % 12 - 1) * 10 AS int)) AS string) end",
    "total": f"case when {_BY_LINES} then cast(cast(lines AS decimal(12,2)) AS string) when o_orderkey % 111 = 0 then 'tbd' when o_orderkey % 113 = 0 then '-10.00' else cast(cast(o_totalprice AS decimal(12,2)) AS string) end",
    "status": f"case when {_BY_LINES} then case flag when 'A' then 'pending' when 'N' then ' PAID' else 'overdue' end when o_orderkey % 59 = 0 then 'void' when o_orderstatus = 'F' then 'Paid' when o_orderstatus = 'O' then 'pending ' else 'OVERDUE' end",
    "currency": f"if({_BY_LINES}, if(o_orderkey % 3 = 0, 'usd', 'eur'), element_at(array('usd', 'EUR ', 'gbp', 'mxn', 'Brl'), cast(substr(o_orderpriority, 1, 1) AS int)))",
    "customer_id": "if(o_orderkey % 79 = 0 OR o_custkey % 10 = 0, concat('X', o_custkey), cast(o_custkey AS string))",
}


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*named(columns))


class StarSource:
    """Bronze loader over one folder of star-schema Parquet files."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def scan(self, table: str) -> DataFrame:
        """The table as its files are now."""
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def _invoices(self) -> DataFrame:
        lines = aggregate(
            self.scan("lineitem"),
            {"l_orderkey": "l_orderkey"},
            {
                "lines": f"sum({_EXT})",
                "first_day": "min(l_shipdate)",
                "last_day": "max(l_shipdate)",
                "flag": "min(l_returnflag)",
            },
        )
        joined = self.scan("orders").join(lines, F.expr("o_orderkey = l_orderkey"), "left")
        return _project(joined, _INVOICES)

    def _semesters(self) -> DataFrame:
        halves = self.scan("orders").selectExpr("year(o_orderdate) AS y", f"{_HALF} AS h").distinct()
        return halves.selectExpr(
            "concat('S', y, '-', h) AS semester_id",
            "concat(' s', y, '-', h) AS code",
            "cast(y AS string) AS year",
            "if(y % 5 = 0, '3', cast(h AS string)) AS half",
            "concat(y, if(h = 1, '-01-10', '-07-10')) AS start_date",
            "case when y % 7 = 0 then null when y % 4 = 0 and h = 2 then concat(y, '-05-01') else concat(y, if(h = 1, '-06-20', '-12-20')) end AS end_date",
        )

    def _accounts(self) -> DataFrame:
        suppliers = self.scan("supplier").join(self.scan("nation"), F.expr("s_nationkey = n_nationkey"), "left")
        return suppliers.selectExpr(
            "cast(s_suppkey AS string) AS account_id",
            "if(s_suppkey % 41 = 7, ' ', s_name) AS name",
            "if(s_suppkey % 11 = 0, '', element_at(array('RETAIL', 'tech ', 'Health', 'energy', 'media'), cast(s_suppkey % 5 AS int) + 1)) AS industry",
            "concat(lower(n_name), ' ') AS country",
            "cast(cast(s_acctbal AS decimal(16,2)) AS string) AS annual_revenue",
            "case when s_suppkey % 13 = 0 then 'many' when s_suppkey % 17 = 0 then '-3' else cast(s_suppkey * 37 % 500 AS string) end AS employees",
            "if(s_suppkey % 19 = 0, null, concat(date_add(date'2019-05-01', cast(s_suppkey % 900 AS int)), ' 07:15:00')) AS created_at",
        )

    def bronze(self, name: str) -> DataFrame:
        if name in _SIMPLE:
            table, columns = _SIMPLE[name]
            df = _project(self.scan(table), columns)
        else:
            df = {"invoices": self._invoices, "semesters": self._semesters, "accounts": self._accounts}[name]()
        return with_lineage(df, source_file(name), STAMP, BATCH)
