from __future__ import annotations

import pytest
from compare import compare, connect
from conftest import SMALL

import __spark_entry__ as contract
from tierline.queries import QUERIES

# One per plan family; tests/compare.py runs all of them at any scale.
CHECKED = [
    "invoice_reconciliation_by_status", "silver_grades", "silver_payments", "silver_opportunity_contacts",
    "silver_activities", "dq_enrollments", "dq_conservation_gold", "course_performance_summary",
    "customer_billing_summary", "account_crm_summary", "executive_kpis", "student_customer_360",
    "billing_customer_dashboard", "profile_foreign_keys", "profile_categories", "business_rules",
    "observed_score_histogram", "student_360_by_situation",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    verdict, _, _ = compare(spark, duck, SMALL, name, contract.queries()[name], contract.oracle_sql()[name])
    assert verdict == "ok"


@pytest.mark.parametrize(
    "name", ["customer_billing_summary", "account_crm_summary", "silver_grades", "profile_tables", "dq_orphans"]
)
def test_same_result_with_shuffle_joins_and_split_partitions(spark, duck, name):
    """The plans a large cluster would run: no broadcast, every partition counted as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        verdict, _, _ = compare(spark, duck, SMALL, name, contract.queries()[name], contract.oracle_sql()[name])
        assert verdict == "ok"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert sum(r["invoices"] for r in rows) > 0
