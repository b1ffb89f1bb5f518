"""Gold views: projections of the gold tables with yes/no columns for dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.exact import percent
from tierline.operators.links import hot_key_join
from tierline.operators.measures import add, aggregate, sums, zero
from tierline.plans.billing import ROLLUP


def _any_positive(*columns: str) -> str:
    return " OR ".join(f"{c} > 0" for c in columns)


_BILLING_360 = [
    "billing_currency_count", "total_invoices", "paid_invoices", "pending_invoices", "overdue_invoices",
    "total_payments", "overpaid_invoices", "underpaid_invoices", "paid_status_but_underpaid",
    "invoices_without_items", "invoices_not_matching_item_total",
]


def student_customer_360(layers) -> DataFrame:
    """Students with the customers that name them in external_ref and those customers' invoice counts.

    Built from the customer side, so that a student named by very many customers does not end up in
    one task; students nobody names are added with empty customer columns. Customers with a blank
    reference leave first: a student id is never blank, the key checks see to that.
    """
    students = layers.gold("student_academic_summary").selectExpr(
        "student_id", "student_name", "email AS student_email", "country AS student_country",
        "enrolled_at AS university_enrolled_at", "total_enrollments", "completed_enrollments",
        "active_enrollments", "failed_enrollments", "dropped_enrollments", "enrollments_with_grades",
        "average_weighted_observed_score",
    )
    customers = layers.gold("customer_subscription_summary").filter("external_ref <> ''").selectExpr(
        "external_ref", "customer_id", "customer_name", "email AS customer_email",
        "country AS customer_country", "segment", "is_student_linked", "total_subscriptions",
        "active_subscriptions", "paused_subscriptions", "cancelled_subscriptions",
        "temporally_invalid_subscriptions", "active_subscriptions_to_inactive_products",
    )
    billing = aggregate(
        layers.gold("customer_billing_summary"),
        {"_payer": "customer_id"},
        {"billing_currency_count": "count(currency)", **sums({k: ROLLUP[k] for k in _BILLING_360[1:]})},
    )
    paying = customers.join(billing, F.expr("customer_id = _payer"), "left")
    known = students.withColumnRenamed("student_id", "_student")
    named = hot_key_join(paying, known, "external_ref", "_student", "customer_id", how="inner")
    named = named.withColumnRenamed("external_ref", "student_id")
    references = customers.selectExpr("external_ref AS student_id").distinct()
    alone = students.join(references, "student_id", "left_anti")
    filled = named.unionByName(alone, allowMissingColumns=True).selectExpr(
        *students.columns, *[c for c in customers.columns if c != "external_ref"], *zero(_BILLING_360)
    )
    return add(
        filled,
        {
            "has_failed_enrollment": _any_positive("failed_enrollments"),
            "has_dropped_enrollment": _any_positive("dropped_enrollments"),
            "has_active_subscription": _any_positive("active_subscriptions"),
            "has_invoices": _any_positive("total_invoices"),
            "has_billing_reconciliation_issue": _any_positive(
                "overpaid_invoices", "underpaid_invoices", "paid_status_but_underpaid"
            ),
        },
    )


def course_performance_dashboard(layers) -> DataFrame:
    return add(
        layers.gold("course_performance_summary"),
        {
            "has_failed_enrollments": _any_positive("failed_enrollments"),
            "has_dropped_enrollments": _any_positive("dropped_enrollments"),
            "has_temporal_issue": _any_positive("temporally_invalid_semester_enrollments"),
        },
    )


def billing_customer_dashboard(layers) -> DataFrame:
    return add(
        layers.gold("customer_billing_summary"),
        {
            "payment_coverage_pct": percent("total_paid", "total_invoiced", digits=2),
            "has_payment_reconciliation_issue": _any_positive(
                "overpaid_invoice_count", "underpaid_invoice_count", "paid_status_but_underpaid_count"
            ),
            "has_invoice_item_issue": _any_positive("invoices_without_items", "invoices_not_matching_item_total"),
        },
    )


_NOT_ON_CRM_DASHBOARD = [
    "is_annual_revenue_valid", "is_employees_valid", "is_created_at_valid", "first_contact_created_at",
    "latest_contact_created_at", "first_opportunity_created_at", "latest_opportunity_created_at",
    "earliest_close_date", "latest_close_date", "contact_only_activities", "opportunity_only_activities",
    "contact_and_opportunity_activities", "activities_with_same_account_references",
    "activities_with_different_account_references",
]


def crm_account_dashboard(layers) -> DataFrame:
    return add(
        layers.gold("account_crm_summary").drop(*_NOT_ON_CRM_DASHBOARD),
        {
            "has_open_pipeline": _any_positive("open_opportunities"),
            "has_temporally_invalid_opportunity": _any_positive("temporally_invalid_opportunities"),
            "has_cross_account_contact_relationship": _any_positive("different_account_relationships"),
        },
    )


def lead_source_dashboard(layers) -> DataFrame:
    return add(layers.gold("lead_funnel_summary"), {"has_quality_issue": _any_positive("leads_with_quality_issue")})
