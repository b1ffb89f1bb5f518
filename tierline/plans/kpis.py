"""Executive KPIs: one-row aggregates per area of the gold layer, put side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tierline.functions.exact import mean, money, percent
from tierline.operators.measures import add, aggregate, n, same, side_by_side, sums
from tierline.plans.billing import ROLLUP


def _totals(df: DataFrame, measures: dict[str, str], rates: dict[str, str] | None = None) -> DataFrame:
    return add(aggregate(df, {}, measures), rates or {})


def academic_totals(layers) -> DataFrame:
    states = ("completed", "active", "failed", "dropped")
    rates = {"completion": "completed", "failure": "failed", "dropout": "dropped"}
    score = "average_weighted_observed_score"
    return _totals(
        layers.gold("student_academic_summary"),
        {
            "total_students": "count(*)",
            **sums(same("total_enrollments", *[f"{s}_enrollments" for s in states], "enrollments_with_grades")),
            "students_with_observed_average": f"count({score})",
            "average_student_observed_score": mean(score),
        },
        {f"enrollment_{r}_rate_pct": percent(f"{s}_enrollments", "total_enrollments") for r, s in rates.items()},
    )


def course_totals(layers) -> DataFrame:
    return _totals(layers.gold("course_performance_summary"), {"total_courses": "count(*)"})


def invoice_totals(layers) -> DataFrame:
    return _totals(
        layers.gold("customer_billing_summary"),
        {
            "customers_with_invoices": "count(DISTINCT customer_id)",
            "billing_currencies": "count(DISTINCT currency)",
            **sums(ROLLUP),
        },
        {
            "paid_invoice_status_rate_pct": percent("paid_invoices", "total_invoices"),
            "paid_status_underpaid_rate_pct": percent("paid_status_but_underpaid", "paid_invoices"),
        },
    )


def subscription_totals(layers) -> DataFrame:
    states = ("total", "active", "paused", "cancelled", "temporally_invalid")
    return _totals(
        layers.gold("customer_subscription_summary"),
        {
            "total_customers": "count(*)",
            "customers_without_subscriptions": n("total_subscriptions = 0"),
            **sums(same(*[f"{s}_subscriptions" for s in states])),
            **sums({"active_subscriptions_on_inactive_products": "active_subscriptions_to_inactive_products"}),
        },
        {"active_subscription_rate_pct": percent("active_subscriptions", "total_subscriptions")},
    )


_DEALS = ("total", "won", "lost", "open", "temporally_invalid", "prospect", "qualification", "proposal", "negotiation")
_ACTIVITIES = ("call", "demo", "email", "meeting", "note")


def crm_totals(layers) -> DataFrame:
    relations = ("opportunity_contact", "same_account", "different_account")
    amounts = ("total_crm_opportunity_amount", "won_crm_amount", "lost_crm_amount", "open_pipeline_crm_amount")
    closed = "won_opportunities + lost_opportunities"
    return _totals(
        layers.gold("account_crm_summary"),
        {
            "total_accounts": "count(*)",
            **sums(same("total_contacts", *[f"{s}_opportunities" for s in _DEALS])),
            **sums(same(*[f"{r}_relationships" for r in relations])),
            **sums({"assigned_activities": "total_activities", **same(*[f"{t}_activities" for t in _ACTIVITIES])}),
            **{c: money(f"sum({c})") for c in amounts},
        },
        {"closed_opportunity_win_rate_pct": percent("won_opportunities", closed)},
    )


def lead_totals(layers) -> DataFrame:
    states = ("total", "new", "contacted", "qualified", "converted", "lost")
    return _totals(
        layers.gold("lead_funnel_summary"),
        {"lead_sources": "count(*)", **sums(same(*[f"{s}_leads" for s in states], "leads_with_quality_issue"))},
        {"lead_conversion_rate_pct": percent("converted_leads", "total_leads")},
    )


def activity_totals(layers) -> DataFrame:
    missing = n("contact_id IS NULL AND opportunity_id IS NULL")
    references = layers.reference("activities", "contact_id", "opportunity_id")
    return _totals(references, {"total_activities": "count(*)", "unassigned_activities": missing})


# The columns of the result, in order.
EXECUTIVE_COLUMNS = [
    "total_students", "total_courses", "total_enrollments", "completed_enrollments", "active_enrollments",
    "failed_enrollments", "dropped_enrollments", "enrollments_with_grades", "students_with_observed_average",
    "average_student_observed_score", "enrollment_completion_rate_pct", "enrollment_failure_rate_pct",
    "enrollment_dropout_rate_pct",
    "total_customers", "customers_with_invoices", "customers_without_invoices", "billing_currencies",
    "total_invoices", "paid_invoices", "pending_invoices", "overdue_invoices", "total_payments",
    "invoices_without_items", "invoices_not_matching_item_total", "overpaid_invoices", "exactly_paid_invoices",
    "underpaid_invoices", "paid_status_but_underpaid", "paid_invoice_status_rate_pct",
    "paid_status_underpaid_rate_pct",
    "total_subscriptions", "active_subscriptions", "paused_subscriptions", "cancelled_subscriptions",
    "temporally_invalid_subscriptions", "active_subscriptions_on_inactive_products",
    "customers_without_subscriptions", "active_subscription_rate_pct",
    "total_accounts", "total_contacts", "total_opportunities", "won_opportunities", "lost_opportunities",
    "open_opportunities", "temporally_invalid_opportunities", "opportunity_contact_relationships",
    "same_account_relationships", "different_account_relationships", "total_crm_opportunity_amount",
    "won_crm_amount", "open_pipeline_crm_amount", "closed_opportunity_win_rate_pct",
    "lead_sources", "total_leads", "qualified_leads", "converted_leads", "lost_leads",
    "leads_with_quality_issue", "lead_conversion_rate_pct",
    "total_activities", "assigned_activities", "unassigned_activities",
]


def executive_kpis(layers) -> DataFrame:
    """One row: seven global aggregates, each of exactly one row, put together."""
    parts = (
        academic_totals, course_totals, invoice_totals, subscription_totals, crm_totals, lead_totals, activity_totals,
    )
    wide = side_by_side([part(layers) for part in parts])
    wide = add(wide, {"customers_without_invoices": "total_customers - customers_with_invoices"})
    return wide.selectExpr("'current' AS snapshot_id", *EXECUTIVE_COLUMNS)
