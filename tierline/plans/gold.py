"""Registry of the gold layer: name -> plan over the layers."""

from __future__ import annotations

from tierline.plans import billing, crm, kpis, university, views

# Intermediate results, shared by the tables below.
PARTS = {
    "grades_by_enrollment": university.grades_by_enrollment,
    "invoice_items_by_invoice": billing.invoice_items_by_invoice,
    "payments_by_invoice": billing.payments_by_invoice,
    "invoice_detail": billing.invoice_detail,
    "contact_metrics": crm.contact_metrics,
    "opportunity_metrics": crm.opportunity_metrics,
    "opportunity_contact_metrics": crm.opportunity_contact_metrics,
    "activity_assignment": crm.activity_assignment,
    "activity_metrics": crm.activity_metrics,
}

TABLES = {
    "student_academic_summary": university.student_academic_summary,
    "course_performance_summary": university.course_performance_summary,
    "customer_billing_summary": billing.customer_billing_summary,
    "customer_subscription_summary": billing.customer_subscription_summary,
    "account_crm_summary": crm.account_crm_summary,
    "lead_funnel_summary": crm.lead_funnel_summary,
    "billing_currency_kpis": billing.billing_currency_kpis,
    "executive_kpis": kpis.executive_kpis,
}

VIEWS = {
    "student_customer_360": views.student_customer_360,
    "course_performance_dashboard": views.course_performance_dashboard,
    "billing_customer_dashboard": views.billing_customer_dashboard,
    "crm_account_dashboard": views.crm_account_dashboard,
    "lead_source_dashboard": views.lead_source_dashboard,
}

GOLD = {**PARTS, **TABLES, **VIEWS}

# Intermediate results that are stored, as more than one table reads them.
SHARED = ("grades_by_enrollment",)

# Stored objects that read other stored ones, which must be there before them.
READS = {
    "student_academic_summary": ("grades_by_enrollment",),
    "course_performance_summary": ("grades_by_enrollment",),
    "billing_currency_kpis": ("customer_billing_summary",),
    "executive_kpis": (
        "student_academic_summary", "course_performance_summary", "customer_billing_summary",
        "customer_subscription_summary", "account_crm_summary", "lead_funnel_summary",
    ),
    "student_customer_360": ("student_academic_summary", "customer_subscription_summary", "customer_billing_summary"),
    "course_performance_dashboard": ("course_performance_summary",),
    "billing_customer_dashboard": ("customer_billing_summary",),
    "crm_account_dashboard": ("account_crm_summary",),
    "lead_source_dashboard": ("lead_funnel_summary",),
}
