"""Analysis datasets over gold: shares, rates, rankings and group comparisons.

Labels and output names are fixed values. Everything but the two rankings and the per-class
groupings works on aggregates of a few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.exact import mean, percent
from tierline.operators.measures import add, aggregate, labelled, n, same, side_by_side, sums, top, with_share
from tierline.operators.values import describe, histogram
from tierline.plans import kpis


def _share(df: DataFrame, label: str, value: str, entries: dict[str, str]) -> DataFrame:
    return with_share(labelled(df, label, value, entries), value, "porcentaje")


# ---- executive


def kpis_vertical(layers) -> DataFrame:
    wide = layers.gold("executive_kpis")
    texts = {c: f"cast({c} AS string)" for c in kpis.EXECUTIVE_COLUMNS}
    return labelled(wide, "indicador", "valor", texts)


def executive_volumes(layers) -> DataFrame:
    # Domain, label and column of each volume.
    volumes = (
        ("University", "Estudiantes", "total_students"),
        ("University", "Cursos", "total_courses"),
        ("University", "Inscripciones", "total_enrollments"),
        ("Billing", "Clientes", "total_customers"),
        ("Billing", "Facturas", "total_invoices"),
        ("Billing", "Suscripciones", "total_subscriptions"),
        ("CRM", "Cuentas", "total_accounts"),
        ("CRM", "Oportunidades", "total_opportunities"),
        ("CRM", "Leads", "total_leads"),
    )
    entries = ", ".join(f"'{d}', '{label}', {c}" for d, label, c in volumes)
    return layers.gold("executive_kpis").selectExpr(f"stack({len(volumes)}, {entries}) AS (dominio, indicador, valor)")


def executive_rates(layers) -> DataFrame:
    rates = {
        "Inscripciones completadas": "enrollment_completion_rate_pct",
        "Inscripciones reprobadas": "enrollment_failure_rate_pct",
        "Inscripciones abandonadas": "enrollment_dropout_rate_pct",
        "Facturas con estado paid": "paid_invoice_status_rate_pct",
        "Facturas paid subpagadas": "paid_status_underpaid_rate_pct",
        "Suscripciones activas": "active_subscription_rate_pct",
        "Oportunidades cerradas ganadas": "closed_opportunity_win_rate_pct",
        "Leads convertidos": "lead_conversion_rate_pct",
    }
    return labelled(layers.gold("executive_kpis"), "indicador", "tasa_pct", rates).orderBy("tasa_pct", "indicador")


# ---- university


def enrollment_status_share(layers) -> DataFrame:
    states = {s: f"{s.lower()}_enrollments" for s in ("Completed", "Active", "Failed", "Dropped")}
    return _share(kpis.academic_totals(layers), "estado", "inscripciones", states)


_COURSE = ("course_code", "course_name", "professor_name", "department", "total_enrollments")


def top_courses_volume(layers) -> DataFrame:
    columns = (*_COURSE, "completed_enrollments", "failed_enrollments", "dropped_enrollments")
    return top(layers.gold("course_performance_dashboard").select(*columns), "total_enrollments", "course_code")


def _top_rate(layers, count: str, rate: str) -> DataFrame:
    busy = layers.gold("course_performance_dashboard").filter("total_enrollments >= 50")
    return top(busy.select(*_COURSE, count, rate, "average_weighted_observed_score"), rate, "course_code")


def top_courses_failure(layers) -> DataFrame:
    return _top_rate(layers, "failed_enrollments", "failure_rate_pct")


def top_courses_dropout(layers) -> DataFrame:
    return _top_rate(layers, "dropped_enrollments", "dropout_rate_pct")


_SITUATION = {
    "situacion_academica": "CASE WHEN failed_enrollments > 0 AND dropped_enrollments > 0 THEN 'Reprobación y abandono'"
    " WHEN failed_enrollments > 0 THEN 'Solo reprobación' WHEN dropped_enrollments > 0 THEN 'Solo abandono'"
    " ELSE 'Sin reprobación ni abandono' END"
}


def student_situation(layers) -> DataFrame:
    counted = aggregate(layers.gold("student_academic_summary"), _SITUATION, {"estudiantes": "count(*)"})
    return with_share(counted, "estudiantes", "porcentaje")


def observed_score_distribution(layers) -> DataFrame:
    return describe(layers.gold("student_academic_summary"), "average_weighted_observed_score", 2)


def observed_score_histogram(layers) -> DataFrame:
    return histogram(layers.gold("student_academic_summary"), "average_weighted_observed_score", 20)


# ---- billing


def invoice_status_share(layers) -> DataFrame:
    states = {s: f"{s.lower()}_invoices" for s in ("Paid", "Pending", "Overdue")}
    return _share(kpis.invoice_totals(layers), "estado", "facturas", states)


def payment_reconciliation_share(layers) -> DataFrame:
    classes = {
        "Sobrepagadas": "overpaid_invoices",
        "Pagadas exactamente": "exactly_paid_invoices",
        "Subpagadas": "underpaid_invoices",
    }
    return _share(kpis.invoice_totals(layers), "clasificacion", "facturas", classes)


def paid_but_underpaid(layers) -> DataFrame:
    return kpis.invoice_totals(layers).selectExpr(
        "paid_invoices AS facturas_paid",
        "paid_status_but_underpaid AS paid_subpagadas",
        "paid_status_underpaid_rate_pct AS tasa_pct",
    )


def currency_coverage(layers) -> DataFrame:
    columns = (
        "currency", "customers", "total_invoices", "total_payments", "total_invoiced", "total_paid",
        "outstanding_amount", "overpaid_amount", "paid_invoice_rate_pct", "overdue_invoice_rate_pct",
        "overpaid_invoice_rate_pct", "underpaid_invoice_rate_pct", "invoice_item_mismatch_rate_pct",
    )
    coverage = percent("total_paid", "total_invoiced", digits=2)
    return layers.gold("billing_currency_kpis").selectExpr(*columns, f"{coverage} AS payment_coverage_pct")


def invoice_item_quality(layers) -> DataFrame:
    classes = {
        "Sin items": "invoices_without_items",
        "Items coinciden": "invoices_matching_item_total",
        "Items no coinciden": "invoices_not_matching_item_total",
    }
    return labelled(kpis.invoice_totals(layers), "clasificacion", "facturas", classes)


def subscription_kpis(layers) -> DataFrame:
    totals = kpis.subscription_totals(layers)
    return totals.selectExpr(
        "total_subscriptions", "active_subscriptions", "paused_subscriptions", "cancelled_subscriptions",
        "temporally_invalid_subscriptions",
        "active_subscriptions_on_inactive_products AS active_subscriptions_to_inactive_products",
        "customers_without_subscriptions",
    )


def subscription_status_share(layers) -> DataFrame:
    states = {s: f"{s.lower()}_subscriptions" for s in ("Active", "Paused", "Cancelled")}
    return _share(kpis.subscription_totals(layers), "estado", "suscripciones", states)


def subscription_issues(layers) -> DataFrame:
    cases = {
        "Fechas inconsistentes": "temporally_invalid_subscriptions",
        "Activas en productos inactivos": "active_subscriptions_on_inactive_products",
    }
    return labelled(kpis.subscription_totals(layers), "situacion", "suscripciones", cases)


# ---- CRM


def opportunity_stage_share(layers) -> DataFrame:
    names = ("Prospect", "Qualification", "Proposal", "Negotiation", "Won", "Lost")
    stages = {s: f"{s.lower()}_opportunities" for s in names}
    return _share(kpis.crm_totals(layers), "etapa", "oportunidades", stages)


def opportunity_state_share(layers) -> DataFrame:
    states = {"Abiertas": "open_opportunities", "Ganadas": "won_opportunities", "Perdidas": "lost_opportunities"}
    return _share(kpis.crm_totals(layers), "clasificacion", "oportunidades", states)


def win_rate(layers) -> DataFrame:
    return kpis.crm_totals(layers).selectExpr(
        "won_opportunities + lost_opportunities AS oportunidades_cerradas",
        "won_opportunities AS oportunidades_ganadas",
        "closed_opportunity_win_rate_pct AS tasa_ganancia_pct",
    )


def crm_amounts(layers) -> DataFrame:
    amounts = {
        "Pipeline abierto": "open_pipeline_crm_amount", "Ganado": "won_crm_amount", "Perdido": "lost_crm_amount",
    }
    return labelled(kpis.crm_totals(layers), "clasificacion", "monto_crm", amounts)


def top_open_pipeline(layers) -> DataFrame:
    accounts = layers.gold("crm_account_dashboard").select(
        "account_id", "account_name", "industry", "country", "open_opportunities", "open_pipeline_crm_amount",
        "total_activities",
    )
    return top(accounts, "open_pipeline_crm_amount", "account_id")


def opportunity_temporal_quality(layers) -> DataFrame:
    classes = {
        "Fechas válidas": "total_opportunities - temporally_invalid_opportunities",
        "Fechas inconsistentes": "temporally_invalid_opportunities",
    }
    return _share(kpis.crm_totals(layers), "clasificacion", "oportunidades", classes)


def opportunity_contact_share(layers) -> DataFrame:
    classes = {"Misma cuenta": "same_account_relationships", "Cuenta diferente": "different_account_relationships"}
    return _share(kpis.crm_totals(layers), "clasificacion", "relaciones", classes)


def activity_type_counts(layers) -> DataFrame:
    types = {t: f"{t.lower()}_activities" for t in ("Call", "Demo", "Email", "Meeting", "Note")}
    return labelled(kpis.crm_totals(layers), "tipo", "actividades", types)


def activity_assignment_share(layers) -> DataFrame:
    wide = side_by_side([kpis.crm_totals(layers).select("assigned_activities"), kpis.activity_totals(layers)])
    classes = {"Asignadas a una cuenta": "assigned_activities", "Sin referencia": "unassigned_activities"}
    return _share(wide, "clasificacion", "actividades", classes)


def lead_status_share(layers) -> DataFrame:
    states = {s: f"{s.lower()}_leads" for s in ("New", "Contacted", "Qualified", "Converted", "Lost")}
    return _share(kpis.lead_totals(layers), "estado", "leads", states)


def lead_source_conversion(layers) -> DataFrame:
    return layers.gold("lead_source_dashboard").select(
        "source", "total_leads", "converted_leads", "qualified_leads", "average_lead_score", "conversion_rate_pct",
        "qualified_or_converted_rate_pct",
    ).orderBy(F.desc("conversion_rate_pct"), "source")


def lead_score_conversion(layers) -> DataFrame:
    return layers.gold("lead_source_dashboard").select("source", "average_lead_score", "conversion_rate_pct")


# ---- students and customers together


def integration_validation(layers) -> DataFrame:
    wide = aggregate(
        layers.gold("student_customer_360"),
        {},
        {
            "total": "count(*)",
            "linked": "count(customer_id)",
            "unlinked": n("customer_id IS NULL"),
            "invoiced": n("has_invoices"),
            "subscribed": n("has_active_subscription"),
        },
    )
    indicators = {
        "Total de estudiantes": "total",
        "Estudiantes vinculados a clientes": "linked",
        "Estudiantes sin cliente": "unlinked",
        "Estudiantes con facturas": "invoiced",
        "Estudiantes con suscripción activa": "subscribed",
    }
    return labelled(wide, "indicador", "valor", indicators)


def customer_population(layers) -> DataFrame:
    grouped = aggregate(
        layers.gold("customer_subscription_summary"),
        {"customer_type": "if(is_student_linked, 'Vinculado a estudiante', 'No vinculado a estudiante')"},
        {
            "customers": "count(*)",
            "customers_with_subscriptions": n("total_subscriptions > 0"),
            "customers_with_active_subscription": n("active_subscriptions > 0"),
            "average_subscriptions": mean("total_subscriptions", digits=0),
            "average_active_subscriptions": mean("active_subscriptions", digits=0),
        },
    )
    rates = {
        "subscription_customer_rate_pct": percent("customers_with_subscriptions", "customers"),
        "active_subscription_customer_rate_pct": percent("customers_with_active_subscription", "customers"),
    }
    return add(grouped, rates).orderBy("customer_type")


def student_360_by_situation(layers) -> DataFrame:
    grouped = aggregate(
        layers.gold("student_customer_360"),
        _SITUATION,
        {
            "estudiantes": "count(*)",
            "estudiantes_con_facturas": n("has_invoices"),
            "estudiantes_con_suscripcion_activa": n("has_active_subscription"),
            "estudiantes_con_incidencia_billing": n("has_billing_reconciliation_issue"),
            "promedio_facturas": mean("total_invoices", 4, 0),
            "promedio_suscripciones_activas": mean("active_subscriptions", 4, 0),
            "promedio_academico_observado": mean("average_weighted_observed_score", 4),
        },
    )
    rates = {
        "tasa_con_facturas_pct": "estudiantes_con_facturas",
        "tasa_suscripcion_activa_pct": "estudiantes_con_suscripcion_activa",
        "tasa_incidencia_billing_pct": "estudiantes_con_incidencia_billing",
    }
    return add(grouped, {name: percent(part, "estudiantes") for name, part in rates.items()})


def academic_billing_detail(layers) -> DataFrame:
    grouped = aggregate(
        layers.gold("student_customer_360"),
        _SITUATION,
        {
            "estudiantes": "count(*)",
            **sums(same("total_invoices", "overpaid_invoices", "underpaid_invoices")),
            **sums({"paid_status_underpaid": "paid_status_but_underpaid"}),
        },
    )
    rates = {
        "overpaid_invoice_rate_pct": "overpaid_invoices",
        "underpaid_invoice_rate_pct": "underpaid_invoices",
        "paid_status_underpaid_rate_pct": "paid_status_underpaid",
    }
    return add(grouped, {name: percent(part, "total_invoices") for name, part in rates.items()})


def _academics_by(layers, flag: str, label: str, when_true: str, when_false: str) -> DataFrame:
    """Academic means per value of a yes/no column; rows where it is unknown are left out."""
    return aggregate(
        layers.gold("student_customer_360").filter(f"{flag} IS NOT NULL"),
        {label: f"if({flag}, '{when_true}', '{when_false}')"},
        {
            "estudiantes": "count(*)",
            "promedio_inscripciones_completadas": mean("completed_enrollments", 4, 0),
            "promedio_inscripciones_reprobadas": mean("failed_enrollments", 4, 0),
            "promedio_inscripciones_abandonadas": mean("dropped_enrollments", 4, 0),
            "promedio_academico_observado": mean("average_weighted_observed_score", 4),
        },
    )


def academics_by_subscription(layers) -> DataFrame:
    return _academics_by(
        layers, "has_active_subscription", "suscripcion_activa", "Con suscripción activa", "Sin suscripción activa"
    )


def academics_by_billing_issue(layers) -> DataFrame:
    return _academics_by(
        layers, "has_billing_reconciliation_issue", "situacion_billing", "Con incidencia de Billing",
        "Sin incidencia de Billing",
    )
