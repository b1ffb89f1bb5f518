"""Every registered query: name -> callable(spark, folder of star-schema Parquet tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierline.catalogue import LINEAGE, SILVER_LINEAGE, TABLES
from tierline.operators.measures import aggregate, n, same, union
from tierline.plans import insights, profiling, rules
from tierline.plans.gold import GOLD
from tierline.plans.layers import Layers
from tierline.plans.silver import business_columns
from tierline.sources.star import StarSource

Query = Callable[[SparkSession, str], DataFrame]


def invoice_reconciliation_by_status(layers: Layers) -> DataFrame:
    """Invoices per (status, payment balance), with those marked paid although underpaid."""
    return aggregate(
        layers.gold("invoice_detail"),
        same("status", "payment_balance_status"),
        {
            "invoices": "count(*)",
            "without_items": n("is_without_items"),
            "matching_items": n("does_invoice_match_items"),
            "paid_but_underpaid": n("is_paid_status_underpaid"),
            "open_but_fully_paid": n("is_open_status_fully_paid"),
        },
    )


def bronze_volumes(layers: Layers) -> DataFrame:
    """(tabla, archivo, filas): rows per source file, as a load would report them."""
    parts = []
    for table in TABLES:
        counted = aggregate(layers.bronze(table), {"archivo": LINEAGE[0]}, {"filas": "count(*)"})
        parts.append(counted.selectExpr(f"'{table}' AS tabla", "archivo", "filas"))
    return union(parts)


def bronze_lineage(layers: Layers) -> DataFrame:
    """(tabla, archivo, lote, ingerido, filas_bronze, filas_silver, estado): rows of each load in bronze and in silver.

    Every row of either layer is counted under the file, batch and stamp that it carries itself. REVISAR where the
    layers differ or a row lacks a part of its lineage.
    """
    parts = []
    for table in TABLES:
        for layer, names, side in ((layers.bronze(table), LINEAGE, 0), (layers.silver(table), SILVER_LINEAGE, 1)):
            keys = dict(zip(("archivo", "ingerido", "lote"), names))
            counted = aggregate(layer, {**keys, "lado": str(side)}, {"filas": "count(*)"})
            parts.append(counted.selectExpr(f"'{table}' AS tabla", "archivo", "lote", "cast(ingerido AS timestamp_ntz) AS ingerido", "lado", "filas"))
    sides = {"filas_bronze": "coalesce(sum(filas) FILTER (WHERE lado = 0), 0)", "filas_silver": "coalesce(sum(filas) FILTER (WHERE lado = 1), 0)"}
    both = aggregate(union(parts), same("tabla", "archivo", "lote", "ingerido"), sides)
    fine = "filas_bronze = filas_silver AND archivo IS NOT NULL AND lote IS NOT NULL AND ingerido IS NOT NULL"
    return both.selectExpr("*", f"if({fine}, 'OK', 'REVISAR') AS estado")


def _over(plan: Callable[[Layers], DataFrame]) -> Query:
    """Each call lists the files anew; plans are shared inside a call only."""
    return lambda spark, folder: plan(Layers(StarSource(spark, folder).bronze))


def _silver(table: str) -> Callable[[Layers], DataFrame]:
    return lambda layers: business_columns(layers.silver(table))


def _report(table: str) -> Callable[[Layers], DataFrame]:
    return lambda layers: rules.table_report(layers, table)


def _gold(name: str) -> Callable[[Layers], DataFrame]:
    return lambda layers: layers.gold(name)


_PLANS: dict[str, Callable[[Layers], DataFrame]] = {
    "invoice_reconciliation_by_status": invoice_reconciliation_by_status,
    "bronze_volumes": bronze_volumes,
    "bronze_lineage": bronze_lineage,
    **{f"silver_{t}": _silver(t) for t in TABLES},
    "dq_rule_counts": rules.all_rule_counts,
    "dq_null_keys": rules.null_keys,
    "dq_duplicate_keys": rules.duplicate_keys,
    "dq_row_conservation": rules.row_conservation,
    "dq_orphans": rules.orphans,
    "dq_duplicate_attribute": rules.duplicate_attributes,
    "dq_repeated_groups": rules.repeated_groups,
    "dq_weight_sum_enrollments": rules.weight_sum_enrollments,
    "dq_conservation_gold": rules.gold_conservation,
    **{f"dq_{t}": _report(t) for t in TABLES},
    **{name: _gold(name) for name in GOLD},
    **{
        f.__name__: f
        for f in (
            profiling.profile_tables,
            profiling.profile_columns,
            profiling.columns_with_nulls,
            profiling.profile_primary_keys,
            profiling.profile_foreign_keys,
            profiling.profile_logical_link,
            profiling.profile_categories,
            profiling.category_distribution,
            profiling.category_spelling_variants,
            profiling.profile_dates,
            profiling.temporal_rules,
            profiling.age_at_enrollment,
            profiling.type_report,
            profiling.columns_to_convert,
            profiling.rule_registry,
            profiling.business_rules,
            profiling.rules_to_review,
            profiling.rule_samples,
            profiling.rule_violations,
            profiling.inferred_column_types,
            profiling.invoice_line_reconciliation,
            profiling.country_distribution,
            profiling.validation_summary,
            insights.kpis_vertical,
            insights.executive_volumes,
            insights.executive_rates,
            insights.enrollment_status_share,
            insights.top_courses_volume,
            insights.top_courses_failure,
            insights.top_courses_dropout,
            insights.student_situation,
            insights.observed_score_distribution,
            insights.observed_score_histogram,
            insights.invoice_status_share,
            insights.payment_reconciliation_share,
            insights.paid_but_underpaid,
            insights.currency_coverage,
            insights.invoice_item_quality,
            insights.subscription_kpis,
            insights.subscription_status_share,
            insights.subscription_issues,
            insights.opportunity_stage_share,
            insights.opportunity_state_share,
            insights.win_rate,
            insights.crm_amounts,
            insights.top_open_pipeline,
            insights.opportunity_temporal_quality,
            insights.opportunity_contact_share,
            insights.activity_type_counts,
            insights.activity_assignment_share,
            insights.lead_status_share,
            insights.lead_source_conversion,
            insights.lead_score_conversion,
            insights.integration_validation,
            insights.customer_population,
            insights.student_360_by_situation,
            insights.academic_billing_detail,
            insights.academics_by_subscription,
            insights.academics_by_billing_issue,
        )
    },
    "category_lookup": lambda layers: profiling.distribution_of(layers, "invoices", "status"),
}

QUERIES: dict[str, Query] = {name: _over(plan) for name, plan in _PLANS.items()}
