"""Gold tables of the billing domain. Amounts of different currencies are never added up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.exact import MONEY, money, percent
from tierline.operators.links import hot_key_join
from tierline.operators.measures import FULL_NAME, add, aggregate, count_of, n, per_code, same, sums, zero

_CUSTOMER = ["customer_id", "external_ref", "customer_name", "email", "country", "segment", "is_student_linked"]


def _customers(layers) -> DataFrame:
    return layers.silver("customers").selectExpr(
        "customer_id", "external_ref", f"{FULL_NAME} AS customer_name", "email", "country", "segment",
        "is_student_linked",
    )


def invoice_items_by_invoice(layers) -> DataFrame:
    return aggregate(
        layers.silver("invoice_items"),
        same("invoice_id"),
        {
            "item_count": "count(*)",
            "items_reported_total": money("sum(line_total)"),
            "items_calculated_total": money("sum(calculated_line_total)"),
            "all_quantities_valid": "bool_and(is_quantity_valid)",
            "all_unit_prices_valid": "bool_and(is_unit_price_valid)",
            "all_line_totals_valid": "bool_and(is_line_total_valid)",
        },
    )


def payments_by_invoice(layers) -> DataFrame:
    """Valid linked payments per invoice. Methods are counted from per-(invoice, method) rows."""
    per_method = aggregate(
        layers.silver("payments").filter("is_amount_valid AND is_invoice_linked"),
        same("invoice_id", "method"),
        {"_n": "count(*)", "_sum": "sum(amount)", "_first": "min(paid_at)", "_last": "max(paid_at)"},
    )
    return aggregate(
        per_method,
        same("invoice_id"),
        {
            "payment_count": "sum(_n)",
            "amount_paid": money("sum(_sum)"),
            "first_payment_date": "min(_first)",
            "last_payment_date": "max(_last)",
            "payment_method_count": "count(method)",
        },
    )


def invoice_detail(layers) -> DataFrame:
    """One row per invoice: lines and payments are summed before they meet the invoice.

    All three sides are grouped or keyed by invoice, so they share one partitioning.
    """
    items = layers.gold("invoice_items_by_invoice").selectExpr(
        "invoice_id AS _billed", "item_count", "items_reported_total", "items_calculated_total"
    )
    paid = layers.gold("payments_by_invoice").withColumnRenamed("invoice_id", "_paid")
    joined = (
        layers.silver("invoices")
        .join(items, F.expr("invoice_id = _billed"), "left")
        .join(paid, F.expr("invoice_id = _paid"), "left")
    )
    return add(joined, {"_got": f"coalesce(amount_paid, cast(0 AS {MONEY}))"}).selectExpr(
        "invoice_id",
        "customer_id",
        "currency",
        "status",
        "issued_at",
        "due_at",
        "total AS invoice_total",
        *zero(["item_count"]),
        "items_reported_total",
        "items_calculated_total",
        *zero(["payment_count"]),
        "_got AS amount_paid",
        "first_payment_date",
        "last_payment_date",
        "payment_method_count",
        "_billed IS NULL AS is_without_items",
        "if(_billed IS NULL, NULL, coalesce(abs(total - items_reported_total) <= 0.01, false))"
        " AS does_invoice_match_items",
        f"cast(total - items_reported_total AS {MONEY}) AS invoice_item_difference",
        f"cast(total - _got AS {MONEY}) AS net_balance_amount",
        f"cast(greatest(total - _got, 0) AS {MONEY}) AS outstanding_amount",
        f"cast(greatest(_got - total, 0) AS {MONEY}) AS overpaid_amount",
        "CASE WHEN _got - total > 0.01 THEN 'overpaid' WHEN _got - total >= -0.01 THEN 'exactly_paid'"
        " ELSE 'underpaid' END AS payment_balance_status",
        "coalesce(status = 'paid' AND total - _got > 0.01, false) AS is_paid_status_underpaid",
        "coalesce(status IN ('pending', 'overdue') AND total - _got <= 0.01, false) AS is_open_status_fully_paid",
    )


def _per_customer_currency(layers) -> DataFrame:
    """Invoices rolled up to (customer, currency) before any customer attribute is attached."""
    return aggregate(
        layers.gold("invoice_detail"),
        {"_customer": "customer_id", "currency": "currency"},
        {
            "invoice_count": "count(*)",
            **per_code("status", {f"{s}_invoice_count": s for s in ("paid", "pending", "overdue")}),
            "total_invoiced": money("sum(invoice_total)"),
            "total_paid": money("sum(amount_paid)"),
            "net_balance_amount": money("sum(net_balance_amount)"),
            "overpaid_amount": money("sum(overpaid_amount)"),
            **per_code(
                "payment_balance_status",
                {f"{s}_invoice_count": s for s in ("overpaid", "exactly_paid", "underpaid")},
            ),
            "paid_status_but_underpaid_count": n("is_paid_status_underpaid"),
            "open_status_but_fully_paid_count": n("is_open_status_fully_paid"),
            "outstanding_amount": money("sum(outstanding_amount)"),
            "payment_count": "sum(payment_count)",
            "invoices_with_payment": n("payment_count > 0"),
            "invoices_without_payment": n("payment_count = 0"),
            "invoices_without_items": n("is_without_items"),
            "invoices_matching_item_total": n("does_invoice_match_items"),
            "invoices_not_matching_item_total": n("NOT does_invoice_match_items"),
            "total_absolute_item_difference": money("sum(abs(invoice_item_difference))"),
            "first_invoice_date": "min(issued_at)",
            "last_invoice_date": "max(issued_at)",
            "last_payment_date": "max(last_payment_date)",
        },
    )


def customer_billing_summary(layers) -> DataFrame:
    """One row per (customer, currency); customers without invoices have none."""
    metrics = _per_customer_currency(layers)
    joined = _customers(layers).join(metrics, F.expr("customer_id = _customer"))
    return joined.select(*_CUSTOMER, *[c for c in metrics.columns if c != "_customer"])


_SUBSCRIPTION_SUMS = [
    "total_subscriptions", "active_subscriptions", "paused_subscriptions", "cancelled_subscriptions",
    "temporally_invalid_subscriptions",
]
_SUBSCRIPTION_COUNTS = [
    *_SUBSCRIPTION_SUMS[:4], "distinct_products", "active_distinct_products", _SUBSCRIPTION_SUMS[4],
    "subscriptions_to_active_products", "subscriptions_to_inactive_products",
    "active_subscriptions_to_inactive_products",
]
_SUBSCRIPTION_DATES = [
    "first_subscription_date", "latest_subscription_start_date", "latest_subscription_end_date",
]


def customer_subscription_summary(layers) -> DataFrame:
    """One row per customer. Subscriptions are grouped by (customer, product) before products are
    joined: the distinct product counts become row counts and a popular product shrinks first."""
    per_product = aggregate(
        layers.silver("subscriptions"),
        same("customer_id", "product_id"),
        {
            "total_subscriptions": "count(*)",
            **per_code("status", {f"{s}_subscriptions": s for s in ("active", "paused", "cancelled")}),
            "temporally_invalid_subscriptions": n("NOT is_temporally_valid"),
            "_first": "min(start_date)",
            "_latest": "max(start_date)",
            "_latest_end": "max(end_date)",
        },
    )
    products = layers.reference("products", "product_id", "active").withColumnRenamed("product_id", "_product")
    metrics = aggregate(
        hot_key_join(per_product, products, "product_id", "_product", "customer_id"),
        {"_customer": "customer_id"},
        {
            **{c: f"sum({c})" for c in _SUBSCRIPTION_SUMS},
            "distinct_products": "count(product_id)",
            "active_distinct_products": n("product_id IS NOT NULL AND active_subscriptions > 0"),
            "subscriptions_to_active_products": count_of("total_subscriptions", "active"),
            "subscriptions_to_inactive_products": count_of("total_subscriptions", "NOT active"),
            "active_subscriptions_to_inactive_products": count_of("active_subscriptions", "NOT active"),
            "first_subscription_date": "min(_first)",
            "latest_subscription_start_date": "max(_latest)",
            "latest_subscription_end_date": "max(_latest_end)",
        },
    )
    joined = _customers(layers).join(metrics, F.expr("customer_id = _customer"), "left")
    return joined.selectExpr(*_CUSTOMER, *zero(_SUBSCRIPTION_COUNTS), *_SUBSCRIPTION_DATES)


# KPI column -> column of the billing summary
_INVOICE_SUMS = {
    **{f"{s}_invoices": f"{s}_invoice_count" for s in ("paid", "pending", "overdue")},
    "total_payments": "payment_count",
}
_BALANCE_SUMS = {
    **{f"{s}_invoices": f"{s}_invoice_count" for s in ("overpaid", "exactly_paid", "underpaid")},
    "paid_status_but_underpaid": "paid_status_but_underpaid_count",
    "open_status_but_fully_paid": "open_status_but_fully_paid_count",
    **same("invoices_without_items", "invoices_matching_item_total", "invoices_not_matching_item_total"),
}
ROLLUP = {"total_invoices": "invoice_count", **_INVOICE_SUMS, **_BALANCE_SUMS}
_AMOUNTS = ("total_invoiced", "total_paid", "net_balance_amount", "outstanding_amount", "overpaid_amount")


def billing_currency_kpis(layers) -> DataFrame:
    """One row per currency. The summary has one row per (customer, currency), so its rows are the customers."""
    totals = aggregate(
        layers.gold("customer_billing_summary"),
        same("currency"),
        {
            "customers": "count(customer_id)",
            **sums({"total_invoices": "invoice_count", **_INVOICE_SUMS}),
            **{c: money(f"sum({c})") for c in _AMOUNTS},
            **sums(_BALANCE_SUMS),
        },
    )
    rates = {f"{s}_invoice_rate_pct": percent(f"{s}_invoices", "total_invoices")
             for s in ("paid", "overdue", "overpaid", "underpaid")}
    checked = "invoices_matching_item_total + invoices_not_matching_item_total"
    rates["invoice_item_mismatch_rate_pct"] = percent("invoices_not_matching_item_total", checked)
    return add(totals, rates)
