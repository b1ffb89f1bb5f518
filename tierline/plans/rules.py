"""Silver quality checks. Missing keys, duplicate keys and lost rows stop a run; the rest is reported.

A rule is a SQL condition that is true for a violating row. All rules of a table are counted in one
pass over it; a NULL condition is no violation.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from tierline.catalogue import ENROLLMENT_STATUS, INVOICE_STATUS, RELATIONS, SUBSCRIPTION_STATUS, TABLES
from tierline.functions.cleanse import blank
from tierline.operators.links import duplicate_groups, orphan_keys
from tierline.operators.measures import add, aggregate, count_of, n, same, side_by_side, union
from tierline.plans.silver import GROUP_COLUMNS


def _outside(column: str, accepted: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in accepted)
    return f"{column} IS NULL OR {column} NOT IN ({listed})"


def _blanks(*columns: str) -> dict[str, str]:
    return {f"{c}_blank": blank(c) for c in columns}


def _nulls(*columns: str) -> dict[str, str]:
    return {f"{c}_null": f"{c} IS NULL" for c in columns}


def _not(**flags: str) -> dict[str, str]:
    return {rule: f"NOT {flag}" for rule, flag in flags.items()}


RULES: dict[str, dict[str, str]] = {
    "students": _not(dates_inconsistent="is_temporally_valid"),
    "professors": _nulls("hired_at"),
    "courses": {**_nulls("credits"), "credits_not_positive": "credits <= 0", **_blanks("professor_id")},
    "semesters": {
        **_nulls("year", "half"),
        "half_invalid": "half NOT IN (1, 2)",
        "dates_null": "start_date IS NULL OR end_date IS NULL",
        **_not(dates_inconsistent="is_temporally_valid"),
    },
    "enrollments": {
        **_nulls("enrolled_at"),
        "status_invalid": _outside("status", ENROLLMENT_STATUS),
        "combination_repeated": "is_repeated_combination",
    },
    "grades": {
        **_blanks("assessment"),
        **_not(score_invalid="is_score_valid", weight_invalid="is_weight_valid"),
        **_nulls("graded_at"),
        **_blanks("enrollment_id"),
        **_not(weight_sum_not_one="is_weight_sum_one"),
    },
    "customers": {
        **_blanks("external_ref"),
        **_nulls("created_at"),
        **_blanks("segment"),
        **_not(without_student="is_student_linked"),
    },
    "products": {
        **_blanks("sku", "name", "category"),
        **_nulls("monthly_price"),
        "monthly_price_negative": "monthly_price < 0",
        **_nulls("active"),
    },
    "subscriptions": {
        "status_invalid": _outside("status", SUBSCRIPTION_STATUS),
        "dates_null": "start_date IS NULL OR end_date IS NULL",
        **_not(dates_inconsistent="is_temporally_valid"),
        **_blanks("customer_id", "product_id"),
        **_not(customer_missing="is_customer_linked", product_missing="is_product_linked"),
    },
    "invoices": {
        "dates_null": "issued_at IS NULL OR due_at IS NULL",
        **_not(dates_inconsistent="is_temporally_valid", total_invalid="is_total_valid"),
        "status_invalid": _outside("status", INVOICE_STATUS),
        **_blanks("currency", "customer_id"),
        **_not(customer_missing="is_customer_linked"),
    },
    "invoice_items": {
        **_not(
            quantity_invalid="is_quantity_valid",
            unit_price_invalid="is_unit_price_valid",
            line_total_invalid="is_line_total_valid",
        ),
        **_blanks("invoice_id", "product_id"),
        **_not(invoice_missing="is_invoice_linked", product_missing="is_product_linked"),
    },
    "payments": {
        **_not(amount_invalid="is_amount_valid"),
        **_nulls("paid_at"),
        **_not(method_invalid="is_method_valid"),
        **_blanks("invoice_id"),
        **_not(invoice_missing="is_invoice_linked", paid_before_issue="is_temporally_valid"),
    },
    "accounts": {
        **_blanks("name", "industry", "country"),
        **_not(
            annual_revenue_invalid="is_annual_revenue_valid",
            employees_invalid="is_employees_valid",
            created_at_invalid="is_created_at_valid",
        ),
    },
    "contacts": {
        **_blanks("first_name", "last_name"),
        **_not(email_missing="is_email_present"),
        **_blanks("phone", "title"),
        **_not(created_at_invalid="is_created_at_valid"),
        **_blanks("account_id"),
        **_not(account_missing="is_account_linked"),
    },
    "leads": {
        **_blanks("first_name", "last_name"),
        **_not(
            email_missing="is_email_present",
            source_invalid="is_source_valid",
            status_invalid="is_status_valid",
            score_invalid="is_score_valid",
            created_at_invalid="is_created_at_valid",
        ),
    },
    "opportunities": {
        **_blanks("name"),
        **_not(stage_invalid="is_stage_valid", amount_invalid="is_amount_valid"),
        **_nulls("created_at", "close_date"),
        **_not(dates_inconsistent="is_temporally_valid"),
        **_blanks("account_id"),
        **_not(account_missing="is_account_linked"),
    },
    "opportunity_contacts": {
        **_not(
            role_invalid="is_role_valid",
            opportunity_missing="is_opportunity_linked",
            contact_missing="is_contact_linked",
        ),
        "same_account": "is_same_account",
        **_not(different_account="is_same_account"),
    },
    "activities": {
        **_not(type_invalid="is_type_valid"),
        **_blanks("subject"),
        **_not(
            occurred_at_invalid="is_occurred_at_valid",
            without_contact="has_contact_id",
            without_opportunity="has_opportunity_id",
            without_reference="has_any_reference",
        ),
        "with_both_references": "has_contact_id AND has_opportunity_id",
        "contact_missing": "has_contact_id AND NOT is_contact_linked",
        "opportunity_missing": "has_opportunity_id AND NOT is_opportunity_linked",
    },
}

# Relations whose orphans are counted as distinct keys.
ORPHAN_CHECKS = [r for r in RELATIONS if r[0] in ("courses", "enrollments", "grades")]
# Attributes that should not repeat although they are no keys.
UNIQUE_ATTRIBUTES = (("customers", "external_ref"), ("products", "sku"))

KEY_MISSING = "key_missing"


def _stack(df: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return df.selectExpr(f"stack({len(names)}, {pairs}) AS ({label}, {value})")


def null_key(table: str) -> str:
    return " OR ".join(blank(k) for k in TABLES[table].key)


def _by_joins(table: str, rules: dict[str, str]) -> list[dict[str, str]]:
    """The rules (name -> SQL) in parts: first those that read no joined column, then each set of joins that no other includes."""
    spec = TABLES[table]
    made = {x.flag: {x.flag} for x in spec.links}
    made |= {c: {x.flag for x in spec.links if any(v in sql for v in x.carry.values())} for c, sql in spec.after_links.items()}
    made |= {c: {"group"} for c in GROUP_COLUMNS.get(table, ())}
    reads = {rule: frozenset().union(*[joins for c, joins in made.items() if re.search(rf"\b{c}\b", sql)]) for rule, sql in rules.items()}
    sets = set(reads.values())
    widest = sorted((s for s in sets if s and not any(s < other for other in sets)), key=sorted)
    place = {rule: next(i for i, s in enumerate([frozenset(), *widest]) if joins <= s) for rule, joins in reads.items()}
    return [part for i in range(len(widest) + 1) if (part := {rule: rules[rule] for rule in rules if place[rule] == i})]


def rule_counts(layers, table: str) -> DataFrame:
    """(rule, violations) for one table, missing keys first.

    Rules over joined columns are counted apart from the others, so that a join shuffles its own keys and what its rules
    read, and not all columns of the table.
    """
    rules = {KEY_MISSING: null_key(table), **RULES[table]}
    parts = [aggregate(layers.silver(table), {}, {rule: n(sql) for rule, sql in part.items()}) for part in _by_joins(table, rules)]
    return _stack(side_by_side(parts) if len(parts) > 1 else parts[0], list(rules), "rule", "violations")


def _one(df: DataFrame, column: str, rule: str) -> DataFrame:
    return df.selectExpr(f"'{rule}' AS rule", f"{column} AS violations")


def _orphans(layers, relation: tuple) -> DataFrame:
    child, column, parent, _ = relation
    parents = layers.reference(parent, TABLES[parent].key[0])
    keys = orphan_keys(layers.reference(child, column), column, parents, TABLES[parent].key[0])
    return aggregate(keys, {}, {"orphan_keys": "count(*)"})


def _repeated_attribute(layers, table: str, column: str) -> DataFrame:
    named = layers.reference(table, column).filter(f"NOT {blank(column)}")
    return duplicate_groups(named, [column])


def _repeated_combinations(layers) -> DataFrame:
    keys = ["student_id", "course_id", "semester_id"]
    return duplicate_groups(layers.reference("enrollments", *keys), keys)


def _weight_sum_enrollments(layers) -> DataFrame:
    wrong = layers.silver("grades").filter("NOT is_weight_sum_one").select("enrollment_id").distinct()
    return aggregate(wrong, {}, {"enrollments": "count(*)"})


def table_report(layers, table: str) -> DataFrame:
    """(rule, violations): every check of one table."""
    key = list(TABLES[table].key)
    keys = layers.reference(table, *key)
    parts = [rule_counts(layers, table), _one(duplicate_groups(keys, key), "duplicate_groups", "key_duplicated")]
    for relation in ORPHAN_CHECKS:
        if relation[0] == table:
            parts.append(_one(_orphans(layers, relation), "orphan_keys", f"{relation[1]}_orphans"))
    for owner, column in UNIQUE_ATTRIBUTES:
        if owner == table:
            parts.append(_one(_repeated_attribute(layers, owner, column), "duplicate_groups", f"{column}_duplicated"))
    if table == "enrollments":
        parts.append(_one(_repeated_combinations(layers), "duplicate_groups", "combination_groups"))
    if table == "grades":
        parts.append(_one(_weight_sum_enrollments(layers), "enrollments", "enrollments_weight_sum_not_one"))
    return union(parts)


def _named(table: str, df: DataFrame) -> DataFrame:
    return df.selectExpr(f"'{table}' AS table_name", "*")


def all_rule_counts(layers) -> DataFrame:
    return union([_named(t, rule_counts(layers, t)) for t in RULES])


def null_keys(layers) -> DataFrame:
    keys = {t: layers.reference(t, *TABLES[t].key) for t in TABLES}
    return union([_named(t, aggregate(df, {}, {"null_key_rows": n(null_key(t))})) for t, df in keys.items()])


def duplicate_keys(layers) -> DataFrame:
    return union(
        [_named(t, duplicate_groups(layers.reference(t, *TABLES[t].key), list(TABLES[t].key))) for t in TABLES]
    )


def row_conservation(layers) -> DataFrame:
    """(table_name, bronze_rows, silver_rows, silver_keys, state): silver neither drops nor multiplies rows.

    Silver rows are counted by their link flags, both ways, so that no link can be left out of the plan.
    """
    parts = []
    for t, spec in TABLES.items():
        linked = " AND ".join(x.flag for x in spec.links)
        rows = f"{n(linked)} + {n(f'NOT ({linked})')}" if linked else "count(*)"
        before = aggregate(layers.bronze(t), {}, {"bronze_rows": "count(*)"})
        per_key = aggregate(layers.silver(t), same(*spec.key), {"_n": rows})
        after = aggregate(per_key, {}, {"silver_rows": "coalesce(sum(_n), 0)", "silver_keys": "count(*)"})
        parts.append(_named(t, side_by_side([before, after])))
    fine = "bronze_rows = silver_rows AND silver_rows = silver_keys"
    return add(union(parts), {"state": f"if({fine}, 'OK', 'REVISAR')"})


def orphans(layers) -> DataFrame:
    return union(
        [
            _orphans(layers, r).selectExpr(
                f"'{r[0]}' AS table_name", f"'{r[1]}' AS column_name", f"'{r[2]}' AS parent", "orphan_keys"
            )
            for r in ORPHAN_CHECKS
        ]
    )


def duplicate_attributes(layers) -> DataFrame:
    return union(
        [
            _repeated_attribute(layers, t, c).selectExpr(
                f"'{t}' AS table_name", f"'{c}' AS column_name", "duplicate_groups"
            )
            for t, c in UNIQUE_ATTRIBUTES
        ]
    )


def repeated_groups(layers) -> DataFrame:
    return _repeated_combinations(layers)


def weight_sum_enrollments(layers) -> DataFrame:
    return _weight_sum_enrollments(layers)


# Gold objects have a row for each key of silver or gold rows: (object, layer, source, key)
_CONSERVED = (
    ("student_academic_summary", "silver", "students", ("student_id",)),
    ("course_performance_summary", "silver", "courses", ("course_id",)),
    ("customer_subscription_summary", "silver", "customers", ("customer_id",)),
    ("account_crm_summary", "silver", "accounts", ("account_id",)),
    ("lead_funnel_summary", "silver", "leads", ("source",)),
    ("billing_currency_kpis", "gold", "customer_billing_summary", ("currency",)),
    ("course_performance_dashboard", "gold", "course_performance_summary", ("course_id",)),
    ("billing_customer_dashboard", "gold", "customer_billing_summary", ("customer_id", "currency")),
    ("crm_account_dashboard", "gold", "account_crm_summary", ("account_id",)),
    ("lead_source_dashboard", "gold", "lead_funnel_summary", ("source",)),
    ("student_customer_360", "gold", "student_academic_summary", ("student_id",)),
)


def _billing_pairs(layers) -> DataFrame:
    """(customer, currency) pairs of invoices of known customers, which the billing summary must have."""
    invoices = layers.silver("invoices").filter("is_customer_linked").select("customer_id", "currency")
    return invoices.distinct()


def gold_conservation(layers) -> DataFrame:
    """(object, expected_rows, actual_rows, state): gold row counts follow from their inputs."""

    def compare(name: str, expected: DataFrame, actual: DataFrame) -> DataFrame:
        counts = [aggregate(expected, {}, {"expected_rows": "count(*)"}), aggregate(actual, {}, {"actual_rows": "count(*)"})]
        return side_by_side(counts).selectExpr(f"'{name}' AS object", "*")

    parts = []
    for name, layer, source, key in _CONSERVED:
        base = layers.silver(source) if layer == "silver" else layers.gold(source)
        parts.append(compare(name, base.select(*key).distinct(), layers.gold(name)))
    parts.append(compare("customer_billing_summary", _billing_pairs(layers), layers.gold("customer_billing_summary")))
    return add(union(parts), {"state": "if(expected_rows = actual_rows, 'OK', 'REVISAR')"})


class InvalidTable(ValueError):
    """A table breaks a rule that must hold before anything is built on it, or a result does not follow from its inputs."""


def assert_keys(keys: DataFrame, table: str) -> int:
    """Row count of a table's silver key columns; raises on missing or repeated keys.

    Needs the key columns only, so it runs before the table itself is built.
    """
    key = list(TABLES[table].key)
    groups = aggregate(keys, {k: k for k in key}, {"_n": "count(*)"})
    measures = {"rows": "coalesce(sum(_n), 0)", "missing": count_of("_n", null_key(table)), "repeated": n("_n > 1")}
    found = aggregate(groups, {}, measures).first()
    if found["missing"]:
        raise InvalidTable(f"{table}: {found['missing']} rows without a key")
    if found["repeated"]:
        raise InvalidTable(f"{table}: {found['repeated']} duplicated keys")
    return found["rows"]


def assert_gold(layers) -> None:
    """Raises where a gold object has more or fewer rows than its inputs have keys."""
    wrong = gold_conservation(layers).filter("state <> 'OK'").collect()  # a row an object
    if wrong:
        raise InvalidTable("; ".join(f"{r['object']}: {r['expected_rows']} keys, {r['actual_rows']} rows" for r in wrong))
