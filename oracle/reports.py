"""SQL of the quality reports, the profiling suite and the analysis datasets."""

from __future__ import annotations

from oracle.sql import avg2, big, cents, money, pct, ratio

KEYS = {
    "students": ("student_id",), "professors": ("professor_id",), "courses": ("course_id",),
    "semesters": ("semester_id",), "enrollments": ("enrollment_id",), "grades": ("grade_id",),
    "customers": ("customer_id",), "products": ("product_id",), "subscriptions": ("subscription_id",),
    "invoices": ("invoice_id",), "invoice_items": ("invoice_item_id",), "payments": ("payment_id",),
    "accounts": ("account_id",), "contacts": ("contact_id",), "leads": ("lead_id",),
    "opportunities": ("opportunity_id",), "opportunity_contacts": ("opportunity_id", "contact_id"),
    "activities": ("activity_id",),
}
# Bronze columns with the type expected of them; d(p,s) stands for a decimal.
COLUMNS = {
    "students": [
        ("student_id", "string"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("email", "string"),
        ("birth_date", "date"),
        ("enrolled_at", "timestamp"),
        ("country", "string"),
    ],
    "professors": [
        ("professor_id", "string"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("email", "string"),
        ("department", "string"),
        ("hired_at", "timestamp"),
    ],
    "courses": [
        ("course_id", "string"),
        ("code", "string"),
        ("name", "string"),
        ("credits", "integer"),
        ("department", "string"),
        ("professor_id", "string"),
    ],
    "semesters": [
        ("semester_id", "string"),
        ("code", "string"),
        ("year", "integer"),
        ("half", "integer"),
        ("start_date", "date"),
        ("end_date", "date"),
    ],
    "enrollments": [
        ("enrollment_id", "string"),
        ("enrolled_at", "timestamp"),
        ("status", "string"),
        ("student_id", "string"),
        ("course_id", "string"),
        ("semester_id", "string"),
    ],
    "grades": [
        ("grade_id", "string"),
        ("assessment", "string"),
        ("score", "d(6,2)"),
        ("weight", "d(5,4)"),
        ("graded_at", "timestamp"),
        ("enrollment_id", "string"),
    ],
    "customers": [
        ("customer_id", "string"),
        ("external_ref", "string"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("email", "string"),
        ("country", "string"),
        ("created_at", "timestamp"),
        ("segment", "string"),
    ],
    "products": [
        ("product_id", "string"),
        ("sku", "string"),
        ("name", "string"),
        ("category", "string"),
        ("monthly_price", "d(10,2)"),
        ("active", "boolean"),
    ],
    "subscriptions": [
        ("subscription_id", "string"),
        ("status", "string"),
        ("start_date", "date"),
        ("end_date", "date"),
        ("customer_id", "string"),
        ("product_id", "string"),
    ],
    "invoices": [
        ("invoice_id", "string"),
        ("issued_at", "timestamp"),
        ("due_at", "timestamp"),
        ("total", "d(12,2)"),
        ("status", "string"),
        ("currency", "string"),
        ("customer_id", "string"),
    ],
    "invoice_items": [
        ("invoice_item_id", "string"),
        ("quantity", "integer"),
        ("unit_price", "d(12,2)"),
        ("line_total", "d(14,2)"),
        ("invoice_id", "string"),
        ("product_id", "string"),
    ],
    "payments": [
        ("payment_id", "string"),
        ("amount", "d(12,2)"),
        ("paid_at", "timestamp"),
        ("method", "string"),
        ("invoice_id", "string"),
    ],
    "accounts": [
        ("account_id", "string"),
        ("name", "string"),
        ("industry", "string"),
        ("country", "string"),
        ("annual_revenue", "d(16,2)"),
        ("employees", "integer"),
        ("created_at", "timestamp"),
    ],
    "contacts": [
        ("contact_id", "string"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("email", "string"),
        ("phone", "string"),
        ("title", "string"),
        ("created_at", "timestamp"),
        ("account_id", "string"),
    ],
    "leads": [
        ("lead_id", "string"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("email", "string"),
        ("source", "string"),
        ("status", "string"),
        ("score", "integer"),
        ("created_at", "timestamp"),
    ],
    "opportunities": [
        ("opportunity_id", "string"),
        ("name", "string"),
        ("stage", "string"),
        ("amount", "d(16,2)"),
        ("close_date", "date"),
        ("created_at", "timestamp"),
        ("account_id", "string"),
    ],
    "opportunity_contacts": [
        ("opportunity_id", "string"),
        ("contact_id", "string"),
        ("role", "string"),
    ],
    "activities": [
        ("activity_id", "string"),
        ("type", "string"),
        ("subject", "string"),
        ("occurred_at", "timestamp"),
        ("contact_id", "string"),
        ("opportunity_id", "string"),
    ],
}
# Columns of codes.
CATEGORIES = {
    "students": ["country"], "professors": ["department"], "courses": ["department"], "semesters": ["half"],
    "enrollments": ["status"], "grades": ["assessment"], "customers": ["country", "segment"],
    "products": ["category", "active"], "subscriptions": ["status"], "invoices": ["status", "currency"],
    "payments": ["method"], "accounts": ["industry", "country"], "contacts": ["title"],
    "leads": ["source", "status"], "opportunities": ["stage"], "opportunity_contacts": ["role"],
    "activities": ["type"],
}
# child, column, parent, key, nullable
RELATIONS = [
    ("courses", "professor_id", "professors", False), ("enrollments", "student_id", "students", False),
    ("enrollments", "course_id", "courses", False), ("enrollments", "semester_id", "semesters", False),
    ("grades", "enrollment_id", "enrollments", False), ("subscriptions", "customer_id", "customers", False),
    ("subscriptions", "product_id", "products", False), ("invoices", "customer_id", "customers", False),
    ("invoice_items", "invoice_id", "invoices", False), ("invoice_items", "product_id", "products", False),
    ("payments", "invoice_id", "invoices", False), ("contacts", "account_id", "accounts", False),
    ("opportunities", "account_id", "accounts", False),
    ("opportunity_contacts", "opportunity_id", "opportunities", False),
    ("opportunity_contacts", "contact_id", "contacts", False), ("activities", "contact_id", "contacts", True),
    ("activities", "opportunity_id", "opportunities", True),
]

_blank = lambda c: f"({c} IS NULL OR trim({c}) = '')"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _wrong(*columns: str) -> dict[str, str]:
    return {f"{c}_blank": _blank(c) for c in columns}


CHECKS = {
    "students": {"dates_inconsistent": "NOT is_temporally_valid"},
    "professors": {"hired_at_null": "hired_at IS NULL"},
    "courses": {"credits_null": "credits IS NULL", "credits_not_positive": "credits <= 0", **_wrong("professor_id")},
    "semesters": {
        "year_null": "year IS NULL", "half_null": "half IS NULL", "half_invalid": "half <> 1 AND half <> 2",
        "dates_null": "start_date IS NULL OR end_date IS NULL", "dates_inconsistent": "NOT is_temporally_valid",
    },
    "enrollments": {
        "enrolled_at_null": "enrolled_at IS NULL",
        "status_invalid": "coalesce(status, '') NOT IN ('completed', 'active', 'failed', 'dropped')",
        "combination_repeated": "is_repeated_combination",
    },
    "grades": {
        **_wrong("assessment"), "score_invalid": "NOT is_score_valid", "weight_invalid": "NOT is_weight_valid",
        "graded_at_null": "graded_at IS NULL", **_wrong("enrollment_id"), "weight_sum_not_one": "NOT is_weight_sum_one",
    },
    "customers": {
        **_wrong("external_ref"), "created_at_null": "created_at IS NULL", **_wrong("segment"),
        "without_student": "NOT is_student_linked",
    },
    "products": {
        **_wrong("sku", "name", "category"), "monthly_price_null": "monthly_price IS NULL",
        "monthly_price_negative": "monthly_price < 0", "active_null": "active IS NULL",
    },
    "subscriptions": {
        "status_invalid": "coalesce(status, '') NOT IN ('active', 'cancelled', 'paused')",
        "dates_null": "start_date IS NULL OR end_date IS NULL", "dates_inconsistent": "NOT is_temporally_valid",
        **_wrong("customer_id", "product_id"), "customer_missing": "NOT is_customer_linked",
        "product_missing": "NOT is_product_linked",
    },
    "invoices": {
        "dates_null": "issued_at IS NULL OR due_at IS NULL", "dates_inconsistent": "NOT is_temporally_valid",
        "total_invalid": "NOT is_total_valid",
        "status_invalid": "coalesce(status, '') NOT IN ('paid', 'pending', 'overdue')",
        **_wrong("currency", "customer_id"), "customer_missing": "NOT is_customer_linked",
    },
    "invoice_items": {
        "quantity_invalid": "NOT is_quantity_valid", "unit_price_invalid": "NOT is_unit_price_valid",
        "line_total_invalid": "NOT is_line_total_valid", **_wrong("invoice_id", "product_id"),
        "invoice_missing": "NOT is_invoice_linked", "product_missing": "NOT is_product_linked",
    },
    "payments": {
        "amount_invalid": "NOT is_amount_valid", "paid_at_null": "paid_at IS NULL",
        "method_invalid": "NOT is_method_valid", **_wrong("invoice_id"), "invoice_missing": "NOT is_invoice_linked",
        "paid_before_issue": "NOT is_temporally_valid",
    },
    "accounts": {
        **_wrong("name", "industry", "country"), "annual_revenue_invalid": "NOT is_annual_revenue_valid",
        "employees_invalid": "NOT is_employees_valid", "created_at_invalid": "NOT is_created_at_valid",
    },
    "contacts": {
        **_wrong("first_name", "last_name"), "email_missing": "NOT is_email_present", **_wrong("phone", "title"),
        "created_at_invalid": "NOT is_created_at_valid", **_wrong("account_id"),
        "account_missing": "NOT is_account_linked",
    },
    "leads": {
        **_wrong("first_name", "last_name"), "email_missing": "NOT is_email_present",
        "source_invalid": "NOT is_source_valid", "status_invalid": "NOT is_status_valid",
        "score_invalid": "NOT is_score_valid", "created_at_invalid": "NOT is_created_at_valid",
    },
    "opportunities": {
        **_wrong("name"), "stage_invalid": "NOT is_stage_valid", "amount_invalid": "NOT is_amount_valid",
        "created_at_null": "created_at IS NULL", "close_date_null": "close_date IS NULL",
        "dates_inconsistent": "NOT is_temporally_valid", **_wrong("account_id"),
        "account_missing": "NOT is_account_linked",
    },
    "opportunity_contacts": {
        "role_invalid": "NOT is_role_valid", "opportunity_missing": "NOT is_opportunity_linked",
        "contact_missing": "NOT is_contact_linked", "same_account": "is_same_account",
        "different_account": "NOT is_same_account",
    },
    "activities": {
        "type_invalid": "NOT is_type_valid", **_wrong("subject"), "occurred_at_invalid": "NOT is_occurred_at_valid",
        "without_contact": "contact_id IS NULL", "without_opportunity": "opportunity_id IS NULL",
        "without_reference": "contact_id IS NULL AND opportunity_id IS NULL",
        "with_both_references": "contact_id IS NOT NULL AND opportunity_id IS NOT NULL",
        "contact_missing": "has_contact_id AND NOT is_contact_linked",
        "opportunity_missing": "has_opportunity_id AND NOT is_opportunity_linked",
    },
}

_missing = lambda t: " OR ".join(_blank(k) for k in KEYS[t])


def _rule_rows(table: str, lead: str = "") -> list[str]:
    rules = {"key_missing": _missing(table), **CHECKS[table]}
    return [
        f"SELECT {lead}'{rule}' AS rule, count(*) FILTER (WHERE {sql}) AS violations FROM s_{table}"
        for rule, sql in rules.items()
    ]


def _groups(source: str, keys: tuple[str, ...], where: str = "true") -> str:
    listed = ", ".join(keys)
    return f"(SELECT count(*) FROM (SELECT {listed} FROM {source} WHERE {where} GROUP BY {listed} HAVING count(*) > 1))"


def _orphans(child: str, column: str, parent: str) -> str:
    key = KEYS[parent][0]
    return (
        f"(SELECT count(DISTINCT {column}) FROM s_{child} WHERE NOT {_blank(column)}"
        f" AND {column} NOT IN (SELECT {key} FROM s_{parent} WHERE NOT {_blank(key)}))"
    )


_COMBINATION = ("student_id", "course_id", "semester_id")
_WEIGHT_SUM = "(SELECT count(*) FROM (SELECT DISTINCT enrollment_id FROM s_grades WHERE NOT is_weight_sum_one))"


def _report(table: str) -> str:
    rows = _rule_rows(table)
    rows.append(f"SELECT 'key_duplicated', {_groups(f's_{table}', KEYS[table])}")
    for child, column, parent, _ in RELATIONS:
        if child == table and table in ("courses", "enrollments", "grades"):
            rows.append(f"SELECT '{column}_orphans', {_orphans(child, column, parent)}")
    if table == "customers":
        rows.append(f"SELECT 'external_ref_duplicated', {_groups('s_customers', ('external_ref',), f'NOT {_blank("external_ref")}')}")
    if table == "products":
        rows.append(f"SELECT 'sku_duplicated', {_groups('s_products', ('sku',), f'NOT {_blank("sku")}')}")
    if table == "enrollments":
        rows.append(f"SELECT 'combination_groups', {_groups('s_enrollments', _COMBINATION)}")
    if table == "grades":
        rows.append(f"SELECT 'enrollments_weight_sum_not_one', {_WEIGHT_SUM}")
    return _union(rows)


def _conserved(name: str, expected: str) -> str:
    return (
        f"SELECT '{name}' AS object, ({expected}) AS expected_rows, (SELECT count(*) FROM g_{name}) AS actual_rows"
    )


_GOLD_ROWS = {
    "student_academic_summary": "SELECT count(*) FROM s_students",
    "course_performance_summary": "SELECT count(*) FROM s_courses",
    "customer_subscription_summary": "SELECT count(*) FROM s_customers",
    "account_crm_summary": "SELECT count(*) FROM s_accounts",
    "lead_funnel_summary": "SELECT count(*) FROM (SELECT DISTINCT source FROM s_leads)",
    "billing_currency_kpis": "SELECT count(*) FROM (SELECT DISTINCT currency FROM g_customer_billing_summary)",
    "course_performance_dashboard": "SELECT count(*) FROM g_course_performance_summary",
    "billing_customer_dashboard": "SELECT count(*) FROM g_customer_billing_summary",
    "crm_account_dashboard": "SELECT count(*) FROM g_account_crm_summary",
    "lead_source_dashboard": "SELECT count(*) FROM g_lead_funnel_summary",
    "student_customer_360": "SELECT count(*) FROM g_student_academic_summary",
    "customer_billing_summary": "SELECT count(*) FROM (SELECT DISTINCT customer_id, currency FROM s_invoices WHERE is_customer_linked)",
}

REPORTS: dict[str, str] = {
    "invoice_reconciliation_by_status": """
SELECT status, payment_balance_status, count(*) AS invoices, count(*) FILTER (WHERE is_without_items) AS without_items,
       count(*) FILTER (WHERE does_invoice_match_items) AS matching_items,
       count(*) FILTER (WHERE is_paid_status_underpaid) AS paid_but_underpaid,
       count(*) FILTER (WHERE is_open_status_fully_paid) AS open_but_fully_paid
FROM g_invoice_detail GROUP BY status, payment_balance_status""",
    "bronze_volumes": _union(
        [f"SELECT '{t}' AS tabla, '{t}.csv' AS archivo, count(*) AS filas FROM b_{t}" for t in KEYS]
    ),
    "dq_rule_counts": _union([row for t in CHECKS for row in _rule_rows(t, f"'{t}' AS table_name, ")]),
    "dq_null_keys": _union(
        [f"SELECT '{t}' AS table_name, count(*) FILTER (WHERE {_missing(t)}) AS null_key_rows FROM s_{t}" for t in KEYS]
    ),
    "dq_duplicate_keys": _union(
        [f"SELECT '{t}' AS table_name, {_groups(f's_{t}', KEYS[t])} AS duplicate_groups" for t in KEYS]
    ),
    "dq_row_conservation": "SELECT *, CASE WHEN bronze_rows = silver_rows AND silver_rows = silver_keys THEN 'OK' ELSE 'REVISAR' END AS state FROM ("
    + _union(
        [
            f"SELECT '{t}' AS table_name, (SELECT count(*) FROM b_{t}) AS bronze_rows,"
            f" (SELECT count(*) FROM s_{t}) AS silver_rows,"
            f" (SELECT count(*) FROM (SELECT DISTINCT {', '.join(k)} FROM s_{t})) AS silver_keys"
            for t, k in KEYS.items()
        ]
    )
    + ")",
    "dq_orphans": _union(
        [
            f"SELECT '{c}' AS table_name, '{k}' AS column_name, '{p}' AS parent, {_orphans(c, k, p)} AS orphan_keys"
            for c, k, p, _ in RELATIONS
            if c in ("courses", "enrollments", "grades")
        ]
    ),
    "dq_duplicate_attribute": _union(
        [
            f"SELECT '{t}' AS table_name, '{c}' AS column_name,"
            f" {_groups(f's_{t}', (c,), f'NOT {_blank(c)}')} AS duplicate_groups"
            for t, c in (("customers", "external_ref"), ("products", "sku"))
        ]
    ),
    "dq_repeated_groups": f"SELECT {_groups('s_enrollments', _COMBINATION)} AS duplicate_groups",
    "dq_weight_sum_enrollments": f"SELECT {_WEIGHT_SUM} AS enrollments",
    "dq_conservation_gold": "SELECT *, CASE WHEN expected_rows = actual_rows THEN 'OK' ELSE 'REVISAR' END AS state FROM ("
    + _union([_conserved(name, sql) for name, sql in _GOLD_ROWS.items()])
    + ")",
    **{f"dq_{t}": _report(t) for t in CHECKS},
}

# ---- profiling

_all = lambda t: ", ".join(c for c, _ in COLUMNS[t])
_review = lambda fine: f"CASE WHEN {fine} THEN 'OK' ELSE 'REVISAR' END"


def _columns_profile() -> str:
    return _union(
        [
            f"SELECT '{t}' AS tabla, '{c}' AS columna, 'string' AS tipo_actual, count(*) - count({c}) AS cantidad_nulos,"
            f" {pct(f'count(*) - count({c})', 'count(*)')} AS porcentaje_nulos,"
            f" count(DISTINCT {c}) AS valores_unicos FROM b_{t}"
            for t, columns in COLUMNS.items()
            for c, _ in columns
        ]
    )


def _keys_profile() -> str:
    parts = []
    for t, keys in KEYS.items():
        listed, missing = ", ".join(keys), " OR ".join(f"{k} IS NULL" for k in keys)
        parts.append(
            f"SELECT '{t}' AS tabla, '{' + '.join(keys)}' AS llave_primaria, {big('sum(n)')} AS cantidad_filas,"
            f" count(*) AS pk_unicas, {big(f'coalesce(sum(n) FILTER (WHERE {missing}), 0)')} AS pk_nulas,"
            f" {big('coalesce(sum(n) FILTER (WHERE n > 1), 0)')} AS filas_con_pk_duplicada"
            f" FROM (SELECT {listed}, count(*) AS n FROM b_{t} GROUP BY {listed})"
        )
    return (
        f"SELECT *, {_review('pk_nulas = 0 AND filas_con_pk_duplicada = 0')} AS estado FROM (" + _union(parts) + ")"
    )


def _relations_profile() -> str:
    parts = []
    for c, k, p, nullable in RELATIONS:
        pk = KEYS[p][0]
        parts.append(
            f"SELECT '{c}' AS tabla_hija, '{k}' AS columna_fk, '{p}' AS tabla_padre, '{pk}' AS columna_pk,"
            f" {str(nullable).lower()} AS permite_nulos, count(*) AS cantidad_filas, count(*) - count({k}) AS valores_nulos,"
            f" count(*) FILTER (WHERE {k} NOT IN (SELECT {pk} FROM b_{p} WHERE {pk} IS NOT NULL)) AS valores_huerfanos FROM b_{c}"
        )
    share = pct("valores_huerfanos", "cantidad_filas - valores_nulos")
    fine = "valores_huerfanos = 0 AND (valores_nulos = 0 OR permite_nulos)"
    return (
        f"SELECT *, coalesce({share}, CAST(0 AS DECIMAL(18,2))) AS porcentaje_huerfanos, {_review(fine)} AS estado FROM ("
        + _union(parts)
        + ")"
    )


def _categories() -> list[tuple[str, str]]:
    return [(t, c) for t, columns in CATEGORIES.items() for c in columns]


_normal = r"lower(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"


def _distribution(t: str, c: str) -> str:
    return (
        f"SELECT '{t}' AS tabla, '{c}' AS columna, coalesce({c}, 'VALOR_NULO') AS valor, count(*) AS cantidad,"
        f" {pct('count(*)', f'(SELECT count(*) FROM b_{t})')} AS porcentaje FROM b_{t} GROUP BY coalesce({c}, 'VALOR_NULO')"
    )


_TARGET = {"integer": "INTEGER", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}


def _types() -> str:
    names = {"string": "VARCHAR", "integer": "INTEGER", "decimal": "NUMERIC", "boolean": "BOOLEAN", "date": "DATE",
             "timestamp": "TIMESTAMP"}
    parts = []
    for t, columns in COLUMNS.items():
        for c, kind in columns:
            logical = "decimal" if kind.startswith("d(") else kind
            target = kind.replace("d(", "DECIMAL(") if logical == "decimal" else _TARGET.get(kind)
            good = f"count(TRY_CAST(trim({c}) AS {target}))" if target else f"count({c})"
            needs = "NO" if logical == "string" else "SÍ"
            parts.append(
                f"SELECT '{t}' AS tabla, '{c}' AS columna, '{logical}' AS tipo_esperado_silver,"
                f" '{names[logical]}' AS tipo_sql_silver, count({c}) AS valores, {good} AS convertibles,"
                f" count({c}) - {good} AS no_convertibles, '{needs}' AS requiere_conversion FROM b_{t}"
            )
    return _union(parts)


def _dates() -> str:
    parts = []
    for t, columns in COLUMNS.items():
        for c, kind in columns:
            if kind in ("date", "timestamp"):
                moment = f"TRY_CAST(trim({c}) AS TIMESTAMP)"
                parts.append(
                    f"SELECT '{t}' AS tabla, '{c}' AS columna, count(*) AS cantidad_filas,"
                    f" count(*) - count({c}) AS valores_nulos, count({moment}) AS fechas_validas,"
                    f" count({c}) - count({moment}) AS fechas_invalidas, min({moment}) AS fecha_minima,"
                    f" max({moment}) AS fecha_maxima FROM b_{t}"
                )
    return _union(parts)


_LINES = f"""
SELECT i.invoice_id, i.customer_id, i.issued_at, i.status, i.currency, i.total, t.total_calculado_lineas,
       t.total_calculado_lineas IS NULL AS sin_lineas, {money('i.total - t.total_calculado_lineas')} AS diferencia,
       coalesce(abs(i.total - t.total_calculado_lineas) <= 0.01, false) AS total_coincide
FROM s_invoices i LEFT JOIN (SELECT invoice_id, {money('coalesce(sum(line_total), 0)')} AS total_calculado_lineas
                             FROM s_invoice_items GROUP BY invoice_id) t ON i.invoice_id = t.invoice_id"""
_SUMS = "SELECT enrollment_id, coalesce(sum(weight), 0) AS suma_pesos FROM s_grades WHERE enrollment_id IS NOT NULL GROUP BY enrollment_id"

# code, table, text, severity, source, key, violating condition
_RULES = [
    ("UNI-01", "grades", "score between 0 and 100", "ERROR", "s_grades", "grade_id", "NOT is_score_valid"),
    ("UNI-02", "grades", "0 < weight <= 1", "ERROR", "s_grades", "grade_id", "weight <= 0 OR weight > 1"),
    ("UNI-03", "enrollments", "student, course and semester occur together once", "WARNING", "s_enrollments",
     "enrollment_id", "is_repeated_combination"),
    ("UNI-04", "grades agrupado por enrollment_id", "weights of an enrollment add up to 1", "WARNING", f"({_SUMS})",
     "enrollment_id", "abs(suma_pesos - 1) > 0.01"),
    ("BIL-01", "invoice_items", "quantity > 0", "ERROR", "s_invoice_items", "invoice_item_id", "quantity <= 0"),
    ("BIL-02", "invoice_items", "unit_price >= 0", "ERROR", "s_invoice_items", "invoice_item_id", "unit_price < 0"),
    ("BIL-03", "invoice_items", "line_total = quantity x unit_price", "ERROR", "s_invoice_items", "invoice_item_id",
     "coalesce(abs(line_total - quantity * unit_price), 1) > 0.01"),
    ("BIL-04", "products", "monthly_price >= 0", "ERROR", "s_products", "product_id", "monthly_price < 0"),
    ("BIL-05", "payments", "amount > 0", "ERROR", "s_payments", "payment_id", "amount <= 0"),
    ("BIL-06", "invoices + invoice_items", "an invoice has at least one line", "WARNING", f"({_LINES})", "invoice_id",
     "sin_lineas"),
    ("BIL-07", "invoices + invoice_items", "total = sum of the lines", "WARNING", f"({_LINES})", "invoice_id",
     "NOT sin_lineas AND NOT total_coincide"),
    ("CRM-01", "accounts", "annual_revenue >= 0", "ERROR", "s_accounts", "account_id", "annual_revenue < 0"),
    ("CRM-02", "accounts", "employees >= 0", "ERROR", "s_accounts", "account_id", "employees < 0"),
    ("CRM-03", "leads", "score between 0 and 100", "ERROR", "s_leads", "lead_id", "NOT is_score_valid"),
    ("CRM-04", "opportunities", "amount >= 0", "ERROR", "s_opportunities", "opportunity_id", "amount < 0"),
]


def _business(review_only: bool = False, temporal: bool = False) -> str:
    rules = [(code, t, text, "ERROR", f"s_{t}", "", bad) for code, t, text, bad in _TEMPORAL] if temporal else []
    parts = [
        f"SELECT '{code}' AS codigo, '{t}' AS tabla, '{text}' AS descripcion, '{severity}' AS severidad,"
        f" count(*) AS registros_evaluados, count(*) FILTER (WHERE {bad}) AS registros_invalidos FROM {source}"
        for code, t, text, severity, source, _, bad in [*rules, *_RULES]
    ]
    share = pct("registros_invalidos", "registros_evaluados")
    return (
        f"SELECT *, coalesce({share}, CAST(0 AS DECIMAL(18,2))) AS porcentaje_invalido,"
        f" {_review('registros_invalidos = 0')} AS estado FROM (" + _union(parts) + ")"
        + (" WHERE registros_invalidos > 0" if review_only else "")
    )


_TEMPORAL = [
    ("SEM-01", "semesters", "start_date <= end_date", "start_date > end_date"),
    ("STU-01", "students", "birth_date < enrolled_at", "CAST(birth_date AS TIMESTAMP) >= enrolled_at"),
    ("SUB-01", "subscriptions", "start_date <= end_date", "start_date > end_date"),
    ("OPP-01", "opportunities", "created_at <= close_date", "created_at > CAST(close_date AS TIMESTAMP)"),
]


def _describe(source: str, column: str) -> str:
    """Sum, squares and count are exact; std is the sample deviation."""
    number = lambda sql: f"CAST(round({sql}, 4) AS DECIMAL(28,4))"
    spread = "(sum(v * v) - sum(v) * sum(v) / count(v)) / (count(v) - 1)"
    stats = {
        "count": number("count(v)"),
        "mean": ratio("sum(v) * 100", "count(v) * 100", 4),
        "std": number(f"sqrt({spread})"),
        "min": number("min(v)"),
        "25%": number("quantile_cont(CAST(v AS DOUBLE), 0.25)"),
        "50%": number("quantile_cont(CAST(v AS DOUBLE), 0.5)"),
        "75%": number("quantile_cont(CAST(v AS DOUBLE), 0.75)"),
        "max": number("max(v)"),
    }
    rows = [
        f"SELECT '{name}' AS estadistica, CAST({sql} AS DECIMAL(28,4)) AS valor"
        f" FROM (SELECT {column} AS v FROM {source} WHERE {column} IS NOT NULL)"
        for name, sql in stats.items()
    ]
    return _union(rows)


_AGES = "(SELECT CAST(round(date_diff('day', birth_date, CAST(enrolled_at AS DATE)) / 365.0, 1) AS DECIMAL(12,1)) AS edad FROM s_students)"

_DAY = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_FORMS = {
    "boolean": "lower(v) IN ('true', 'false')",
    "integer": "regexp_full_match(v, '[+-]?[0-9]{1,18}')",
    "decimal": "regexp_full_match(v, '[+-]?([0-9]{1,28}([.][0-9]{0,10})?|[.][0-9]{1,10})')",
    "date": f"regexp_full_match(v, '{_DAY}') AND TRY_CAST(v AS DATE) IS NOT NULL",
    "timestamp": f"regexp_full_match(v, '{_DAY}([ T][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}([.][0-9]{{1,6}})?)?)?')"
    " AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL",
}


def _inferred_types() -> str:
    counted = _union(
        [
            f"SELECT '{t}' AS tabla, '{c}' AS columna, count(v) AS valores, count(*) - count(v) AS sin_valor, "
            + ", ".join(f"count(*) FILTER (WHERE {form}) AS n_{kind}" for kind, form in _FORMS.items())
            + f" FROM (SELECT nullif(trim({c}), '') AS v FROM b_{t})"
            for t, columns in COLUMNS.items()
            for c, _ in columns
        ]
    )
    choose = lambda test: "CASE WHEN valores = 0 THEN 'string' " + " ".join(
        f"WHEN {test.format(f'n_{kind}')} THEN '{kind}'" for kind in _FORMS
    ) + " ELSE 'string' END"
    strict, likely = choose("{0} = valores"), choose("{0} * 100 >= valores * 90")
    fitting = "CASE tipo_probable " + " ".join(f"WHEN '{k}' THEN n_{k}" for k in _FORMS) + " ELSE valores END"
    return (
        f"SELECT tabla, columna, valores, sin_valor, tipo_estricto, tipo_probable, {fitting} AS conformes"
        f" FROM (SELECT *, {strict} AS tipo_estricto, {likely} AS tipo_probable FROM ({counted}))"
    )


_RENAMED = {("activities", "type"): "activity_type"}
_SUM_COLUMNS = ["enrollment_id", "suma_pesos"]
_LINE_COLUMNS = [
    "invoice_id", "customer_id", "issued_at", "status", "currency", "total", "total_calculado_lineas", "sin_lineas",
    "diferencia", "total_coincide",
]


def _violations() -> str:
    temporal = [(code, t, f"s_{t}", KEYS[t][0], bad) for code, t, _, bad in _TEMPORAL]
    parts = []
    for code, t, source, key, bad in [*temporal, *((c, t, s, k, b) for c, t, _, _, s, k, b in _RULES)]:
        if source.startswith("s_"):
            columns = [_RENAMED.get((t, c), c) for c, _ in COLUMNS[t]]
        else:
            columns = _SUM_COLUMNS if "suma_pesos" in source else _LINE_COLUMNS
        text = " || ', ' || ".join(f"'{c}=' || coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in columns)
        parts.append(
            f"SELECT * FROM (SELECT '{code}' AS codigo, row_number() OVER (ORDER BY clave NULLS LAST, fila) AS posicion, clave, fila"
            f" FROM (SELECT {key} AS clave, {text} AS fila FROM {source} WHERE {bad})) WHERE posicion <= 20"
        )
    return _union(parts)


def _lineage() -> str:
    return _union(
        [
            f"SELECT '{t}' AS tabla, '{t}.csv' AS archivo, 'star' AS lote, TIMESTAMP '2024-01-01 00:00:00' AS ingerido,"
            f" b.n AS filas_bronze, s.n AS filas_silver, {_review('b.n = s.n')} AS estado"
            f" FROM (SELECT count(*) AS n FROM b_{t}) b, (SELECT count(*) AS n FROM s_{t}) s"
            for t in KEYS
        ]
    )


REPORTS |= {
    "inferred_column_types": _inferred_types(),
    "rule_violations": _violations(),
    "bronze_lineage": _lineage(),
    "profile_tables": _union(
        [
            f"SELECT '{t}' AS tabla, count(*) AS filas, CAST({len(columns)} AS BIGINT) AS columnas,"
            f" {' + '.join(f'(count(*) - count({c}))' for c, _ in columns)} AS nulos_totales,"
            f" count(*) - (SELECT count(*) FROM (SELECT DISTINCT {_all(t)} FROM b_{t})) AS duplicados FROM b_{t}"
            for t, columns in COLUMNS.items()
        ]
    ),
    "profile_columns": _columns_profile(),
    "columns_with_nulls": f"SELECT * FROM ({_columns_profile()}) WHERE cantidad_nulos > 0",
    "profile_primary_keys": _keys_profile(),
    "profile_foreign_keys": _relations_profile(),
    "profile_logical_link": f"""
SELECT count(*) AS external_ref_no_nulos, count(*) FILTER (WHERE hit) AS coincidencias,
       count(*) FILTER (WHERE NOT hit) AS sin_coincidencia, count(*) - count(DISTINCT external_ref) AS duplicados,
       {pct('count(*) FILTER (WHERE hit)', 'count(*)')} AS porcentaje_coincidencia
FROM (SELECT external_ref, external_ref IN (SELECT student_id FROM b_students) AS hit FROM b_customers
      WHERE external_ref IS NOT NULL)""",
    "profile_categories": _union(
        [
            f"SELECT '{t}' AS tabla, '{c}' AS columna, (SELECT count(*) FROM b_{t}) AS cantidad_filas,"
            f" (SELECT count(DISTINCT {c}) FROM b_{t}) AS valores_unicos,"
            f" (SELECT count(*) - count({c}) FROM b_{t}) AS valores_nulos,"
            f" (SELECT string_agg({c}, ', ' ORDER BY {c}) FROM (SELECT DISTINCT {c} FROM b_{t} WHERE {c} IS NOT NULL"
            f" ORDER BY {c} LIMIT 10)) AS ejemplos"
            for t, c in _categories()
        ]
    ),
    "category_distribution": _union([_distribution(t, c) for t, c in _categories()]),
    "category_lookup": _distribution("invoices", "status"),
    "category_spelling_variants": f"SELECT *, valores_originales - valores_normalizados AS posibles_variantes,"
    f" {_review('valores_originales = valores_normalizados')} AS estado FROM ("
    + _union(
        [
            f"SELECT '{t}' AS tabla, '{c}' AS columna, count(DISTINCT {c}) AS valores_originales,"
            f" count(DISTINCT {_normal.format(c=c)}) AS valores_normalizados FROM b_{t}"
            for t, c in _categories()
        ]
    )
    + ")",
    "profile_dates": _dates(),
    "temporal_rules": f"SELECT *, {_review('registros_invalidos = 0')} AS estado FROM ("
    + _union(
        [
            f"SELECT '{code}' AS regla, '{t}' AS tabla, '{text}' AS descripcion,"
            f" count(*) FILTER (WHERE {bad}) AS registros_invalidos FROM s_{t}"
            for code, t, text, bad in _TEMPORAL
        ]
    )
    + ")",
    "age_at_enrollment": _describe(_AGES, "edad"),
    "type_report": _types(),
    "columns_to_convert": f"SELECT * FROM ({_types()}) WHERE requiere_conversion = 'SÍ'",
    "rule_registry": _business(temporal=True),
    "business_rules": _business(),
    "rules_to_review": _business(review_only=True),
    "rule_samples": _union(
        [
            f"SELECT * FROM (SELECT '{code}' AS codigo, {key} AS clave FROM {source} WHERE {bad} ORDER BY {key} LIMIT 20)"
            for code, _, _, _, source, key, bad in _RULES
        ]
    ),
    "invoice_line_reconciliation": _LINES,
    "country_distribution": "SELECT country, count(*) AS count FROM s_students GROUP BY country",
    "validation_summary": f"""
SELECT 'Conteo Bronze vs Silver' AS validacion,
       {_review('(SELECT count(*) FROM b_students) = (SELECT count(*) FROM s_students)')} AS resultado,
       (SELECT count(*) FROM s_students) AS cantidad
UNION ALL SELECT 'Student ID duplicados', {_review('n = 0')}, n FROM (SELECT {_groups('s_students', ('student_id',))} AS n)
UNION ALL SELECT 'Student ID nulos', {_review('n = 0')}, n FROM (SELECT count(*) FILTER (WHERE {_missing('students')}) AS n FROM s_students)""",
}

# ---- analysis


def _rows(source: str, label: str, value: str, entries: dict[str, str]) -> str:
    return _union([f"SELECT '{text}' AS {label}, {sql} AS {value} FROM {source}" for text, sql in entries.items()])


def _share(source: str, label: str, value: str, entries: dict[str, str]) -> str:
    body = _rows(source, label, value, entries)
    whole = f"(SELECT sum({value}) FROM parts)"
    return f"SELECT *, {pct(value, whole)} AS porcentaje FROM parts".replace("parts", f"({body})")


def _titles(pattern: str, *names: str) -> dict[str, str]:
    return {x: pattern.format(x.lower()) for x in names}


_SITUATION = """CASE WHEN failed_enrollments > 0 AND dropped_enrollments > 0 THEN 'Reprobación y abandono'
 WHEN failed_enrollments > 0 THEN 'Solo reprobación' WHEN dropped_enrollments > 0 THEN 'Solo abandono'
 ELSE 'Sin reprobación ni abandono' END"""
_mean4 = lambda c: ratio(f"sum({c})", f"count({c})", 4)
_COURSE = "course_code, course_name, professor_name, department, total_enrollments"

_EXECUTIVE = """total_students total_courses total_enrollments completed_enrollments active_enrollments
failed_enrollments dropped_enrollments enrollments_with_grades students_with_observed_average
average_student_observed_score enrollment_completion_rate_pct enrollment_failure_rate_pct
enrollment_dropout_rate_pct total_customers customers_with_invoices customers_without_invoices billing_currencies
total_invoices paid_invoices pending_invoices overdue_invoices total_payments invoices_without_items
invoices_not_matching_item_total overpaid_invoices exactly_paid_invoices underpaid_invoices
paid_status_but_underpaid paid_invoice_status_rate_pct paid_status_underpaid_rate_pct total_subscriptions
active_subscriptions paused_subscriptions cancelled_subscriptions temporally_invalid_subscriptions
active_subscriptions_on_inactive_products customers_without_subscriptions active_subscription_rate_pct
total_accounts total_contacts total_opportunities won_opportunities lost_opportunities open_opportunities
temporally_invalid_opportunities opportunity_contact_relationships same_account_relationships
different_account_relationships total_crm_opportunity_amount won_crm_amount open_pipeline_crm_amount
closed_opportunity_win_rate_pct lead_sources total_leads qualified_leads converted_leads lost_leads
leads_with_quality_issue lead_conversion_rate_pct total_activities assigned_activities
unassigned_activities""".split()


def _top_rate(count: str, rate: str) -> str:
    return (
        f"SELECT {_COURSE}, {count}, {rate}, average_weighted_observed_score FROM g_course_performance_dashboard"
        f" WHERE total_enrollments >= 50 ORDER BY {rate} DESC NULLS LAST, course_code LIMIT 10"
    )


def _academics(flag: str, label: str, yes: str, no: str) -> str:
    return f"""
SELECT CASE WHEN {flag} THEN '{yes}' ELSE '{no}' END AS {label}, count(*) AS estudiantes,
       {_mean4('completed_enrollments')} AS promedio_inscripciones_completadas,
       {_mean4('failed_enrollments')} AS promedio_inscripciones_reprobadas,
       {_mean4('dropped_enrollments')} AS promedio_inscripciones_abandonadas,
       {avg2('average_weighted_observed_score', 4)} AS promedio_academico_observado
FROM g_student_customer_360 WHERE {flag} IS NOT NULL GROUP BY 1"""


REPORTS |= {
    "kpis_vertical": _rows("g_executive_kpis", "indicador", "valor", {c: f"CAST({c} AS VARCHAR)" for c in _EXECUTIVE}),
    "executive_volumes": _union(
        [
            f"SELECT '{d}' AS dominio, '{label}' AS indicador, {c} AS valor FROM g_executive_kpis"
            for d, label, c in (
                ("University", "Estudiantes", "total_students"), ("University", "Cursos", "total_courses"),
                ("University", "Inscripciones", "total_enrollments"), ("Billing", "Clientes", "total_customers"),
                ("Billing", "Facturas", "total_invoices"), ("Billing", "Suscripciones", "total_subscriptions"),
                ("CRM", "Cuentas", "total_accounts"), ("CRM", "Oportunidades", "total_opportunities"),
                ("CRM", "Leads", "total_leads"),
            )
        ]
    ),
    "executive_rates": _rows(
        "g_executive_kpis", "indicador", "tasa_pct",
        {
            "Inscripciones completadas": "enrollment_completion_rate_pct",
            "Inscripciones reprobadas": "enrollment_failure_rate_pct",
            "Inscripciones abandonadas": "enrollment_dropout_rate_pct",
            "Facturas con estado paid": "paid_invoice_status_rate_pct",
            "Facturas paid subpagadas": "paid_status_underpaid_rate_pct",
            "Suscripciones activas": "active_subscription_rate_pct",
            "Oportunidades cerradas ganadas": "closed_opportunity_win_rate_pct",
            "Leads convertidos": "lead_conversion_rate_pct",
        },
    ),
    "enrollment_status_share": _share(
        "k_academic", "estado", "inscripciones", _titles("{}_enrollments", "Completed", "Active", "Failed", "Dropped")
    ),
    "top_courses_volume": f"SELECT {_COURSE}, completed_enrollments, failed_enrollments, dropped_enrollments"
    " FROM g_course_performance_dashboard ORDER BY total_enrollments DESC, course_code LIMIT 10",
    "top_courses_failure": _top_rate("failed_enrollments", "failure_rate_pct"),
    "top_courses_dropout": _top_rate("dropped_enrollments", "dropout_rate_pct"),
    "student_situation": f"""
SELECT situacion_academica, count(*) AS estudiantes,
       {pct('count(*)', '(SELECT count(*) FROM g_student_academic_summary)')} AS porcentaje
FROM (SELECT {_SITUATION} AS situacion_academica FROM g_student_academic_summary) GROUP BY situacion_academica""",
    "observed_score_distribution": _describe("g_student_academic_summary", "average_weighted_observed_score"),
    "observed_score_histogram": """
SELECT b.bin, CAST(CAST(low * 20 + (high - low) * b.bin AS DECIMAL(18,4)) / 2000 AS DECIMAL(18,4)) AS desde,
       CAST(CAST(low * 20 + (high - low) * (b.bin + 1) AS DECIMAL(18,4)) / 2000 AS DECIMAL(18,4)) AS hasta,
       (SELECT count(*) FROM (SELECT CAST(average_weighted_observed_score * 100 AS BIGINT) AS v
                              FROM g_student_academic_summary WHERE average_weighted_observed_score IS NOT NULL)
        WHERE CASE WHEN high = low THEN 0 ELSE least(19, (v - low) * 20 // (high - low)) END = b.bin) AS cantidad
FROM (SELECT min(CAST(average_weighted_observed_score * 100 AS BIGINT)) AS low,
             max(CAST(average_weighted_observed_score * 100 AS BIGINT)) AS high FROM g_student_academic_summary),
     (SELECT unnest(range(0, 20)) AS bin) b WHERE low IS NOT NULL""",
    "invoice_status_share": _share("k_billing", "estado", "facturas", _titles("{}_invoices", "Paid", "Pending", "Overdue")),
    "payment_reconciliation_share": _share(
        "k_billing", "clasificacion", "facturas",
        {"Sobrepagadas": "overpaid_invoices", "Pagadas exactamente": "exactly_paid_invoices",
         "Subpagadas": "underpaid_invoices"},
    ),
    "paid_but_underpaid": f"SELECT paid_invoices AS facturas_paid, paid_status_but_underpaid AS paid_subpagadas,"
    f" {pct('paid_status_but_underpaid', 'paid_invoices')} AS tasa_pct FROM k_billing",
    "currency_coverage": f"""
SELECT currency, customers, total_invoices, total_payments, total_invoiced, total_paid, outstanding_amount,
       overpaid_amount, paid_invoice_rate_pct, overdue_invoice_rate_pct, overpaid_invoice_rate_pct,
       underpaid_invoice_rate_pct, invoice_item_mismatch_rate_pct,
       {pct(cents('total_paid'), cents('total_invoiced'))} AS payment_coverage_pct FROM g_billing_currency_kpis""",
    "invoice_item_quality": _rows(
        "k_billing", "clasificacion", "facturas",
        {"Sin items": "invoices_without_items", "Items coinciden": "invoices_matching_item_total",
         "Items no coinciden": "invoices_not_matching_item_total"},
    ),
    "subscription_kpis": """
SELECT total_subscriptions, active_subscriptions, paused_subscriptions, cancelled_subscriptions,
       temporally_invalid_subscriptions, active_subscriptions_to_inactive_products, customers_without_subscriptions
FROM k_subscriptions""",
    "subscription_status_share": _share(
        "k_subscriptions", "estado", "suscripciones", _titles("{}_subscriptions", "Active", "Paused", "Cancelled")
    ),
    "subscription_issues": _rows(
        "k_subscriptions", "situacion", "suscripciones",
        {"Fechas inconsistentes": "temporally_invalid_subscriptions",
         "Activas en productos inactivos": "active_subscriptions_to_inactive_products"},
    ),
    "opportunity_stage_share": _share(
        "k_crm", "etapa", "oportunidades",
        _titles("{}_opportunities", "Prospect", "Qualification", "Proposal", "Negotiation", "Won", "Lost"),
    ),
    "opportunity_state_share": _share(
        "k_crm", "clasificacion", "oportunidades",
        {"Abiertas": "open_opportunities", "Ganadas": "won_opportunities", "Perdidas": "lost_opportunities"},
    ),
    "win_rate": f"""
SELECT won_opportunities + lost_opportunities AS oportunidades_cerradas, won_opportunities AS oportunidades_ganadas,
       {pct('won_opportunities', 'won_opportunities + lost_opportunities')} AS tasa_ganancia_pct FROM k_crm""",
    "crm_amounts": _rows(
        "k_crm", "clasificacion", "monto_crm",
        {"Pipeline abierto": "open_pipeline_crm_amount", "Ganado": "won_crm_amount", "Perdido": "lost_crm_amount"},
    ),
    "top_open_pipeline": """
SELECT account_id, account_name, industry, country, open_opportunities, open_pipeline_crm_amount, total_activities
FROM g_crm_account_dashboard ORDER BY open_pipeline_crm_amount DESC, account_id LIMIT 10""",
    "opportunity_temporal_quality": _share(
        "k_crm", "clasificacion", "oportunidades",
        {"Fechas válidas": "total_opportunities - temporally_invalid_opportunities",
         "Fechas inconsistentes": "temporally_invalid_opportunities"},
    ),
    "opportunity_contact_share": _share(
        "k_crm", "clasificacion", "relaciones",
        {"Misma cuenta": "same_account_relationships", "Cuenta diferente": "different_account_relationships"},
    ),
    "activity_type_counts": _rows(
        "k_crm", "tipo", "actividades", _titles("{}_activities", "Call", "Demo", "Email", "Meeting", "Note")
    ),
    "activity_assignment_share": _share(
        "(SELECT * FROM k_crm, k_activities)", "clasificacion", "actividades",
        {"Asignadas a una cuenta": "assigned_activities", "Sin referencia": "unassigned_activities"},
    ),
    "lead_status_share": _share(
        "k_leads", "estado", "leads", _titles("{}_leads", "New", "Contacted", "Qualified", "Converted", "Lost")
    ),
    "lead_source_conversion": """
SELECT source, total_leads, converted_leads, qualified_leads, average_lead_score, conversion_rate_pct,
       qualified_or_converted_rate_pct FROM g_lead_source_dashboard""",
    "lead_score_conversion": "SELECT source, average_lead_score, conversion_rate_pct FROM g_lead_source_dashboard",
    "integration_validation": _rows(
        "g_student_customer_360", "indicador", "valor",
        {
            "Total de estudiantes": "count(*)",
            "Estudiantes vinculados a clientes": "count(customer_id)",
            "Estudiantes sin cliente": "count(*) - count(customer_id)",
            "Estudiantes con facturas": "count(*) FILTER (WHERE has_invoices)",
            "Estudiantes con suscripción activa": "count(*) FILTER (WHERE has_active_subscription)",
        },
    ),
    "customer_population": f"""
SELECT CASE WHEN is_student_linked THEN 'Vinculado a estudiante' ELSE 'No vinculado a estudiante' END AS customer_type,
       count(*) AS customers, count(*) FILTER (WHERE total_subscriptions > 0) AS customers_with_subscriptions,
       count(*) FILTER (WHERE active_subscriptions > 0) AS customers_with_active_subscription,
       {ratio('sum(total_subscriptions)', 'count(*)')} AS average_subscriptions,
       {ratio('sum(active_subscriptions)', 'count(*)')} AS average_active_subscriptions,
       {pct('count(*) FILTER (WHERE total_subscriptions > 0)', 'count(*)')} AS subscription_customer_rate_pct,
       {pct('count(*) FILTER (WHERE active_subscriptions > 0)', 'count(*)')} AS active_subscription_customer_rate_pct
FROM g_customer_subscription_summary GROUP BY 1""",
    "student_360_by_situation": f"""
SELECT {_SITUATION} AS situacion_academica, count(*) AS estudiantes,
       count(*) FILTER (WHERE has_invoices) AS estudiantes_con_facturas,
       count(*) FILTER (WHERE has_active_subscription) AS estudiantes_con_suscripcion_activa,
       count(*) FILTER (WHERE has_billing_reconciliation_issue) AS estudiantes_con_incidencia_billing,
       {_mean4('total_invoices')} AS promedio_facturas,
       {_mean4('active_subscriptions')} AS promedio_suscripciones_activas,
       {avg2('average_weighted_observed_score', 4)} AS promedio_academico_observado,
       {pct('count(*) FILTER (WHERE has_invoices)', 'count(*)')} AS tasa_con_facturas_pct,
       {pct('count(*) FILTER (WHERE has_active_subscription)', 'count(*)')} AS tasa_suscripcion_activa_pct,
       {pct('count(*) FILTER (WHERE has_billing_reconciliation_issue)', 'count(*)')} AS tasa_incidencia_billing_pct
FROM g_student_customer_360 GROUP BY 1""",
    "academic_billing_detail": f"""
SELECT {_SITUATION} AS situacion_academica, count(*) AS estudiantes, {big('sum(total_invoices)')} AS total_invoices,
       {big('sum(overpaid_invoices)')} AS overpaid_invoices, {big('sum(underpaid_invoices)')} AS underpaid_invoices,
       {big('sum(paid_status_but_underpaid)')} AS paid_status_underpaid,
       {pct('sum(overpaid_invoices)', 'sum(total_invoices)')} AS overpaid_invoice_rate_pct,
       {pct('sum(underpaid_invoices)', 'sum(total_invoices)')} AS underpaid_invoice_rate_pct,
       {pct('sum(paid_status_but_underpaid)', 'sum(total_invoices)')} AS paid_status_underpaid_rate_pct
FROM g_student_customer_360 GROUP BY 1""",
    "academics_by_subscription": _academics(
        "has_active_subscription", "suscripcion_activa", "Con suscripción activa", "Sin suscripción activa"
    ),
    "academics_by_billing_issue": _academics(
        "has_billing_reconciliation_issue", "situacion_billing", "Con incidencia de Billing", "Sin incidencia de Billing"
    ),
}
