"""Discovery over bronze: tables, columns, keys, categories, dates, types and business rules.

Most reports need one aggregate over a table's value counts, or one wide aggregate that is stacked into rows;
relations read both of their tables. Output names and states are
fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.catalogue import CATEGORICAL, RELATIONS, TABLES, columns_of_kind
from tierline.functions.cleanse import converted, sql_type
from tierline.functions.exact import MONEY, half_up, percent
from tierline.functions.kinds import KINDS, narrowest
from tierline.operators.links import attach_group, duplicate_groups, orphan_rows
from tierline.operators.measures import add, aggregate, count_of, n, named, same, side_by_side, union
from tierline.operators.values import describe, first_values, first_violations, table_profile, type_counts, value_counts
from tierline.plans.rules import null_key

OK, REVIEW = "OK", "REVISAR"
NULL_LABEL = "VALOR_NULO"
ZERO_PCT = "cast(0 AS decimal(18,2))"


def _state(fine: str) -> dict[str, str]:
    return {"estado": f"if({fine}, '{OK}', '{REVIEW}')"}


def _raw(layers, table: str) -> DataFrame:
    return layers.bronze(table).select(*TABLES[table].columns)


def _tagged(table: str, df: DataFrame) -> DataFrame:
    return df.selectExpr(f"'{table}' AS tabla", "*")


# ---- tables and columns


def profile_tables(layers) -> DataFrame:
    parts = []
    for table, spec in TABLES.items():
        profile = table_profile(_raw(layers, table))
        parts.append(_tagged(table, add(profile, {"columnas": f"{len(spec.columns)}L"})))
    return union(parts)


_NULLS = count_of("n", "valor IS NULL")


def _counted_together(table: str) -> list[list[str]]:
    """The columns of a table in groups: each key and each reference alone, the others together."""
    spec = TABLES[table]
    alone = {*spec.key, *[column for child, column, _, _ in RELATIONS if child == table]}
    groups = [[c] for c in spec.columns if c in alone]
    others = [c for c in spec.columns if c not in alone]
    return [*groups, others] if others else groups


def profile_columns(layers) -> DataFrame:
    """Keys and references have almost as many values as the table has rows: counted together with the other columns, they
    fill a task's memory, and the values of all columns are sorted on disk."""
    measures = {
        "tipo_actual": "'string'",
        "cantidad_nulos": _NULLS,
        "porcentaje_nulos": percent(_NULLS, "sum(n)"),
        "valores_unicos": "count(valor)",
    }
    parts = []
    for table in TABLES:
        for columns in _counted_together(table):
            counts = value_counts(_raw(layers, table), columns)
            parts.append(_tagged(table, aggregate(counts, same("columna"), measures)))
    return union(parts)


def columns_with_nulls(layers) -> DataFrame:
    found = profile_columns(layers).filter("cantidad_nulos > 0")
    return found.orderBy(F.desc("porcentaje_nulos"), "tabla", "columna")


# ---- keys and relations


def profile_primary_keys(layers) -> DataFrame:
    parts = []
    for table, spec in TABLES.items():
        groups = aggregate(_raw(layers, table), same(*spec.key), {"n": "count(*)"})
        measures = {
            "llave_primaria": f"'{' + '.join(spec.key)}'",
            "cantidad_filas": "coalesce(sum(n), 0)",
            "pk_unicas": "count(*)",
            "pk_nulas": count_of("n", " OR ".join(f"{k} IS NULL" for k in spec.key)),
            "filas_con_pk_duplicada": count_of("n", "n > 1"),
        }
        parts.append(_tagged(table, aggregate(groups, {}, measures)))
    return add(union(parts), _state("pk_nulas = 0 AND filas_con_pk_duplicada = 0"))


def profile_foreign_keys(layers) -> DataFrame:
    parts = []
    for child, column, parent, nullable in RELATIONS:
        pk = TABLES[parent].key[0]
        counted = orphan_rows(_raw(layers, child), column, _raw(layers, parent), pk)
        columns = {
            "tabla_hija": f"'{child}'",
            "columna_fk": f"'{column}'",
            "tabla_padre": f"'{parent}'",
            "columna_pk": f"'{pk}'",
            "permite_nulos": str(nullable).lower(),
            "cantidad_filas": "row_count",
            "valores_nulos": "null_values",
            "valores_huerfanos": "orphan_values",
        }
        parts.append(counted.selectExpr(*named(columns)))
    share = percent("valores_huerfanos", "cantidad_filas - valores_nulos")
    return add(
        union(parts),
        {
            "porcentaje_huerfanos": f"coalesce({share}, {ZERO_PCT})",
            **_state("valores_huerfanos = 0 AND (valores_nulos = 0 OR permite_nulos)"),
        },
    )


def profile_logical_link(layers) -> DataFrame:
    """external_ref against student_id: matches, misses and repeats among the non-null references."""
    refs = _raw(layers, "customers").filter("external_ref IS NOT NULL")
    counted = aggregate(refs, same("external_ref"), {"n": "count(*)"})
    students = _raw(layers, "students").select("student_id").filter("student_id IS NOT NULL").distinct()
    totals = aggregate(
        counted.join(students, F.expr("external_ref = student_id"), "left"),
        {},
        {
            "external_ref_no_nulos": "coalesce(sum(n), 0)",
            "coincidencias": count_of("n", "student_id IS NOT NULL"),
            "sin_coincidencia": count_of("n", "student_id IS NULL"),
            "duplicados": "coalesce(sum(n - 1), 0)",
        },
    )
    return add(totals, {"porcentaje_coincidencia": percent("coincidencias", "external_ref_no_nulos")})


# ---- categories


def _category_counts(layers, table: str) -> DataFrame:
    return value_counts(_raw(layers, table), list(CATEGORICAL[table]))


def profile_categories(layers) -> DataFrame:
    measures = {"cantidad_filas": "sum(n)", "valores_unicos": "count(valor)", "valores_nulos": _NULLS}
    parts = []
    for table in CATEGORICAL:
        counts = _category_counts(layers, table)
        sized = aggregate(counts, same("columna"), measures).join(first_values(counts), "columna", "left")
        parts.append(
            _tagged(table, sized.selectExpr("columna", *measures, "coalesce(ejemplos, '') AS ejemplos"))
        )
    return union(parts)


def _distribution(layers, table: str, columns: list[str]) -> DataFrame:
    """NULL joins the rows that already carry its label, as filling them in would."""
    labelled = {"columna": "columna", "valor": f"coalesce(valor, '{NULL_LABEL}')"}
    merged = aggregate(value_counts(_raw(layers, table), columns), labelled, {"cantidad": "sum(n)"})
    # Values of a column are few, and any column's counts add up to the rows.
    sized = add(merged, {"_filas": "sum(cantidad) OVER (PARTITION BY columna)"})
    return _tagged(table, add(sized, {"porcentaje": percent("cantidad", "_filas")}).drop("_filas"))


def category_distribution(layers) -> DataFrame:
    return union([_distribution(layers, table, list(columns)) for table, columns in CATEGORICAL.items()])


def distribution_of(layers, table: str, column: str) -> DataFrame:
    """The distribution of one categorical column, most frequent value first."""
    return _distribution(layers, table, [column]).orderBy(F.desc("cantidad"), "valor")


def category_spelling_variants(layers) -> DataFrame:
    normal = {"columna": "columna", "normal": r"lower(regexp_replace(valor, r'(?U)^\s+|\s+$', ''))"}
    parts = []
    for table in CATEGORICAL:
        merged = aggregate(_category_counts(layers, table), normal, {"originals": "count(valor)"})
        measures = {"valores_originales": "sum(originals)", "valores_normalizados": "count(normal)"}
        parts.append(_tagged(table, aggregate(merged, same("columna"), measures)))
    return add(
        union(parts),
        {
            "posibles_variantes": "valores_originales - valores_normalizados",
            **_state("valores_originales = valores_normalizados"),
        },
    )


def country_distribution(layers) -> DataFrame:
    return aggregate(layers.reference("students", "country"), same("country"), {"count": "count(*)"}).orderBy("country")


# ---- dates and types


def _stacked(df: DataFrame, measures: dict[str, list[str]], names: list[str]) -> DataFrame:
    """One aggregate over `df`, turned into one row per column: {column: [aggregate SQL, ...]}."""
    wide = aggregate(df, {}, {f"{c}__{i}": sql for c, sqls in measures.items() for i, sql in enumerate(sqls)})
    entries = [", ".join([f"'{c}'", *[f"`{c}__{i}`" for i in range(len(sqls))]]) for c, sqls in measures.items()]
    return wide.selectExpr(f"stack({len(measures)}, {', '.join(entries)}) AS (columna, {', '.join(names)})")


def profile_dates(layers) -> DataFrame:
    names = ["cantidad_filas", "valores_nulos", "fechas_validas", "fechas_invalidas", "fecha_minima", "fecha_maxima"]
    by_table: dict[str, dict[str, list[str]]] = {}
    for table, c in columns_of_kind("date", "timestamp"):
        moment = converted(c, "timestamp_ntz")
        by_table.setdefault(table, {})[c] = [
            "count(*)", f"count_if({c} IS NULL)", f"count({moment})", f"count({c}) - count({moment})",
            f"min({moment})", f"max({moment})",
        ]
    return union([_tagged(t, _stacked(_raw(layers, t), measures, names)) for t, measures in by_table.items()])


# Columns expected as points in time although silver keeps only their day.
_EXPECTED_TIMESTAMP = {
    ("enrollments", "enrolled_at"), ("grades", "graded_at"), ("invoices", "issued_at"), ("invoices", "due_at"),
    ("payments", "paid_at"),
}
# SQL name of each logical type.
_SQL_NAME = {
    "string": "VARCHAR", "integer": "INTEGER", "decimal": "NUMERIC", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def _logical(table: str, column: str, kind: str) -> str:
    if (table, column) in _EXPECTED_TIMESTAMP:
        return "timestamp"
    if kind.startswith("decimal"):
        return "decimal"
    return kind if kind in _SQL_NAME else "string"


def type_report(layers) -> DataFrame:
    """Expected type per column and how many non-null values convert to it."""
    names = ["tipo_esperado_silver", "tipo_sql_silver", "valores", "convertibles", "no_convertibles",
             "requiere_conversion"]
    parts = []
    for table, spec in TABLES.items():
        measures = {}
        for c, kind in spec.columns.items():
            logical = _logical(table, c, kind)
            target = sql_type("timestamp" if logical == "timestamp" else kind)
            good = f"count(`{c}`)" if target == "string" else f"count({converted(c, target)})"
            measures[c] = [
                f"'{logical}'", f"'{_SQL_NAME[logical]}'", f"count(`{c}`)", good, f"count(`{c}`) - {good}",
                "'NO'" if logical == "string" else "'SÍ'",
            ]
        parts.append(_tagged(table, _stacked(_raw(layers, table), measures, names)))
    return union(parts)


def columns_to_convert(layers) -> DataFrame:
    return type_report(layers).filter("requiere_conversion = 'SÍ'")


# ---- rules over the typed values


@dataclass(frozen=True)
class Rule:
    """A business rule: `invalid` is the SQL condition of a violating row of `source`."""

    code: str
    table: str
    text: str
    source: str
    key: str
    invalid: str
    columns: tuple[str, ...] = ()
    severity: str = "ERROR"
    counted: str = ""  # source of already counted rows, column _n, to evaluate the rule on


def _rule(code: str, table: str, text: str, invalid: str, *columns: str) -> Rule:
    key = TABLES[table].key[0]
    return Rule(code, table, text, table, key, invalid, (key, *columns))


def _warning(code: str, table: str, text: str, source: str, key: str, invalid: str, counted: str = "") -> Rule:
    return Rule(code, table, text, source, key, invalid, severity="WARNING", counted=counted)


_TEMPORAL = (
    _rule("SEM-01", "semesters", "start_date <= end_date", "start_date > end_date", "start_date", "end_date"),
    _rule("STU-01", "students", "birth_date < enrolled_at", "cast(birth_date AS timestamp_ntz) >= enrolled_at",
          "birth_date", "enrolled_at"),
    _rule("SUB-01", "subscriptions", "start_date <= end_date", "start_date > end_date", "start_date", "end_date"),
    _rule("OPP-01", "opportunities", "created_at <= close_date", "created_at > cast(close_date AS timestamp_ntz)",
          "created_at", "close_date"),
)

_NO_SCORE = "score IS NULL OR score NOT BETWEEN 0 AND 100"
_BUSINESS = (
    _rule("UNI-01", "grades", "score between 0 and 100", _NO_SCORE, "score"),
    _rule("UNI-02", "grades", "0 < weight <= 1", "weight <= 0 OR weight > 1", "weight"),
    _warning("UNI-03", "enrollments", "student, course and semester occur together once", "_grouped_enrollments",
             "enrollment_id", "_n > 1", "_enrollment_groups"),
    _warning("UNI-04", "grades agrupado por enrollment_id", "weights of an enrollment add up to 1", "_weight_sums",
             "enrollment_id", "abs(suma_pesos - 1) > 0.01"),
    _rule("BIL-01", "invoice_items", "quantity > 0", "quantity <= 0", "quantity"),
    _rule("BIL-02", "invoice_items", "unit_price >= 0", "unit_price < 0", "unit_price"),
    _rule("BIL-03", "invoice_items", "line_total = quantity x unit_price",
          "NOT coalesce(abs(line_total - quantity * unit_price) <= 0.01, false)",
          "quantity", "unit_price", "line_total"),
    _rule("BIL-04", "products", "monthly_price >= 0", "monthly_price < 0", "monthly_price"),
    _rule("BIL-05", "payments", "amount > 0", "amount <= 0", "amount"),
    _warning("BIL-06", "invoices + invoice_items", "an invoice has at least one line", "_reconciliation",
             "invoice_id", "sin_lineas"),
    _warning("BIL-07", "invoices + invoice_items", "total = sum of the lines", "_reconciliation", "invoice_id",
             "NOT sin_lineas AND NOT total_coincide"),
    _rule("CRM-01", "accounts", "annual_revenue >= 0", "annual_revenue < 0", "annual_revenue"),
    _rule("CRM-02", "accounts", "employees >= 0", "employees < 0", "employees"),
    _rule("CRM-03", "leads", "score between 0 and 100", _NO_SCORE, "score"),
    _rule("CRM-04", "opportunities", "amount >= 0", "amount < 0", "amount"),
)


def invoice_line_reconciliation(layers) -> DataFrame:
    """Per invoice: the sum of its lines and whether it matches the total within 0.01."""
    summed = aggregate(
        layers.reference("invoice_items", "invoice_id", "line_total"),
        {"_lines": "invoice_id"},
        {"total_calculado_lineas": f"cast(coalesce(sum(line_total), 0) AS {MONEY})"},
    )
    invoices = layers.reference("invoices", "invoice_id", "customer_id", "issued_at", "status", "currency", "total")
    difference = "total - total_calculado_lineas"
    return add(
        invoices.join(summed, F.expr("invoice_id = _lines"), "left").drop("_lines"),
        {
            "sin_lineas": "total_calculado_lineas IS NULL",
            "diferencia": f"cast({difference} AS {MONEY})",
            "total_coincide": f"coalesce(abs({difference}) <= 0.01, false)",
        },
    )


def _weight_sums(layers) -> DataFrame:
    weights = layers.reference("grades", "enrollment_id", "weight").filter("enrollment_id IS NOT NULL")
    return aggregate(weights, same("enrollment_id"), {"suma_pesos": "coalesce(sum(weight), 0)"})


_COMBINATION = ["student_id", "course_id", "semester_id"]


def _grouped_enrollments(layers) -> DataFrame:
    """Enrollments with the size of their (student, course, semester) group."""
    enrollments = layers.reference("enrollments", "enrollment_id", *_COMBINATION)
    return attach_group(enrollments, _COMBINATION, "enrollment_id", {"_n": "count(*)"})


def _enrollment_groups(layers) -> DataFrame:
    return aggregate(layers.reference("enrollments", *_COMBINATION), same(*_COMBINATION), {"_n": "count(*)"})


_DERIVED = {
    "_reconciliation": invoice_line_reconciliation,
    "_weight_sums": _weight_sums,
    "_grouped_enrollments": _grouped_enrollments,
    "_enrollment_groups": _enrollment_groups,
}


def _source(layers, name: str, rules: list[Rule]) -> DataFrame:
    if name in _DERIVED:
        return _DERIVED[name](layers)
    return layers.reference(name, *dict.fromkeys(c for r in rules for c in r.columns))


def _registry(layers, rules: tuple[Rule, ...]) -> DataFrame:
    """Rules on the same source are counted in one pass over it."""
    by_source: dict[str, list[Rule]] = {}
    for rule in rules:
        by_source.setdefault(rule.counted or rule.source, []).append(rule)
    parts = []
    for source, members in by_source.items():
        if members[0].counted:
            measures = {"_rows": "coalesce(sum(_n), 0)", **{r.code: count_of("_n", r.invalid) for r in members}}
        else:
            measures = {"_rows": "count(*)", **{r.code: n(r.invalid) for r in members}}
        entries = ", ".join(
            f"'{r.code}', '{r.table}', '{r.text}', '{r.severity}', _rows, `{r.code}`" for r in members
        )
        parts.append(
            aggregate(_source(layers, source, members), {}, measures).selectExpr(
                f"stack({len(members)}, {entries}) AS "
                "(codigo, tabla, descripcion, severidad, registros_evaluados, registros_invalidos)"
            )
        )
    share = percent("registros_invalidos", "registros_evaluados")
    return add(
        union(parts),
        {"porcentaje_invalido": f"coalesce({share}, {ZERO_PCT})", **_state("registros_invalidos = 0")},
    )


def temporal_rules(layers) -> DataFrame:
    return _registry(layers, _TEMPORAL).selectExpr(
        "codigo AS regla", "tabla", "descripcion", "registros_invalidos", "estado"
    )


def rule_registry(layers) -> DataFrame:
    """Every rule with rows evaluated, rows violating it, their share, severity and state."""
    return _registry(layers, (*_TEMPORAL, *_BUSINESS))


def business_rules(layers) -> DataFrame:
    return _registry(layers, _BUSINESS)


def rules_to_review(layers) -> DataFrame:
    return business_rules(layers).filter(f"estado = '{REVIEW}'")


def rule_examples(layers, code: str, k: int = 20) -> DataFrame:
    """The first k violating rows of one rule, in key order."""
    rule = next(r for r in (*_TEMPORAL, *_BUSINESS) if r.code == code)
    return _source(layers, rule.source, [rule]).filter(rule.invalid).orderBy(rule.key).limit(k)


def rule_samples(layers, k: int = 20) -> DataFrame:
    """(codigo, clave): keys of the first k violating rows of every business rule."""
    return union(
        [
            rule_examples(layers, r.code, k).selectExpr(f"'{r.code}' AS codigo", f"{r.key} AS clave")
            for r in _BUSINESS
        ]
    )


def plain_columns(table: str) -> list[str]:
    """Silver columns of a table that come straight from a bronze column."""
    spec = TABLES[table]
    return [spec.rename.get(c, c) for c in spec.columns]


def rule_violations(layers, k: int = 20) -> DataFrame:
    """(codigo, posicion, clave, fila): the first k violating rows of every temporal and business rule, whole rows as text.

    Rules on the same source are searched for in one pass over it. Rows of equal key are told apart by their text.
    """
    by_source: dict[str, list[Rule]] = {}
    for rule in (*_TEMPORAL, *_BUSINESS):
        by_source.setdefault(rule.source, []).append(rule)
    parts = []
    for source, members in by_source.items():
        if source == "_grouped_enrollments":
            columns = plain_columns("enrollments")
            rows = attach_group(layers.reference("enrollments", *columns), _COMBINATION, "enrollment_id", {"_n": "count(*)"})
        elif source in _DERIVED:
            rows = _DERIVED[source](layers)
            columns = rows.columns
        else:
            columns = plain_columns(source)
            rows = layers.reference(source, *columns)
        parts.append(first_violations(rows, {r.code: r.invalid for r in members}, members[0].key, columns, k))
    return union(parts)


def inferred_column_types(layers, share: int = 90) -> DataFrame:
    """(tabla, columna, valores, sin_valor, tipo_estricto, tipo_probable, conformes), from the values themselves.

    tipo_estricto is the narrowest type that accepts all values of the column, tipo_probable the narrowest that accepts
    `share` percent of them, conformes how many that are. Types widen from integer to decimal and from date to
    timestamp; what else is mixed, and a column without values, is a string.
    """
    accepted = {kind: count_of("n", f"bits & {1 << i} <> 0") for i, kind in enumerate(KINDS)}
    parts = []
    for table, spec in TABLES.items():
        counts = type_counts(_raw(layers, table), list(spec.columns))
        measures = {"valores": count_of("n", "bits IS NOT NULL"), "sin_valor": count_of("n", "bits IS NULL"), **accepted}
        parts.append(_tagged(table, aggregate(counts, same("columna"), measures)))
    found = add(
        union(parts),
        {
            "tipo_estricto": narrowest({k: k for k in KINDS}, "valores > 0 AND {0} = valores"),
            "tipo_probable": narrowest({k: k for k in KINDS}, f"valores > 0 AND {{0}} * 100 >= valores * {share}"),
        },
    )
    fitting = "CASE tipo_probable " + " ".join(f"WHEN '{k}' THEN `{k}`" for k in KINDS) + " ELSE valores END"
    return found.selectExpr("tabla", "columna", "valores", "sin_valor", "tipo_estricto", "tipo_probable", f"{fitting} AS conformes")


def student_ages(layers) -> DataFrame:
    """(student_id, edad): years of 365 days between birth and enrollment, at one decimal."""
    days = "datediff(cast(enrolled_at AS date), birth_date)"
    students = layers.reference("students", "student_id", "birth_date", "enrolled_at")
    return students.selectExpr("student_id", f"{half_up(days, '365', 1)} AS edad")


def age_at_enrollment(layers) -> DataFrame:
    return describe(student_ages(layers), "edad", 1)


def validation_summary(layers) -> DataFrame:
    """Row conservation, repeated ids and missing ids of the students table as three rows."""
    silver = layers.silver("students")
    counts = aggregate(silver, {}, {"silver": "count(*)", "missing": n(null_key("students"))})
    before = aggregate(_raw(layers, "students"), {}, {"bronze": "count(*)"})
    rows = side_by_side([counts, before, duplicate_groups(silver, ["student_id"])]).selectExpr(
        "stack(3, 'Conteo Bronze vs Silver', bronze = silver, silver,"
        " 'Student ID duplicados', duplicate_groups = 0, duplicate_groups,"
        " 'Student ID nulos', missing = 0, missing) AS (validacion, fine, cantidad)"
    )
    return rows.selectExpr("validacion", f"{_state('fine')['estado']} AS resultado", "cantidad")
