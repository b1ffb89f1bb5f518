from __future__ import annotations

from collections import Counter

import pytest
from compare import compare, connect
from conftest import SMALL
from fixture_rows import ROWS, bronze_loader

import __spark_entry__ as contract
from tierline.functions.kinds import KINDS, narrowest
from tierline.operators.measures import aggregate, count_of
from tierline.operators.values import first_violations, type_counts, value_counts
from tierline.plans.layers import Layers
from tierline.plans.profiling import inferred_column_types, profile_columns, rule_registry, rule_violations
from tierline.queries import bronze_lineage


def types_of(spark, texts):
    counts = type_counts(spark.createDataFrame([(t,) for t in texts], "c string"), ["c"])
    accepted = {k: count_of("n", f"bits & {1 << i} <> 0") for i, k in enumerate(KINDS)}
    one = aggregate(counts, {}, {"n": count_of("n", "bits IS NOT NULL"), **accepted})
    return one.selectExpr(narrowest({k: k for k in KINDS}, "n > 0 AND {0} = n") + " AS t").first()["t"]


@pytest.mark.parametrize(
    "texts,kind",
    [
        (["true", " False "], "boolean"), (["1", "-20", "+3", None, ""], "integer"), (["1", "2.50", ".5"], "decimal"),
        (["2024-02-29", "1999-12-31"], "date"), (["2024-02-29", "2024-02-29 10:00"], "timestamp"),
        (["2023-02-29"], "string"), (["1", "true"], "string"), (["1", "x"], "string"), (["12345678901234567890"], "decimal"),
        ([None, " "], "string"), ([], "string"), (["1\n"], "string"), (["2024-01-01T10:11:12.123456"], "timestamp"),
    ],
)
def test_types_merge_to_the_narrowest_that_accepts_all(spark, texts, kind):
    assert types_of(spark, texts) == kind


def test_type_counts_stay_small_whatever_the_number_of_values(spark):
    df = spark.range(0, 20_000, 1, 4).selectExpr("cast(id AS string) AS a", "if(id % 3 = 0, 'x', concat(id, '.5')) AS b")
    counts = type_counts(df, ["a", "b"])
    assert sorted((r.columna, r.n) for r in counts.collect()) == [("a", 20_000), ("b", 6_667), ("b", 13_333)]


def test_violations_rank_all_rules_in_one_scan(spark):
    df = spark.range(0, 5_000, 1, 4).selectExpr("if(id % 50 = 0, NULL, id % 700) AS k", "id", "cast(NULL AS int) AS empty")
    found = first_violations(df, {"even": "id % 2 = 0", "all": "true", "none": "false", "unknown": "empty > 0"}, "k", ["k", "id", "empty"], 3)
    rows = {(r.codigo, r.posicion): (r.clave, r.fila) for r in found.collect()}
    assert set(rows) == {(c, p) for c in ("even", "all") for p in (1, 2, 3)}
    assert rows["all", 1] == ("1", "k=1, id=1, empty=NULL")
    assert rows["all", 2] == ("1", "k=1, id=1401, empty=NULL") and rows["even", 1][0] == "10"
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Range (0, 5000") == 1 and "WindowGroupLimit" in plan


def test_null_keys_come_last_and_empty_tables_give_nothing(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), ("z", "c")], "k string, v string")
    rows = first_violations(df, {"r": "true"}, "k", ["v"], 5).collect()
    assert [(r.posicion, r.clave, r.fila) for r in sorted(rows, key=lambda r: r.posicion)] == [(1, "z", "v=c"), (2, None, "v=a"), (3, None, "v=b")]
    assert first_violations(df.limit(0), {"r": "true"}, "k", ["v"], 5).count() == 0


def test_lineage_of_both_layers_is_compared_row_by_row(spark):
    layers = Layers(bronze_loader(spark, ROWS))
    rows = {r.tabla: r for r in bronze_lineage(layers).collect()}
    assert len(rows) == 18 and all(r.estado == "OK" for r in rows.values())
    # A silver row that carries another batch.
    silver = layers.silver("students")
    one = silver.first()["student_id"]
    layers.use("silver", "students", silver.selectExpr("* EXCEPT (_batch_id)", f"if(student_id = '{one}', 'other', _batch_id) AS _batch_id"))
    found = [r for r in bronze_lineage(layers).collect() if r.tabla == "students"]
    assert {r.estado for r in found} == {"REVISAR"} and len(found) == 2


def test_reports_over_a_small_source(spark):
    layers = Layers(bronze_loader(spark, ROWS))
    types = {(r.tabla, r.columna): r for r in inferred_column_types(layers).collect()}
    assert sum(r.valores + r.sin_valor for (t, _), r in types.items() if t == "students") == 7 * len(ROWS["students"])
    assert all(r.conformes <= r.valores for r in types.values())
    counted = {r.codigo: r.registros_invalidos for r in rule_registry(layers).collect()}
    found = Counter(r.codigo for r in rule_violations(layers).collect())
    assert found == {code: min(n, 20) for code, n in counted.items() if n}


@pytest.mark.parametrize("name", ["rule_violations", "inferred_column_types", "bronze_lineage"])
def test_query_equals_sql(spark, name):
    verdict, _, _ = compare(spark, connect(SMALL), SMALL, name, contract.queries()[name], contract.oracle_sql()[name])
    assert verdict == "ok"


def test_keys_and_references_are_counted_apart_from_other_columns(spark):
    """What fills a task's memory is counted by its text alone; only the other columns of a table share a stack."""
    plan = profile_columns(Layers(bronze_loader(spark)))._jdf.queryExecution().optimizedPlan().toString()
    stacks = [line for line in plan.splitlines() if "Generate stack(" in line]
    assert stacks
    for column in ("grade_id", "enrollment_id", "invoice_id", "product_id", "account_id", "opportunity_id", "contact_id"):
        assert not any(f"stack({column}," in line or f", {column}," in line for line in stacks), column


def test_a_column_alone_keeps_its_nulls_and_repeats(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), ("",), (None,)], "k string")
    counts = value_counts(df, ["k"])
    assert sorted((r.columna, "-" if r.valor is None else r.valor, r.n) for r in counts.collect()) == [("k", "", 1), ("k", "-", 2), ("k", "a", 2)]
    assert "Generate" not in counts._jdf.queryExecution().optimizedPlan().toString()
    assert value_counts(df.limit(0), ["k"]).count() == 0
