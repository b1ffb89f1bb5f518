from __future__ import annotations

import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fixture_rows import fixture_layers
from tierline.functions.exact import half_up, percent
from tierline.operators.links import attach_group, hot_key_join, link, orphan_keys, orphan_rows
from tierline.operators.values import describe, first_values, histogram, table_profile, value_counts
from tierline.plans import profiling

pairs = st.lists(st.tuples(st.integers(-(10**9), 10**9), st.integers(-(10**6), 10**6)), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None)
@given(pairs)
def test_half_up_matches_decimal_arithmetic(spark, values):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(values)], "i int, a bigint, b bigint")
    found = dict(df.selectExpr("i", f"{half_up('a', 'b', 2)} AS r").collect())
    for i, (a, b) in enumerate(values):
        want = None
        if b:
            size = (Decimal(abs(a)) / Decimal(abs(b))).quantize(Decimal("0.01"), ROUND_HALF_UP)
            want = -size if (a < 0) != (b < 0) else size
        assert found[i] == want


def test_percent_has_no_value_without_a_whole(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, 0L), (1L, NULL), (1L, 3L), (0L, 5L) AS t(a, b)")
    assert [r[0] for r in df.selectExpr(percent("a", "b")).collect()] == [None, None, Decimal("33.33"), Decimal("0.00")]


def hot_child(spark, n=4000):
    """A third of the rows on one key, a third without a key, the rest spread out."""
    key = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE cast(id AS string) END"
    return spark.range(n).selectExpr("cast(id AS string) AS row_id", f"{key} AS fk", "sha2(cast(id AS string), 256) AS payload")


def test_link_keeps_rows_under_hot_missing_and_repeated_keys(spark):
    child = hot_child(spark)
    parent = spark.createDataFrame([("hot", "p"), ("hot", "q"), ("5", "r"), (None, "s")], "pk string, a string")
    found = link(child, parent, "fk", "pk", "linked", "row_id", {"a": "carried"})
    assert found.count() == 4000
    assert Counter(r[0] for r in found.select("linked").collect())[True] == 1334 + 1
    assert {r[0] for r in found.filter("fk = 'hot'").select("carried").distinct().collect()} == {"p"}


def test_hot_partitions_are_split_and_missing_keys_spread(spark):
    settings_for_test = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings_for_test}
    try:
        for k, v in settings_for_test.items():
            spark.conf.set(k, v)
        child = hot_child(spark, 60000).repartition(6)
        parent = spark.range(60000).selectExpr("concat(id, '') AS pk").union(spark.sql("SELECT 'hot'"))
        linked = link(child, parent, "fk", "pk", "linked", "row_id")
        rows = linked.selectExpr("spark_partition_id() AS p", "*").collect()
        assert len(rows) == 60000
        assert len({r["p"] for r in rows if r["fk"] == "hot"}) > 1
        missing = Counter(r["p"] for r in rows if r["fk"] is None)
        assert len(missing) > 4 and max(missing.values()) < 12000
        grouped = attach_group(child, ["fk"], "row_id", {"size": "count(*)"})
        rows = grouped.selectExpr("spark_partition_id() AS p", "*").collect()
        assert len({r["p"] for r in rows if r["fk"] == "hot"}) > 1
        assert {r["size"] for r in rows if r["fk"] in ("hot", None)} == {20000}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_unused_links_cost_no_join(spark):
    """Catalyst drops a link whose flag nobody reads, because the parent side is unique per key."""
    layers = fixture_layers(spark)
    used = layers.silver("invoice_items").select("is_product_linked")
    unused = layers.silver("invoice_items").select("line_total")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(used).count("Join") == 1 and plan(unused).count("Join") == 0
    assert plan(layers.silver("grades").select("score")).count("Join") == 0


def test_inner_hot_key_join_drops_unmatched(spark):
    left = spark.createDataFrame([("1", "a"), ("2", None), ("3", "b")], "id string, k string")
    right = spark.createDataFrame([("a", 7), ("c", 8)], "pk string, v int")
    assert [tuple(r) for r in hot_key_join(left, right, "k", "pk", "id", how="inner").collect()] == [("1", "a", 7)]


def test_group_keys_do_not_collide(spark):
    df = spark.createDataFrame(
        [("1", "a", "bc"), ("2", "ab", "c"), ("3", None, "x"), ("4", "-", "x"), ("5", None, "x")],
        "id string, a string, b string",
    )
    found = dict(attach_group(df, ["a", "b"], "id", {"size": "count(*)"}).select("id", "size").collect())
    assert found == {"1": 1, "2": 1, "3": 2, "4": 1, "5": 2}


def test_orphans(spark):
    child = spark.createDataFrame([("a",), (" a",), ("b",), ("b",), (" ",), (None,)], "fk string")
    parent = spark.createDataFrame([("a ",), (None,)], "pk string")
    assert [r[0] for r in orphan_keys(child, "fk", parent, "pk").collect()] == ["b"]
    assert tuple(orphan_rows(child, "fk", parent, "pk").first()) == (6, 1, 5)  # untrimmed comparison


def test_value_counts_and_examples(spark):
    df = spark.createDataFrame([("x", "1"), ("x", None), ("y", "2"), (None, "10")], "a string, b string")
    counts = value_counts(df, ["a", "b"])
    assert {(r["columna"], r["valor"]): r["n"] for r in counts.collect()}[("a", "x")] == 2
    assert dict(first_values(counts, 2).collect()) == {"a": "x, y", "b": "1, 10"}


def test_table_profile_against_pandas(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice(["1", "2", None])) for _ in range(200)]
    df = spark.createDataFrame(rows, "a string, b string")
    frame = pd.DataFrame(rows)
    assert tuple(table_profile(df).first()) == (200, int(frame.isna().sum().sum()), int(frame.duplicated().sum()))
    assert tuple(table_profile(df.filter("a = 'none'")).first()) == (0, 0, 0)


def test_table_profile_is_one_scan_and_one_hash_shuffle(spark):
    df = spark.range(100).selectExpr("cast(id % 7 AS string) AS a", "cast(id AS string) AS b")
    plan = table_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_describe_and_histogram_against_pandas(spark):
    rng = random.Random(5)
    values = [Decimal(rng.randrange(0, 10000)).scaleb(-2) for _ in range(301)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v decimal(18,2)")
    found = {k: float(v) for k, v in describe(df, "v", 2).collect()}
    want = pd.Series([float(v) for v in values]).describe()
    assert found == pytest.approx(want.to_dict(), abs=1e-4)
    bins = histogram(df, "v", 20).orderBy("bin").collect()
    assert len(bins) == 20 and sum(r["cantidad"] for r in bins) == 301
    low, high = min(values), max(values)
    assert float(bins[0]["desde"]) == pytest.approx(float(low)) and float(bins[-1]["hasta"]) == pytest.approx(float(high))
    second = [v for v in values if low + (high - low) / 20 <= v < low + (high - low) / 10]
    assert bins[1]["cantidad"] == len(second)


def test_describe_of_nothing_and_of_one_value(spark):
    df = spark.createDataFrame([(None,)], "v decimal(18,2)")
    assert {k: v for k, v in describe(df, "v", 2).collect()}["count"] == 0
    one = dict(describe(spark.sql("SELECT cast(3 AS decimal(18,2)) AS v"), "v", 2).collect())
    assert one["std"] is None and one["50%"] == 3
    assert histogram(df, "v").count() == 0


def test_profiling_on_the_fixture(spark):
    layers = fixture_layers(spark)
    keys = {r["tabla"]: r for r in profiling.profile_primary_keys(layers).collect()}
    assert len(keys) == 18 and {r["estado"] for r in keys.values()} == {"OK"}
    foreign = {(r["tabla_hija"], r["columna_fk"]): r for r in profiling.profile_foreign_keys(layers).collect()}
    assert foreign["courses", "professor_id"]["valores_huerfanos"] == 1
    assert foreign["payments", "invoice_id"]["porcentaje_huerfanos"] == Decimal("16.67")
    dates = {(r["tabla"], r["columna"]): r for r in profiling.profile_dates(layers).collect()}
    assert dates["students", "birth_date"]["fechas_invalidas"] == 1
    found = {r["valor"]: r["porcentaje"] for r in profiling.distribution_of(layers, "opportunities", "stage").collect()}
    assert found["VALOR_NULO"] == Decimal("33.33")
    variants = {(r["tabla"], r["columna"]): r for r in profiling.category_spelling_variants(layers).collect()}
    assert variants["leads", "source"]["posibles_variantes"] == 1
    types = {(r["tabla"], r["columna"]): r for r in profiling.type_report(layers).collect()}
    assert types["products", "monthly_price"]["no_convertibles"] == 1
    temporal = {r["regla"]: r["registros_invalidos"] for r in profiling.temporal_rules(layers).collect()}
    assert temporal == {"SEM-01": 1, "STU-01": 0, "SUB-01": 1, "OPP-01": 2}
