from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tierline.llm.mixing import OP2_SQL, mixed, op2_source_mixing

SMALL = "/root/testdata/sf0.001"


def filled(sizes, weights, most=3):
    """Water-filling, one source clamped at a time."""
    total, open_, target = sum(sizes.values()), set(sizes), {}
    while open_:
        level = (total - sum(target.values())) / sum(weights[s] for s in open_)
        over = [s for s in open_ if level * weights[s] > most * sizes[s]]
        if not over:
            return target | {s: level * weights[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            open_.discard(s)
    return target


def test_targets_and_repeats(docs):
    rows = [(i, "w " * (i % 7 + 1), ["a", "b", "c", None][(i * i) % 4]) for i in range(400)]
    rows += [(1000 + i, "w " * 3, "tiny") for i in range(2)]
    got = mixed(docs(rows, extra=["m_order", "m_size", "m_row"])).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    ordered = sorted((s for s in sizes if s is not None)) + [None]
    expected = filled(sizes, {s: k % 3 + 1 for k, s in enumerate(x for x in ordered if x in sizes)})
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.m_target == pytest.approx(expected[r.source]) and r.m_source_size == sizes[r.source]
        assert 0 <= r.m_repeats <= 3 and r.m_order == "own m_order" and r.m_row == "own m_row"
        taken[r.source] = taken.get(r.source, 0) + r.m_repeats * r.m_size
    for s, n in taken.items():
        assert abs(n - expected[s]) <= 4  # half of the longest document


def test_reruns_agree_however_partitioned(docs):
    frame = docs([(i, "w " * (i % 9), f"s{i % 3}") for i in range(200)])
    one = sorted((r.doc_id, r.m_repeats) for r in mixed(frame.repartition(1)).collect())
    two = sorted((r.doc_id, r.m_repeats) for r in mixed(frame.repartition(7)).collect())
    assert one == two


def test_given_weights(docs, spark):
    weights = spark.createDataFrame([("a", 1), ("b", 0)], "m_source string, m_weight long")
    got = mixed(docs([(i, "w w", "ab"[i % 2]) for i in range(40)]), weights).groupBy("source").agg(F.sum("m_repeats").alias("n"))
    assert dict(got.collect()) == {"a": 40, "b": 0}


def test_empty_null_and_repeated(docs):
    assert mixed(docs([])).count() == 0
    rows = [(None, None, None), (1, "", "a"), (2, "x y", "a"), (2, "x y", "a"), (2, "x y", "a")]
    got = mixed(docs(rows)).collect()
    assert len(got) == 5 and {r.m_size for r in got} == {0, 2}


def test_query_equals_sql(spark):
    from compare import compare
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    assert compare(spark, con, SMALL, "op2", op2_source_mixing, OP2_SQL)[0] == "ok"


def totals(rows):
    out = {}
    for r in rows:
        taken, target = out.get(r.source, (0, r.m_target))
        out[r.source] = taken + r.m_repeats * r.m_size, target
    return out


def test_many_rows_without_id_come_near_the_target(docs):
    """Rows that nothing tells apart but their text, or not even that, are taken one by one."""
    rows = [(None, f"w{i} w w w", "a") for i in range(500)] + [(None, "same w w w", "a") for _ in range(500)]
    rows += [(i, "w w w w", "b") for i in range(1_000)] + [(7, "w " * (i % 3 + 1), "c") for i in range(900)]
    got = mixed(docs(rows, extra=["m_text", "m_number"]).repartition(5)).collect()
    assert len(got) == len(rows)
    for source, (taken, target) in totals(got).items():
        assert abs(taken - target) <= 4, source
    counts = {r.m_repeats for r in got if r.source == "a"}
    assert len(counts) == 2 and max(counts) - min(counts) == 1


def test_null_and_repeated_ids_equal_sql(docs, spark, tmp_path):
    import duckdb
    from compare import compare

    rows = [(None, "w " * (i % 3), "abc"[i % 3]) for i in range(300)] + [(i % 40, "w " * (i % 4), ["a", "b", None][i % 3]) for i in range(400)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(spark, con, str(tmp_path), "op2", op2_source_mixing, OP2_SQL)[0] == "ok"
