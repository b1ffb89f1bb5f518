from __future__ import annotations

import json
import threading
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tierline.sources.store import Store, WriteMismatch, content_digest


def digest(df):
    return tuple(df.selectExpr(*[f"{sql} AS {k}" for k, sql in content_digest(df.schema).items()]).first())


def test_digest_is_free_of_order_and_sees_every_change(spark):
    schema = "a string, b string, c double, d map<string,int>"
    rows = [("x", None, 1.0, {"k": 1, "l": 2}), (None, "x", 1.0, None), ("x", "y", None, {}), ("x", "y", None, {})]
    base = digest(spark.createDataFrame(rows, schema))
    assert base == digest(spark.createDataFrame(rows[::-1], schema).repartition(3))
    changes = [
        [("x", None, 1.5, {"k": 1, "l": 2}), *rows[1:]], [(None, "x", 1.0, {"k": 1, "l": 2}), *rows[1:]],
        [("x", None, 1.0, {"k": 2, "l": 1}), *rows[1:]], rows[:3], [*rows[:3], rows[0]], [*rows, rows[2]],
    ]
    assert len({base, *[digest(spark.createDataFrame(c, schema)) for c in changes]}) == 1 + len(changes)
    assert digest(spark.createDataFrame([], schema)) == (0, 0)


def test_a_changed_cell_stops_the_write(spark, tmp_path):
    class Careless(Store):
        def _read_back(self, path):
            return super()._read_back(path).withColumn("v", F.expr("if(id = 7, 'other', v)"))

    rows = spark.range(20).selectExpr("id", "concat('v', id) AS v")
    with pytest.raises(WriteMismatch, match="not the same"):
        Careless(spark, str(tmp_path)).replace("t", rows)
    assert list((tmp_path / "t").iterdir()) == []  # nor does it leave files
    Careless(spark, str(tmp_path), verify_content=False).replace("t", rows)
    assert Store(spark, str(tmp_path)).count("t") == 20


def test_changing_columns_are_digested_as_they_were_written(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = spark.range(50).withColumns({"r": F.rand(), "u": F.expr("uuid()"), "now": F.current_timestamp()})
    assert store.replace("t", rows).rows_stored == 50


def test_two_writers_at_once(spark, tmp_path):
    """Both write while the other does; both commit, neither loses files."""
    root, results, errors, gate = str(tmp_path), {}, [], threading.Barrier(2)

    class Slow(Store):
        def _stored(self, path):
            gate.wait(60)  # both have written, none has committed
            return super()._stored(path)

    def write(size):
        try:
            results[size] = Slow(spark, root).replace("t", spark.range(size))
        except Exception as e:  # pragma: no cover
            errors.append(e)

    threads = [threading.Thread(target=write, args=(n,)) for n in (11, 22)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    store = Store(spark, root)
    assert [v.generation for v in store.committed("t")] == [1, 2]
    assert {spark.read.parquet(results[n].path).count() for n in (11, 22)} == {11, 22}
    assert store.path("t") in {r.path for r in results.values()} and store.count("t") in (11, 22)


def test_only_one_writer_gets_a_generation(spark, tmp_path):
    store, won = Store(spark, str(tmp_path)), []
    threads = [threading.Thread(target=lambda i=i: won.append(store._create(f"{tmp_path}/_commits/t/{1:020d}", str(i)))) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(won) == [False] * 7 + [True]
    assert [x.name for x in (tmp_path / "_commits" / "t").iterdir() if not x.name.endswith(".crc")] == [f"{1:020d}"]


def test_files_of_a_running_writer_stay_and_abandoned_ones_go(spark, tmp_path):
    store = Store(spark, str(tmp_path), abandoned=timedelta(hours=1))
    running = tmp_path / "t" / f"v{time.time_ns():020d}-aaaaaaaa"
    abandoned = tmp_path / "t" / f"v{time.time_ns() - 2 * 3600 * 10**9:020d}-bbbbbbbb"
    for folder in (running, abandoned):
        spark.range(3).write.parquet(str(folder))
    store.replace("t", spark.range(4))
    assert running.exists() and not abandoned.exists() and store.count("t") == 4


def test_what_a_writer_said_is_kept(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.written_by("t", load="a") is None
    store.replace("t", spark.range(4), about={"load": "a", "stamp": "s"})
    assert store.written_by("t", load="a").rows_stored == 4 and store.current("t").about["stamp"] == "s"
    store.replace("t", spark.range(5), about={"load": "b"})
    assert store.written_by("t", load="a") is None
    commit = json.loads(next(x for x in (tmp_path / "_commits" / "t").iterdir() if x.name.endswith("2")).read_text())
    assert commit["rows"] == 5


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_tables_cut_alike_meet_without_a_shuffle(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace("parents", spark.range(500).selectExpr("concat('k', id) AS k", "id"), bucket_by="k", buckets=6)
    store.replace("children", spark.range(3_000).selectExpr("concat('k', id % 600) AS k", "id AS v"), bucket_by="k", buckets=6)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        summed = store.scan("children").groupBy("k").agg(F.sum("v").alias("v"))
        joined = store.scan("parents").join(summed, "k", "left")
        assert shuffles(joined) == 0
        assert joined.count() == 500 and joined.agg(F.sum("v")).first()[0] == sum(i for i in range(3_000) if i % 600 < 500)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_skewed_bucket_is_read_in_splits(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) AS k", "uuid() AS v")
    store.replace("t", rows, bucket_by="k", buckets=8)
    version = store.current("t")
    sizes = store.bucket_sizes(version)
    assert len(sizes) == 8 and min(sizes) > 0 and max(sizes) > 3 * sorted(sizes)[4]
    assert not store.skewed(version) and store.skewed(version, 3.0, 1_000)
    assert "Bucketed: true" in store.scan("t").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(Store, "skewed", lambda self, v: True)
    assert "Bucketed: true" not in store.scan("t").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert store.scan("t").count() == 30_000
