from __future__ import annotations

import threading
import time

import pytest

from fixture_rows import ROWS, bronze_loader
from test_sources import write_csv
from tierline.plans import gold as gold_plans
from tierline.plans import runner
from tierline.plans.layers import Layers
from tierline.sources.star import StarSource
from tierline.sources.store import Store, Written

SMALL = "/root/testdata/sf0.001"


def test_needs_come_first_and_independent_names_run_together():
    begun, gate = [], threading.Barrier(2, timeout=20)

    def build(name):
        begun.append(name)
        if name in "ab":
            gate.wait()  # passes only if both run at the same time
        return Written(name, "", 1, 1)

    done = runner.in_order({"c": ["a", "b"], "a": [], "b": ["elsewhere"], "d": ["c"]}, build, 2)
    assert [w.table for w in done] == ["c", "a", "b", "d"] and begun[2:] == ["c", "d"]


def test_after_a_failure_nothing_more_is_begun():
    begun = []

    def build(name):
        begun.append(name)
        if name == "bad":
            raise ValueError("bad table")
        time.sleep(0.5)
        return Written(name, "", 1, 1)

    with pytest.raises(ValueError, match="bad table"):
        runner.in_order({"bad": [], "good": [], "next": ["bad"], "last": ["good"]}, build, 2)
    assert not {"next", "last"} & set(begun)


def test_declared_reads_are_the_ones_that_plans_make(spark):
    stored = {*gold_plans.SHARED, *gold_plans.TABLES, *gold_plans.VIEWS}
    source = StarSource(spark, SMALL).bronze

    class Watching(Layers):
        def gold(self, name):
            self.asked.add(name)
            return super().gold(name) if name not in stored or name == self.top else self.known[name]

    layers = Layers(source)
    for name in stored:
        watch = Watching(source)
        watch.asked, watch.top, watch.known = set(), name, {x: layers.gold(x) for x in stored}
        watch.gold(name)
        assert watch.asked & stored - {name} == set(gold_plans.READS.get(name, ())), name


@pytest.fixture
def raw(tmp_path):
    for table, rows in ROWS.items():
        write_csv(tmp_path / "raw", table, rows)
    return str(tmp_path / "raw")


def test_a_stopped_run_goes_on(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    written, replace = [], Store.replace

    def failing(self, table, df, *args, **more):
        layer = self.root.rpartition("/")[2]
        if (layer, table) == ("silver", "payments") and not allowed:
            raise OSError("the cluster went away")
        written.append((layer, table))
        return replace(self, table, df, *args, **more)

    allowed = []
    monkeypatch.setattr(Store, "replace", failing)
    with pytest.raises(OSError, match="went away"):
        runner.run(spark, raw, root, batch="night-1")
    first, allowed = set(written), [True]
    assert ("bronze", "payments") in first and not any(layer == "gold" for layer, _ in first)
    written.clear()
    summary = runner.run(spark, raw, root, batch="night-1").collect()
    assert not first & set(written) and ("silver", "payments") in written and ("gold", "executive_kpis") in written
    assert {r["tabla"]: r["filas_guardadas"] for r in summary} == {t: len(r) for t, r in ROWS.items()}
    stamps = {tuple(r) for t in ("students", "payments") for r in Store(spark, f"{root}/silver").scan(t, "_batch_id", "_bronze_ingested_at").collect()}
    assert len(stamps) == 1 and {b for b, _ in stamps} == {"night-1"}
    written.clear()
    runner.run(spark, raw, root, batch="night-2")
    assert len(written) == 18 + 18 + len(gold_plans.SHARED) + len(gold_plans.TABLES) + len(gold_plans.VIEWS)


def test_invoice_detail_joins_stored_tables_without_a_shuffle(spark, raw, tmp_path):
    """invoices, their lines and their payments are cut by invoice_id; only the file scans deal out rows."""
    root = str(tmp_path / "lake")
    source = bronze_loader(spark, ROWS)
    bronze, silver = Store(spark, f"{root}/bronze"), Store(spark, f"{root}/silver")
    for table in ROWS:
        bronze.replace(table, source(table))
    runner.build_silver(bronze, silver, buckets=5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        detail = Layers(bronze=silver.scan, silver=silver.scan).gold("invoice_detail")
        plan = detail._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 3 and "SortMergeJoin" in plan
        plain = Layers(source).gold("invoice_detail")
        assert sorted(map(str, detail.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
