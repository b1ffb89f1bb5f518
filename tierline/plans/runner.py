"""The batch run: CSV files to bronze, silver and gold Parquet tables, each write reconciled.

Every layer is written before the next one reads it, so a lost executor costs at most the stage it ran. Tables that do
not read each other are built at the same time. A run that was stopped goes on under its batch id: what this batch has
committed already is taken as it is. `root` must be reachable from all executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from datetime import datetime, timezone
from graphlib import TopologicalSorter
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tierline.catalogue import TABLES, source_file
from tierline.plans.gold import READS, SHARED
from tierline.plans.gold import TABLES as GOLD_TABLES
from tierline.plans.gold import VIEWS
from tierline.plans.layers import Layers
from tierline.plans.rules import InvalidTable, all_rule_counts, assert_gold, assert_keys
from tierline.plans.silver import base_columns, refine
from tierline.sources.csv import read_bronze
from tierline.sources.store import Store, Written

#: Silver tables that gold joins by one key, which their files can be cut by.
CO_LOCATED = {"invoices": "invoice_id", "invoice_items": "invoice_id", "payments": "invoice_id"}
#: Tables that are built at the same time.
PARALLEL = 4


def in_order(needs: Mapping[str, Iterable[str]], build: Callable[[str], Written], parallel: int = PARALLEL) -> list[Written]:
    """Builds each name after the names that it needs, up to `parallel` at a time; results in the order of `needs`.

    After a failure nothing more is begun, what runs is waited for, and the failure is raised.
    """
    order, done = TopologicalSorter({name: [x for x in reads if x in needs] for name, reads in needs.items()}), {}
    order.prepare()
    with ThreadPoolExecutor(parallel) as pool:
        running = {}
        while order.is_active():
            running |= {pool.submit(build, name): name for name in order.get_ready()}
            finished, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in finished:
                name = running.pop(future)
                try:
                    done[name] = future.result()
                except BaseException:
                    for other in running:
                        other.cancel()
                    raise
                order.done(name)
    return [done[name] for name in needs]


def _summary(spark: SparkSession, written: list[Written]) -> DataFrame:
    """(tabla, archivo, filas_entrada, filas_guardadas, estado), one row per table written."""
    rows = [(w.table, source_file(w.table), w.rows_in, w.rows_stored, "OK") for w in written]
    schema = "tabla string, archivo string, filas_entrada bigint, filas_guardadas bigint, estado string"
    return spark.createDataFrame(rows, schema)


def _stamp(bronze: Store, tables: Iterable[str], batch: str) -> str:
    """The point in time of a batch: that of the tables it has loaded, or now."""
    begun = [v.about["stamp"] for t in tables for v in bronze.committed(t) if v.about.get("batch") == batch]
    return min(begun, default=datetime.now(timezone.utc).isoformat())


def load_bronze(
    spark: SparkSession, raw_dir: str, bronze: Store, tables: Iterable[str] = TABLES, multi_line: bool = False, batch: str | None = None
) -> DataFrame:
    """Replace the bronze tables with the CSV files; all rows carry the stamp and id of this run.

    Tables that `batch` has loaded before are left as they are.
    """
    tables, batch = list(tables), batch or str(uuid4())
    stamp = _stamp(bronze, tables, batch)

    def load(table: str) -> Written:
        raw = lambda: read_bronze(spark, raw_dir, table, datetime.fromisoformat(stamp), batch, multi_line)
        return bronze.written_by(table, batch=batch) or bronze.replace(table, raw(), about={"batch": batch, "stamp": stamp})

    return _summary(spark, in_order({t: () for t in tables}, load))


def build_silver(
    bronze: Store, silver: Store, tables: Iterable[str] = TABLES, batch: str | None = None, buckets: int = 0
) -> list[Written]:
    """Replace silver tables, parents first. Bad keys or a changed row count stop the run.

    With `buckets`, the tables of CO_LOCATED are cut by their key into so many, and gold joins them without a shuffle.
    """
    tables, about = list(tables), {"batch": batch} if batch else {}

    def refined(table: str) -> Written:
        if batch and (known := silver.written_by(table, **about)):
            return known
        raw = bronze.scan(table)
        expected = assert_keys(base_columns(table, raw, *TABLES[table].key), table)
        key = CO_LOCATED.get(table) if buckets else None
        result = silver.replace(table, refine(table, raw, silver.scan), about=about, bucket_by=key, buckets=buckets)
        if result.rows_stored != expected:
            raise InvalidTable(f"{table}: {expected} bronze rows, {result.rows_stored} silver rows")
        return result

    return in_order({t: [x.parent for x in TABLES[t].links] for t in tables}, refined)


def build_gold(silver: Store, gold: Store, batch: str | None = None) -> list[Written]:
    """Replace the gold tables and views. Later objects scan the tables already written.

    At the end the stored objects are held against the stored tables that they were made from.
    """
    layers, about = Layers(bronze=silver.scan, silver=silver.scan), {"batch": batch} if batch else {}

    def build(name: str) -> Written:
        written = (gold.written_by(name, **about) if batch else None) or gold.replace(name, layers.gold(name), about=about)
        layers.use("gold", name, gold.scan(name))
        return written

    written = in_order({name: READS.get(name, ()) for name in (*SHARED, *GOLD_TABLES, *VIEWS)}, build)
    assert_gold(layers)
    return written


def quality_report(silver: Store) -> DataFrame:
    return all_rule_counts(Layers(bronze=silver.scan, silver=silver.scan))


def run(
    spark: SparkSession, raw_dir: str, root: str, multi_line: bool = False, batch: str | None = None, buckets: int = 0
) -> DataFrame:
    """All three layers below `root`; returns the bronze load summary. `multi_line`: see scan_text.

    `batch` names the run; called again with the same name it goes on where it was stopped. `buckets`: see build_silver.
    """
    batch = batch or str(uuid4())
    bronze, silver, gold = (Store(spark, f"{root.rstrip('/')}/{layer}") for layer in ("bronze", "silver", "gold"))
    summary = load_bronze(spark, raw_dir, bronze, multi_line=multi_line, batch=batch)
    build_silver(bronze, silver, batch=batch, buckets=buckets)
    build_gold(silver, gold, batch=batch)
    return summary
