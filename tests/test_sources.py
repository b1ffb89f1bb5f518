from __future__ import annotations

from datetime import datetime, timezone

import pytest

from conftest import SMALL
from fixture_rows import ROWS, bronze_loader
from tierline.catalogue import LINEAGE, TABLES
from tierline.plans import runner
from tierline.plans.layers import Layers
from tierline.plans.rules import InvalidTable, assert_gold, assert_keys, gold_conservation, row_conservation
from tierline.sources.csv import read_bronze, scan_text
from tierline.sources.store import Store, WriteMismatch


def write_csv(folder, table, rows):
    path = folder / TABLES[table].domain
    path.mkdir(parents=True, exist_ok=True)
    columns = list(TABLES[table].columns)
    cell = lambda v: "" if v is None else '"' + v.replace('"', '""') + '"'
    lines = [",".join(columns), *[",".join(cell(r.get(c)) for c in columns) for r in rows]]
    (path / f"{table}.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture
def raw(tmp_path):
    for table, rows in ROWS.items():
        write_csv(tmp_path / "raw", table, rows)
    return str(tmp_path / "raw")


def test_missing_tokens_become_null_and_spaces_stay(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\nNA,nan\n"x ""y"", z",N/A\n , ok \n"",null\n')
    found = [tuple(r) for r in scan_text(spark, str(path), ["a", "b"]).collect()]
    assert found == [(None, None), ('x "y", z', None), (" ", " ok "), (None, None)]


def test_wrong_header_fails(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,c\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_text(spark, str(path), ["a", "b"]).collect()


def test_columns_are_mapped_by_header(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('c,b,a\n1,2,3\n4\n,"5\n6",7\n')
    found = [tuple(r) for r in scan_text(spark, str(path), ["a", "b"], multi_line=True).collect()]
    assert found == [("3", "2"), (None, None), ("7", "5\n6")]


def test_rows_longer_than_the_header_fail(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,2\n1,2,\n")
    with pytest.raises(Exception, match="more fields than the header"):
        scan_text(spark, str(path), ["a"]).collect()


def test_a_failed_replace_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    store.replace("t", spark.range(5))
    halfway = spark.range(0, 1000, 1, 4).selectExpr("if(id = 900, raise_error('halfway'), id) AS id")
    with pytest.raises(Exception, match="halfway"):
        store.replace("t", halfway)
    assert store.count("t") == 5
    monkeypatch.setattr(Store, "_stored", lambda self, path: 3)
    with pytest.raises(WriteMismatch):
        store.replace("t", spark.range(9))
    monkeypatch.undo()
    assert store.count("t") == 5
    for size in (1, 2, 3):
        store.replace("t", spark.range(size))
    assert store.count("t") == 3 and len(list((tmp_path / "t").iterdir())) == 2


def test_a_repeated_parent_key_stops_the_run_and_shows_in_the_queries(spark, tmp_path):
    rows = {**ROWS, "students": [*ROWS["students"], ROWS["students"][0]]}
    for table, content in rows.items():
        write_csv(tmp_path / "raw", table, content)
    with pytest.raises(InvalidTable, match="students"):
        runner.run(spark, str(tmp_path / "raw"), str(tmp_path / "lake"))
    layers = Layers(bronze_loader(spark, rows))
    kept = {r["table_name"]: r["state"] for r in row_conservation(layers).collect()}
    assert kept["students"] == "REVISAR" and kept["professors"] == "OK"
    gold = {r["object"]: r["state"] for r in gold_conservation(layers).collect()}
    assert gold["student_academic_summary"] == "REVISAR" and gold["account_crm_summary"] == "OK"
    with pytest.raises(InvalidTable, match="student_academic_summary"):
        assert_gold(layers)


def test_frames_follow_the_files(spark, tmp_path):
    from tierline.queries import QUERIES

    folder = tmp_path / "customer.parquet"
    rows = spark.read.parquet(f"{SMALL}/customer.parquet")
    rows.write.parquet(str(folder))
    before = QUERIES["silver_leads"](spark, str(tmp_path)).count()
    rows.write.mode("append").parquet(str(folder))
    assert QUERIES["silver_leads"](spark, str(tmp_path)).count() == 2 * before


def test_bronze_is_text_with_lineage(spark, raw):
    stamp = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
    df = read_bronze(spark, raw, "products", stamp, "b1")
    assert {kind for c, kind in df.dtypes if c not in LINEAGE} == {"string"}
    row = df.first()
    assert row["_source_file"] == "products.csv" and row["_batch_id"] == "b1"
    assert df.selectExpr("date_format(_ingested_at, 'yyyy-MM-dd HH:mm')").first()[0] == "2024-05-01 12:00"


def test_store_replaces_and_reconciles(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.replace("t", spark.range(100)).rows_stored == 100
    again = store.replace("t", spark.range(7), max_files=1)
    assert (again.rows_in, again.rows_stored, store.count("t")) == (7, 7, 7)
    assert store.scan("t", "id").columns == ["id"]


def test_whole_run(spark, raw, tmp_path):
    root = str(tmp_path / "lake")
    summary = runner.run(spark, raw, root).collect()
    assert [r["tabla"] for r in summary] == list(TABLES)
    assert all(r["filas_entrada"] == len(ROWS[r["tabla"]]) and r["estado"] == "OK" for r in summary)
    gold = Store(spark, f"{root}/gold")
    assert gold.scan("executive_kpis").first()["total_students"] == 3
    assert gold.count("student_customer_360") == 3
    assert gold.scan("customer_billing_summary").filter("currency = 'USD'").count() == 2
    report = runner.quality_report(Store(spark, f"{root}/silver")).collect()
    assert {r["table_name"] for r in report} == set(TABLES)
    batches = Store(spark, f"{root}/silver").scan("students").select("_batch_id").distinct().count()
    assert batches == 1


def test_bad_keys_stop_the_run(spark):
    rows = spark.createDataFrame([("a",), ("a",)], "product_id string")
    with pytest.raises(InvalidTable, match="duplicated"):
        assert_keys(rows, "products")
    rows = spark.createDataFrame([("a",), (" ",)], "product_id string")
    with pytest.raises(InvalidTable, match="without a key"):
        assert_keys(rows, "products")
    pairs = spark.createDataFrame([("o", "c"), ("o", "d")], "opportunity_id string, contact_id string")
    assert assert_keys(pairs, "opportunity_contacts") == 2
