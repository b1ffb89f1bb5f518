from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tierline.sources.csv import read_bronze, scan_text
from tierline.sources.records import _lines, blocks_inside, scan_records


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_a_quoted_line_break_over_a_block_border(spark, tmp_path, small_splits):
    long = "first line\nsecond " + "x" * 150 + "\n\n\"quoted\", with, commas\r\nlast"
    rows = [["1", "plain"], ["2", long], ["3", "a\nb"], ["4", ""]]
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\n").writerows([["id", "text"], *rows])
    path = tmp_path / "t.csv"
    path.write_bytes(out.getvalue().encode())
    lines = _lines(spark, str(path))
    assert lines.rdd.getNumPartitions() > 3  # several tasks for one file
    assert sum(map(len, blocks_inside(lines).values())) >= 1
    found = sorted(tuple(r) for r in scan_text(spark, str(path), ["id", "text"], multi_line=True).collect())
    assert found == [("1", "plain"), ("2", long), ("3", "a\nb"), ("4", None)]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_equal_a_parser_that_reads_the_file_as_one(spark, tmp_path, small_splits, seed, end):
    draw = random.Random(seed)
    cell = lambda: "".join(draw.choices(["a", "é", " ", ",", '"', "\n", "\r\n", "word"], k=draw.choice([0, 1, 3, 8, 60])))
    rows = [[f"r{i}", cell(), cell()] for i in range(40)]
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL).writerows([["id", "b\nb", "c"], *rows])
    text = out.getvalue() if draw.random() < 0.5 else out.getvalue().removesuffix(end)
    path = tmp_path / "t.csv"
    path.write_bytes(text.encode())
    found = scan_records(spark, str(path)).collect()
    assert sum(r.header for r in found) == 1
    parse = lambda record: next(csv.reader(io.StringIO(record, newline="")))
    assert sorted(parse(r.record) for r in found if not r.header) == sorted(rows)


def test_several_files_each_with_a_header(spark, tmp_path, small_splits):
    folder = tmp_path / "raw" / "billing" / "products.csv"
    folder.mkdir(parents=True)
    names = "product_id,sku,name,category,monthly_price,active"
    for k in range(3):
        body = "".join(f'{k}{i},s,"line one\nline two {i}",c,1.50,true\n' for i in range(9))
        (folder / f"part-{k}.csv").write_text(f"{names}\n{body}\n\n")
    stamp = __import__("datetime").datetime(2024, 1, 1, tzinfo=__import__("datetime").timezone.utc)
    rows = read_bronze(spark, str(tmp_path / "raw"), "products", stamp, "b", multi_line=True).collect()
    assert len(rows) == 27 and {(r.product_id[0], r["_source_file"]) for r in rows} == {(str(k), f"part-{k}.csv") for k in range(3)}
    assert {r.name.split("\n")[0] for r in rows} == {"line one"}


def test_no_blocks_inside_quotes_and_empty_files(spark, tmp_path, small_splits):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n" + "1,2\n" * 60)
    assert blocks_inside(_lines(spark, str(path))) == {}
    assert scan_text(spark, str(path), ["b"], multi_line=True).agg(F.count("b")).first()[0] == 60
    path.write_text("a,b\n")
    assert scan_text(spark, str(path), ["b"], multi_line=True).count() == 0


def test_rows_longer_than_the_header_fail_here_too(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"x\ny"\n1,2,3\n')
    with pytest.raises(Exception, match="more fields than the header"):
        scan_text(spark, str(path), ["a"], multi_line=True).collect()
