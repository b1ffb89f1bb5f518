from __future__ import annotations

import hashlib

import duckdb
from compare import compare
from pyspark.sql import functions as F

from tierline.llm import fixity
from tierline.llm.fixity import OP10_SQL, archived, audit, leaves, op10_warc_fixity, tree

SMALL = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def pages(spark, n=700):
    return spark.createDataFrame([(i, f"http://x/{i}", f"<p>page {i} é</p>" * (i % 5)) for i in range(n)], PAGES)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SMALL}/pages.parquet')")
    assert compare(spark, con, SMALL, "op10", op10_warc_fixity, OP10_SQL)[0] == "ok"


def test_equal_replicas_have_no_damage(spark):
    frame = pages(spark)
    assert audit(archived(frame), archived(frame.repartition(5))).count() == 0
    none = spark.createDataFrame([], PAGES)
    assert audit(archived(none), archived(none)).count() == 0


def test_each_kind_of_damage(spark):
    frame = pages(spark)
    other = frame.where("page_id <> 30").withColumn(
        "html", F.when(F.col("page_id") == 301, F.translate("html", "p", "q")).when(F.col("page_id") == 611, F.concat("html", F.lit("x"))).otherwise(F.col("html"))
    )
    got = {r.record_id: r.status for r in audit(archived(frame), archived(other)).collect()}
    assert got[30] == "missing" and got[301] == "changed" and got[611] == "resized"
    assert all(s == "moved" for i, s in got.items() if i not in (30, 301, 611))
    assert set(got) == {30, 301, 611, *range(31, 256), *range(612, 700)}  # what follows in the same file has moved
    back = {r.record_id: r.status for r in audit(archived(other), archived(frame)).collect()}
    assert back[30] == "extra"


def test_a_whole_file_is_missing(spark):
    frame = pages(spark)
    got = audit(archived(frame), archived(frame.where("page_id < 256 OR page_id >= 512")))
    assert got.where("status = 'missing'").count() == 256 == got.count()


def test_nulls_and_repeated_records(spark):
    rows = [(None, "u", "a"), (None, "u", "a"), (None, None, None), (1, None, "x"), (1, None, "x"), (1, "v", "y")]
    frame = spark.createDataFrame(rows, PAGES).withColumns({"file": F.lit("f"), "seq": F.lit(0), "digest": F.lit("d")})
    assert archived(frame).count() == 6
    assert audit(archived(frame), archived(frame)).count() == 0
    less = spark.createDataFrame(rows[:-1], PAGES)
    assert audit(archived(frame), archived(less)).where("status = 'missing'").count() >= 1


def test_deeper_trees_find_the_same(spark, monkeypatch):
    frame = pages(spark)
    other = frame.withColumn("html", F.when(F.col("page_id") % 97 == 5, F.translate("html", "p", "q")).otherwise(F.col("html")))
    wide = sorted(audit(archived(frame, 16), archived(other, 16)).collect())
    monkeypatch.setattr(fixity, "FANOUT", 4)
    monkeypatch.setattr(fixity, "DIGITS", 1)
    assert sorted(audit(archived(frame, 16), archived(other, 16)).collect()) == wide and len(wide) > 3


def test_offsets_and_tree_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fixity, "FANOUT", 16)
    records = archived(pages(spark, 40)).orderBy("seq").collect()
    at = 0
    for r in records:
        assert r.offset == at and r.length == len(r.payload) and bytes(r.payload).startswith(b"WARC/1.0\r\n")
        at += r.length
    digest = lambda *x: hashlib.sha256("|".join(map(str, x)).encode()).hexdigest()
    low = [digest(r.offset, r.offset + r.length, hashlib.sha256(r.payload).hexdigest()) for r in records]
    nodes = {(r.level, r.i): r.hash for r in tree(leaves(archived(pages(spark, 40))), 2, 0).collect()}
    assert [nodes[0, i] for i in range(40)] == low
    first = digest(0, sum(r.length for r in records[:16]), "|".join(low[:16]))
    assert nodes[1, 0] == first


def test_pages_without_an_id_stay_in_their_files_when_others_are_gone(spark, tmp_path):
    # 512 pages and two files for those without an id; the damaged replica is a page short of that.
    rows = [(i if i < 256 else None, f"http://x/{i}", f"<p>page {i}</p>") for i in range(512)]
    spark.createDataFrame(rows, PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    got = op10_warc_fixity(spark, str(tmp_path)).collect()
    print(f"without an id: {sum(r.record_id is None for r in got)}")
    assert got and all(r.record_id is not None for r in got)
    assert {r.record_id for r in got if r.status == "missing"} == {3}


def test_many_open_nodes_meet_their_children_by_a_shuffle(spark, monkeypatch):
    frame = pages(spark)
    other = frame.withColumn("html", F.when(F.col("page_id") % 7 == 5, F.translate("html", "p", "q")).otherwise(F.col("html")))
    few = sorted(audit(archived(frame, 16), archived(other, 16)).collect())
    monkeypatch.setattr(fixity, "OPEN_NODES", 3)
    result = audit(archived(frame, 16), archived(other, 16))
    assert sorted(result.collect()) == few and len(few) > 50
    nodes = spark.createDataFrame([(i,) for i in range(9)], "up long")
    kinds = [n for n in (3, 4) if "Broadcast" in fixity._below(nodes, nodes.limit(n), ["up"])._jdf.queryExecution().executedPlan().toString()]
    assert kinds == [3]
