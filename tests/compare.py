"""Run registered queries and their SQL side by side: python tests/compare.py [folder] [names...]."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels".split()


def normal(value: object) -> str:
    if isinstance(value, Decimal):
        return format(value.normalize() + 0, "f") if value else "0"
    return repr(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark, con, folder: str, name: str, query, sql: str) -> tuple[str, float, float]:
    start = time.time()
    df = query(spark, folder)
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spark_seconds = time.time() - start
    start = time.time()
    cursor = con.execute(sql)
    right = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    sql_seconds = time.time() - start
    if sorted(df.columns) != sorted(d[0] for d in cursor.description):
        extra = set(df.columns) ^ {d[0] for d in cursor.description}
        return f"COLUMNS {sorted(extra)}", spark_seconds, sql_seconds
    if left == right:
        return "ok", spark_seconds, sql_seconds
    order = sorted(df.columns)
    one, two = sorted(set(left) - set(right))[:1], sorted(set(right) - set(left))[:1]
    where = ""
    if one and two:
        where = str([(c, a, b) for c, a, b in zip(order, one[0], two[0], strict=True) if a != b][:6])
    return f"DIFF rows {len(left)} {len(right)} {where}", spark_seconds, sql_seconds


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tierline.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    registered, statements = queries(), oracle_sql()
    names = sys.argv[2:] or list(registered)
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        if name not in statements:
            print(f"{name:36s} no SQL")
            continue
        try:
            verdict, a, b = compare(spark, con, folder, name, registered[name], statements[name])
        except Exception as e:  # report and go on with the next query
            verdict, a, b = "ERROR " + str(e)[:400].replace("\n", " "), 0, 0
        bad += verdict != "ok"
        print(f"{name:36s} {a:6.2f}s {b:6.2f}s {verdict}", flush=True)
    print("different:", bad, "without query:", sorted(set(statements) - set(registered)))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
