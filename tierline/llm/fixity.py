"""Fixity audit of archive replicas: records and ordered offset ranges are hashed into trees, roots are compared,
and only branches that differ are followed down to the records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm.shared import settled

#: Hex digits of a file's hash that one level above the files tells apart, children of an inner node, and records of an
#: archive file that `archived` lays out.
DIGITS, FANOUT, FILE_RECORDS = 2, 256, 256

#: Open nodes of a level that the descent broadcasts, some 200 bytes each; more of them meet their children by a shuffle.
OPEN_NODES = 20_000


def lanes_of(pages: DataFrame, file_records: int = FILE_RECORDS) -> int:
    """The files that `archived` spreads pages without an id over."""
    return max(1, pages.count() // file_records)


def archived(pages: DataFrame, file_records: int = FILE_RECORDS, lanes: int | None = None) -> DataFrame:
    """WARC response records of pages (page_id, url, html): file, seq, record_id, offset, length, payload.

    A file holds the pages of one range of ids, in their order; pages without an id are spread over files of their
    own by their content. Replicas that are compared need the same number of these, `lanes`; without it, it follows
    from the number of pages. NULL url and html count as empty. Rows that repeat a page are records of their own.
    """
    lanes = lanes_of(pages, file_records) if lanes is None else lanes
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    body = F.concat(html, F.lit("\r\n\r\n"))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"),
    )
    file = F.when(
        F.col("page_id").isNotNull(), F.concat(F.lit("ids-"), F.expr(f"(page_id - pmod(page_id, {file_records}L)) div {file_records}").cast("string"))
    ).otherwise(F.concat(F.lit("none-"), F.pmod(F.xxhash64(url, html), F.lit(lanes)).cast("string")))
    rows = pages.select(
        file.alias("file"), F.col("page_id").cast("long").alias("record_id"), F.concat(head, body).cast("binary").alias("payload")
    )
    length = F.octet_length("payload").cast("long")
    rows = rows.withColumns({"length": length, "digest": F.sha2("payload", 256)})
    order = Window.partitionBy("file").orderBy("record_id", "digest")
    return rows.withColumn("seq", (F.row_number().over(order) - 1).cast("long")).withColumn(
        "offset", F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    )


def leaves(records: DataFrame) -> DataFrame:
    """A leaf a record: its digest bound to its place. Payloads are hashed where they lie and not shuffled."""
    digest = F.col("digest") if "digest" in records.columns else F.sha2("payload", 256)
    return records.select(
        "file", "seq", "record_id", F.col("offset").alias("lo"), (F.col("offset") + F.col("length")).alias("hi"), digest.alias("digest")
    )


def _joined(parts: list[Column]) -> Column:
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def tree(leaf: DataFrame, file_levels: int, archive_levels: int) -> DataFrame:
    """Nodes of all levels: level 0 are records, file_levels the files, the last level is the root.

    Below a file, node i of a level covers FANOUT neighbours, and so one range of offsets. Above the files, nodes are
    prefixes of a hash of the file's name, DIGITS hex digits a level. A node gathers its direct children alone.
    """
    file_key = F.md5("file")
    level = leaf.select(
        F.lit(0).alias("level"), "file", F.substring(file_key, 1, DIGITS * archive_levels).alias("prefix"), F.col("seq").alias("i"),
        "lo", "hi", _joined([F.col("lo"), F.col("hi"), F.col("digest")]).alias("hash"),
    )
    levels = [level]
    ordered = lambda *by: F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct(*by, F.col("hash").alias("h")))), lambda x: x["h"]), "|"
    )
    for k in range(1, file_levels + 1):
        level = (
            level.groupBy("file", "prefix", F.floor(F.col("i") / FANOUT).alias("up"))
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), ordered("i").alias("below"))
            .select(F.lit(k).alias("level"), "file", "prefix", F.col("up").alias("i"), "lo", "hi",
                    _joined([F.col("lo"), F.col("hi"), F.col("below")]).alias("hash"))
        )
        levels.append(level)
    level = level.withColumn("file", F.concat_ws("/", "file", "i"))
    for k in range(archive_levels, -1, -1):
        if k < archive_levels:
            level = level.withColumns({"file": F.col("prefix"), "prefix": F.substring("prefix", 1, DIGITS * k)})
        level = (
            level.groupBy("prefix").agg(F.min("lo").alias("lo"), F.sum("hi").alias("hi"), ordered("file").alias("below"))
            .select(F.lit(file_levels + 1 + archive_levels - k).alias("level"), F.lit("").alias("file"), "prefix",
                    F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("lo"), "hi", F.sha2("below", 256).alias("hash"))
        )
        levels.append(level)
    return reduce(DataFrame.unionByName, levels)


def _levels(n: int) -> int:
    k = 0
    while FANOUT**k < n:
        k += 1
    return k


def _below(nodes: DataFrame, above: DataFrame, names: list[str]) -> DataFrame:
    """The nodes whose parents are in the settled frame `above`, which is counted from its files before it is broadcast."""
    near = F.broadcast(above) if above.count() <= OPEN_NODES else above.hint("merge")
    return nodes.join(near, names, "left_semi")


def audit(one: DataFrame, two: DataFrame) -> DataFrame:
    """Records in which two replicas differ: file, record_id, copy, status and both sides' offset, length and digest.

    Each replica is a frame of records (file, seq, record_id, offset, length, and payload or digest); seq counts the
    records of a file from 0. Status: changed (same place, other bytes), resized, moved (same bytes, other place),
    missing (in the first alone), extra (in the second alone). Records that repeat an id within a file are told apart
    by `copy`, their number in order. Equal replicas, empty ones too, give no row.
    """
    sides = [settled(leaves(x)) for x in (one, two)]
    longest, files = 0, 0
    for side in sides:
        row = side.agg(F.max("seq"), F.approx_count_distinct("file")).first()
        longest, files = max(longest, (row[0] or 0) + 1), max(files, row[1] or 0)
    file_levels, archive_levels = _levels(longest), _levels(files)
    trees = [settled(tree(side, file_levels, archive_levels)) for side in sides]
    open_nodes, top = None, file_levels + 1 + archive_levels
    key = ["file", "prefix", "i"]
    for level in range(top, -1, -1):
        a, b = ([t.where(F.col("level") == level).drop("level", "lo", "hi") for t in trees])
        if open_nodes is not None:  # children of the nodes that differ
            if level <= file_levels - 1:
                parent = ["file", "prefix", F.floor(F.col("i") / FANOUT).alias("up")]
                names = ["file", "prefix", "up"]
                above = open_nodes.select("file", "prefix", F.col("i").alias("up"))
            else:
                width = archive_levels if level <= file_levels else archive_levels - (level - file_levels - 1) - 1
                parent = [F.substring("prefix", 1, DIGITS * max(width, 0)).alias("up")]
                names, above = ["up"], open_nodes.select(F.col("prefix").alias("up"))
            a, b = (_below(x.select("*", *[p for p in parent if not isinstance(p, str)]), above, names).select(*key, "hash") for x in (a, b))
        b = b.select(*key, F.col("hash").alias("other"))
        open_nodes = settled(
            a.join(b.hint("merge"), key, "full_outer").where(~F.col("hash").eqNullSafe(F.col("other"))).select(*key)
        )
    copy = Window.partitionBy("file", "record_id").orderBy("seq")
    found = []
    for name, side in zip("ab", sides):
        bad = _below(side, open_nodes.select("file", F.col("i").alias("seq")), ["file", "seq"])
        bad = bad.withColumn("copy", F.row_number().over(copy).cast("long"))
        found.append(
            bad.select(
                "file", "record_id", "copy", F.col("lo").alias(f"offset_{name}"), (F.col("hi") - F.col("lo")).alias(f"length_{name}"),
                F.col("digest").alias(f"digest_{name}"),
            )
        )
    a, b = found[0], found[1].select(*[F.col(c).alias(f"b_{c}") if c in ("file", "record_id", "copy") else c for c in found[1].columns])
    both = a.join(
        b, (F.col("file") == F.col("b_file")) & F.col("record_id").eqNullSafe(F.col("b_record_id")) & (F.col("copy") == F.col("b_copy")), "full_outer"
    )
    status = (
        F.when(F.col("digest_b").isNull(), "missing")
        .when(F.col("digest_a").isNull(), "extra")
        .when(F.col("digest_a") == F.col("digest_b"), "moved")
        .when(F.col("length_a") != F.col("length_b"), "resized")
        .otherwise("changed")
    )
    names = [x for s in "ab" for x in (f"offset_{s}", f"length_{s}", f"digest_{s}")]
    return both.select(
        F.coalesce("file", "b_file").alias("file"), F.coalesce("record_id", "b_record_id").alias("record_id"),
        F.coalesce("copy", "b_copy").alias("copy"), status.alias("status"), *names,
    )


def damaged(pages: DataFrame) -> DataFrame:
    """A second replica of the pages with damage that follows from page_id, for trials of the audit.

    Of 97 ids in turn the sixth has its middle character overwritten, of 389 the twelfth loses its second half, and of
    997 the fourth is gone.
    """
    pid = F.col("page_id")
    half = F.floor(F.length("html") / 2).cast("int")
    html = (
        F.when(pid % 97 == 5, F.concat(F.substring("html", F.lit(1), half), F.lit("\x1a"), F.expr("substring(html, int(length(html) / 2) + 2)")))
        .when(pid % 389 == 11, F.substring("html", F.lit(1), half))
        .otherwise(F.col("html"))
    )
    return pages.withColumn("html", html).where(F.coalesce(pid % 997 != 3, F.lit(True)))


def op10_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of the pages against a second replica that is damaged by a rule on page_id."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    lanes = lanes_of(pages)
    return audit(archived(pages, lanes=lanes), archived(damaged(pages), lanes=lanes))


OP10_SQL = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
q AS (
  SELECT page_id, url, CASE WHEN page_id % 97 = 5 THEN html[1:length(html) // 2] || chr(26) || substring(html, (length(html) // 2 + 2)::BIGINT)
                            WHEN page_id % 389 = 11 THEN html[1:length(html) // 2] ELSE html END AS html
  FROM p WHERE page_id % 997 <> 3),
both_sides AS (SELECT 'a' AS side, * FROM p UNION ALL SELECT 'b', * FROM q),
r AS (
  SELECT side, 'ids-' || (page_id // 256)::VARCHAR AS file, page_id AS record_id,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id::VARCHAR || '>'
         || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(html))::VARCHAR
         || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS payload
  FROM both_sides),
o AS (
  SELECT side, file, record_id, sha256(payload) AS digest, octet_length(encode(payload))::BIGINT AS length,
         (sum(octet_length(encode(payload))) OVER (PARTITION BY side, file ORDER BY record_id ROWS UNBOUNDED PRECEDING)
         - octet_length(encode(payload)))::BIGINT AS start
  FROM r)
SELECT coalesce(a.file, b.file) AS file, coalesce(a.record_id, b.record_id) AS record_id, 1::BIGINT AS copy,
       CASE WHEN b.digest IS NULL THEN 'missing' WHEN a.digest IS NULL THEN 'extra' WHEN a.digest = b.digest THEN 'moved'
            WHEN a.length <> b.length THEN 'resized' ELSE 'changed' END AS status,
       a.start AS offset_a, a.length AS length_a, a.digest AS digest_a, b.start AS offset_b, b.length AS length_b, b.digest AS digest_b
FROM (SELECT * FROM o WHERE side = 'a') a FULL JOIN (SELECT * FROM o WHERE side = 'b') b ON a.file = b.file AND a.record_id = b.record_id
WHERE a.digest IS DISTINCT FROM b.digest OR a.start IS DISTINCT FROM b.start
"""
