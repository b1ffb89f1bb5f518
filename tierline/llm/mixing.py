"""Mix of sources to target weights: capped water-filling, then whole and fractional repetitions by a seeded order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm.shared import WORD, settled, text_of


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """m_size: words of the text; m_order: the document's place in the seeded order, m_text: a hash of its text, in hex."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.withColumns({"m_size": F.regexp_count(text_of(), F.lit(WORD)).cast("long"), "m_order": F.md5(name), "m_text": F.hex(F.xxhash64(text_of()))})


def cycle_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """`sources` with m_weight: the values of `cycle` in turn, by code point of m_source, NULL last.

    The one window over all sources sorts a row a source, without its documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("m_source").asc_nulls_last())) - 1
    return sources.withColumn("m_weight", F.get(F.array(*map(F.lit, cycle)), F.pmod(place, F.lit(len(cycle)))).cast("long"))


def water_level(sources: DataFrame, max_epochs: int) -> float:
    """The level by which weights are multiplied, so that min(level * weight, max_epochs * size) sum up to all sizes.

    Each round reshares by weight what the sources above their cap leave; the level only rises, so that the clamped
    sources are those whose cap is below the level. Three sums a round come to the driver.
    """
    cap = F.col("m_source_size") * max_epochs
    total, weights = sources.agg(F.sum("m_source_size"), F.sum("m_weight")).first()
    level, before = (total / weights if weights else 0.0), None
    while level != before:
        clamped = F.lit(level) * F.col("m_weight") > cap
        caps, weights = sources.agg(F.sum(F.when(clamped, cap)), F.sum(F.when(~clamped, F.col("m_weight")))).first()
        before = level
        if weights:
            level = max(level, (total - (caps or 0)) / weights)
    return level


def planned(sized: DataFrame, weights: DataFrame | None = None, max_epochs: int = 3) -> DataFrame:
    """A row a source: m_source, m_source_size, m_weight, m_target, m_whole and the last of the extra documents.

    The words beyond whole repetitions are taken from documents in the seeded order, up to the one that the target
    cuts nearer to its end; m_last names it, with the number of rows of its id and size, and how many of them fit. Sums by the first digits of the order find the stretch in which that one lies; only that
    stretch, a 65,536th of a source, is then sorted. `weights` (m_source, m_weight) replaces the weights in turn;
    sources that it leaves out get none.
    """
    stretch = F.substring("m_order", 1, 4).alias("m_stretch")
    sums = settled(sized.groupBy(F.col("source").alias("m_source"), stretch).agg(F.sum("m_size").alias("m_sum")))
    sources = sums.groupBy("m_source").agg(F.sum("m_sum").alias("m_source_size"))
    if weights is None:
        sources = cycle_weights(sources)
    else:
        given = weights.select(F.col("m_source").alias("m_given"), "m_weight")
        sources = sources.join(given, F.col("m_source").eqNullSafe(F.col("m_given")), "left").drop("m_given")
        sources = sources.withColumn("m_weight", F.coalesce("m_weight", F.lit(0)))
    sources = settled(sources)
    level = water_level(sources, max_epochs)
    cap = (F.col("m_source_size") * max_epochs).cast("double")
    sources = sources.withColumn("m_target", F.least(cap, F.lit(level) * F.col("m_weight")))
    sources = sources.withColumn(
        "m_whole", F.when(F.col("m_source_size") > 0, F.floor(F.col("m_target") / F.col("m_source_size"))).otherwise(0).cast("long")
    ).withColumn("m_rest", F.col("m_target") - F.col("m_whole") * F.col("m_source_size"))
    upto = F.sum("m_sum").over(Window.partitionBy("m_source").orderBy("m_stretch"))
    # Small tables are written, so that Spark knows their sizes and, where these allow it, leaves the documents in place.
    edges = settled(
        sums.withColumn("m_before", upto - F.col("m_sum"))
        .join(sources.select(F.col("m_source").alias("m_own"), "m_rest"), F.col("m_source").eqNullSafe(F.col("m_own")))
        .where((F.col("m_before") <= F.col("m_rest")) & (F.col("m_rest") < F.col("m_before") + F.col("m_sum")))
        .select("m_own", "m_stretch", "m_before", "m_rest")
    )
    inside = sized.select("source", "doc_id", "m_order", "m_size").join(
        edges, F.col("source").eqNullSafe(F.col("m_own")) & (F.substring("m_order", 1, 4) == F.col("m_stretch"))
    )
    # Rows that share id and size stand side by side in the order; they are one row here, whatever their number.
    alike = inside.groupBy("m_own", "m_stretch", "m_order", "doc_id", "m_size").agg(
        F.count(F.lit(1)).alias("m_alike"), F.first("m_before").alias("m_before"), F.first("m_rest").alias("m_rest")
    )
    order = Window.partitionBy("m_own").orderBy("m_order", "doc_id", "m_size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("m_before") + F.coalesce(F.sum(F.col("m_size") * F.col("m_alike")).over(order), F.lit(0))
    # The k-th of them is in if before + k * size + size / 2 is not beyond the rest.
    room = F.col("m_rest") - before - F.col("m_size") / 2
    fit = F.when(room < 0, 0).when(F.col("m_size") == 0, F.col("m_alike")).otherwise(F.least("m_alike", F.floor(room / F.col("m_size")) + 1))
    alike = alike.withColumn("m_fit", fit.cast("long"))
    # Where the first document of the stretch is out, the extra ones end before it.
    last = alike.groupBy("m_own").agg(
        F.min("m_stretch").alias("m_stretch"),
        F.max(F.when(F.col("m_fit") > 0, F.struct("m_order", "doc_id", "m_size", "m_fit", "m_alike"))).alias("m_last"),
    )
    return settled(sources.join(last, F.col("m_source").eqNullSafe(F.col("m_own")), "left").drop("m_own", "m_rest"))


def _place() -> Column:
    """-1, 0 or 1 for a row before, among and after the last rows alike that a source takes beyond whole repetitions."""
    own = F.struct("m_order", F.col("doc_id").alias("doc_id"), "m_size")
    last = F.struct(F.col("m_last.m_order"), F.col("m_last.doc_id"), F.col("m_last.m_size"))
    stretch = F.substring("m_order", 1, 4)
    inside = F.when(F.col("m_last").isNull() | (own > last), 1).when(own < last, -1).otherwise(0)
    return F.when(F.col("m_stretch").isNull() | (stretch > F.col("m_stretch")), 1).when(stretch < F.col("m_stretch"), -1).otherwise(inside)


def _numbered(rows: DataFrame) -> DataFrame:
    """`rows` with m_number, counting those of a source from 1.

    They are written with their row number, and counted by lane: the first bits of their text's hash, then the part of
    the table. A lane holds a part's rows at most, however many rows are alike.
    """
    written = settled(rows.withColumn("m_row_id", F.monotonically_increasing_id()))
    lane = F.struct(F.substring("m_text", 1, 4).alias("head"), F.shiftright("m_row_id", 33).alias("part"))
    laned = written.withColumn("m_lane", lane)
    upto = F.sum("m_count").over(Window.partitionBy("m_source").orderBy("m_lane"))
    counts = laned.groupBy("m_source", "m_lane").agg(F.count(F.lit(1)).alias("m_count")).withColumn("m_upto", upto - F.col("m_count"))
    counts = counts.select(F.col("m_source").alias("m_of"), F.col("m_lane").alias("m_in"), "m_upto")
    joined = laned.join(counts, F.col("m_source").eqNullSafe(F.col("m_of")) & (F.col("m_lane") == F.col("m_in")))
    within = F.row_number().over(Window.partitionBy("m_source", "m_lane").orderBy("m_text", "m_row_id"))
    return joined.withColumn("m_number", F.col("m_upto") + within).drop("m_row_id", "m_lane", "m_of", "m_in", "m_upto")


def mixed(docs: DataFrame, weights: DataFrame | None = None, max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """Every row of `docs` with m_size, m_source_size, m_target and m_repeats, its number of copies in the mix.

    Columns doc_id, source and text are read; those named as the four new ones are replaced. A NULL source is a source of its own, NULL
    and empty texts have size 0. Rows that repeat a doc_id, and those without one, stand side by side in the order, by
    size; where a target ends among rows of equal id and size, as many of them are taken as it has room for, chosen by
    the hash of their text and, where its first bits are equal, by their place in the table. No row is taken more than
    `max_epochs` times. The same rows and seed give the same mix, but for that last choice however they are
    partitioned. An empty table gives an empty result.
    """
    new = ("m_size", "m_source_size", "m_target", "m_repeats")
    packed = _sized(docs.select("doc_id", "source", "text", F.struct("*").alias("m_row")), seed)
    narrow = settled(packed.select("doc_id", "source", "m_size", "m_order"))
    rows = _applied(packed.drop("text"), planned(narrow, weights, max_epochs))
    return rows.select(*[F.col("m_row")[c].alias(c) for c in docs.columns if c not in new], *new)


def _applied(sized: DataFrame, plan: DataFrame) -> DataFrame:
    rows = sized.join(plan, F.col("source").eqNullSafe(F.col("m_source"))).withColumn("m_place", _place())
    parted = (F.col("m_place") == 0) & (F.col("m_last.m_fit") < F.col("m_last.m_alike"))
    if plan.where("m_last.m_fit < m_last.m_alike").isEmpty():  # no target ends among rows alike
        return rows.withColumn("m_repeats", F.col("m_whole") + F.when(F.col("m_place") <= 0, 1).otherwise(0))
    some = _numbered(rows.where(parted)).withColumn("m_repeats", F.col("m_whole") + F.when(F.col("m_number") <= F.col("m_last.m_fit"), 1).otherwise(0))
    rest = rows.where(~F.coalesce(parted, F.lit(False))).withColumn("m_repeats", F.col("m_whole") + F.when(F.col("m_place") <= 0, 1).otherwise(0))
    return rest.unionByName(some.drop("m_number"))


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The mix of all documents, sources weighing 1, 2 and 3 in turn, and how many words it takes of each row."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "text")
    narrow = settled(_sized(docs, 17).select("doc_id", "source", "m_size", "m_order", "m_text"))
    return _applied(narrow, planned(narrow)).select(
        "doc_id",
        F.col("m_size").alias("size"),
        F.col("m_source_size").alias("source_size"),
        F.col("m_target").alias("target"),
        (F.col("m_repeats") * F.col("m_size")).alias("taken"),
        F.col("m_repeats").alias("repeats"),
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
f AS (
  SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER earlier, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level,
            row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place
  FROM w WINDOW earlier AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT coalesce(arg_min(level, place) FILTER (level * weight <= 3 * source_size), 0) AS level FROM f),
t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, l.level * weight) AS target FROM w, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
r AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.whole, e.target - e.whole * e.source_size AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, ((whole + repeats) * size)::BIGINT AS taken, (whole + repeats)::BIGINT AS repeats
FROM (SELECT *, (before + size / 2 <= rest)::INT AS repeats FROM r)
"""
