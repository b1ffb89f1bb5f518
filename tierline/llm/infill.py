"""Fill-in-middle: a text is cut at two lines drawn by its id, and its parts change places between sentinels.

The cut places come from an indexable skip list over the lines: express lanes whose links carry how many units and how
many code points they pass over, so that a walk down the lanes adds up exactly to both."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.shared import slices, splitmix, text_of

#: What stands before the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")


class SkipList:
    """Units in order; lane k + 1 holds about a quarter of the units of lane k, chosen by a hash of their place.

    units[k][i] and points[k][i] are the widths of the link that leads to the i-th unit of lane k: how many units and
    how many code points lie between the end of the unit before it in that lane and its own end.
    """

    def __init__(self, lengths: np.ndarray) -> None:
        ends, drawn = np.arange(1, len(lengths) + 1), splitmix(np.arange(1, len(lengths) + 1))
        total = np.cumsum(lengths)
        self.units: list[np.ndarray] = []
        self.points: list[np.ndarray] = []
        self.down: list[np.ndarray] = []
        while len(ends):
            self.units.append(np.diff(ends, prepend=0))
            self.points.append(np.diff(total, prepend=0))
            up = np.flatnonzero(drawn & np.uint64(3) == 0)
            self.down.append(up)
            ends, total, drawn = ends[up], total[up], drawn[up] >> np.uint64(2)
            if len(self.units) == 31:
                break

    def before(self, rank: int) -> int:
        """Code points of the first `rank` units."""
        passed, points, at = 0, 0, -1
        for lane in range(len(self.units) - 1, -1, -1):
            units, widths = self.units[lane], self.points[lane]
            while at + 1 < len(units) and passed + units[at + 1] <= rank:
                at += 1
                passed += int(units[at])
                points += int(widths[at])
            if lane and at >= 0:
                at = int(self.down[lane - 1][at])
        return points


def line_lengths(text: str) -> np.ndarray:
    """Code points of each unit [^\\n]*\\n|[^\\n]+ of a text."""
    lengths = np.array([len(x) + 1 for x in text.split("\n")], np.int64)
    lengths[-1] -= 1
    return lengths if lengths[-1] else lengths[:-1]


def cut_places(text: str, first: int, second: int) -> tuple[int, int, int]:
    """Units of a text, and the code points before its first and its second cut."""
    lengths = line_lengths(text)
    ranks = sorted((first % (len(lengths) + 1), second % (len(lengths) + 1)))
    lanes = SkipList(lengths)
    return len(lengths), lanes.before(ranks[0]), lanes.before(ranks[1])


_ROWS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _cut(sentinels: tuple[str, str, str], rate: int, spm: int) -> Callable:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64())]
        + [("middle_chars", pa.int64()), ("output", pa.string())]
    )
    p, s, m = sentinels

    def one(text: str, draws: list[int]) -> tuple[int, str, int | None, int | None, str]:
        n, a, b = cut_places(text, draws[0], draws[1])
        if not text or any(x in text for x in sentinels) or draws[2] % 100 >= rate:
            return n, "plain", None, None, text
        if draws[3] % 100 < spm:
            return n, "spm", a, b - a, "".join((s, text[b:], p, text[:a], m, text[a:b]))
        return n, "psm", a, b - a, "".join((p, text[:a], s, text[b:], m, text[a:b]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [one(t, d) for t, d in zip(batch.column("text").to_pylist(), batch.column("draws").to_pylist())]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:])]
            yield pa.record_batch([batch.column("doc_id"), *columns], schema=schema)

    return cut


def _draws(seed: int) -> Column:
    """The first four groups of eight hex digits of the sha256 of `seed:doc_id`, as integers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def infilled(
    docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, sentinels: tuple[str, str, str] = SENTINELS
) -> DataFrame:
    """For each row of `docs`: doc_id, n (lines), form, prefix_chars, middle_chars and output, the rearranged text.

    `rate` percent of the documents are cut, `spm` percent of these with the suffix first; which, and where, is drawn
    from `seed` and doc_id alone, so reruns and rows that repeat an id agree. Texts that are empty, hold a sentinel or
    aren't drawn stay plain. NULL text is empty; a row without doc_id is drawn as the empty id; every row gives one
    row; an empty table gives an empty result. Columns other than doc_id and text aren't read. A text is held by one
    task, as any row is.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), _draws(seed).alias("draws"))
    return rows.mapInArrow(_cut(sentinels, rate, spm), _ROWS)


def restored(form: Column, output: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that `infilled` rearranged, from form and output alone.

    No text that was cut holds a sentinel, and since none begins with what another ends with, none arises at a seam.
    """
    parts = F.split(output, "|".join(re.escape(x) for x in sentinels), -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """`infilled` over all documents, with the digests of its output and of the text rebuilt from that output."""
    rows = infilled(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n, ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
         ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4
  FROM base
), cut AS (
  SELECT *, list_aggregate(list_transform(units[1:least(h1 % (n + 1), h2 % (n + 1))], lambda u: length(u)), 'sum') AS a,
         list_aggregate(list_transform(units[1:greatest(h1 % (n + 1), h2 % (n + 1))], lambda u: length(u)), 'sum') AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, n, form, text, coalesce(a, 0)::BIGINT AS a, coalesce(b, 0)::BIGINT AS b FROM cut
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
                ELSE '<S>' || substr(text, b + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, b - a) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
