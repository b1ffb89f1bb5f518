"""Records of CSV files with line breaks inside quotes, read in splits like any other text.

Whether a block of a file begins inside quotes follows from the number of quotes before it. A first pass counts them per
block; their running sum, over a row a block, tells the state in which each block begins. A second pass cuts every
block at its true record ends. What a block leaves open is joined with the following blocks' first pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a row of the second pass is: a record, or the first, a middle or the last piece of one.
WHOLE, FIRST, MIDDLE, LAST = range(4)
_PIECES = "file string, block long, kind int, header boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in the order of the file; a line belongs to the block it begins in."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def blocks_inside(lines: DataFrame) -> dict[str, frozenset[int]]:
    """The blocks of each file that begin inside quotes.

    They come to the driver and go to every task: a number for a block at most, that is some MB for 100 TB.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = "coalesce(sum(odd) OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    inside = odd.selectExpr("file", "block", f"{before} % 2 = 1 AS inside").filter("inside")
    found: dict[str, set[int]] = {}
    for r in inside.select("file", "block").toLocalIterator():
        found.setdefault(r["file"], set()).add(r["block"])
    return {file: frozenset(blocks) for file, blocks in found.items()}


def _cut(inside: dict[str, frozenset[int]], pieces: bool) -> Callable:
    """Rows for whole records, or for the pieces at the borders of blocks."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("header", pa.bool_()), ("record", pa.string())])

    class Block:
        """One block of a file, line by line."""

        def __init__(self, file: str, block: int) -> None:
            self.file, self.block = file, block
            self.open = self.head = block in inside.get(file, ())
            self.held: list[str] = []
            self.first = block == 0

        def take(self, values: pa.Array) -> list[tuple[int, bool, str]]:
            odd = pc.bit_wise_and(pc.count_substring(values, '"'), 1).to_pylist()
            out = []
            for value, flips in zip(values.to_pylist(), odd):
                self.held.append(value)
                self.open ^= bool(flips)
                if not self.open:
                    out.append(self.close(LAST if self.head else WHOLE))
                    self.head = False
            return out

        def close(self, kind: int) -> tuple[int, bool, str]:
            row = (kind, self.first, "\n".join(self.held))
            self.held, self.first = [], False
            return row

        def end(self) -> list[tuple[int, bool, str]]:
            return [self.close(MIDDLE if self.head else FIRST)] if self.held else []

    def batch_of(block: Block, rows: list[tuple[int, bool, str]]) -> Iterator[pa.RecordBatch]:
        rows = [r for r in rows if (r[0] != WHOLE) == pieces]
        if rows:
            kinds, headers, records = zip(*rows)
            n = len(rows)
            columns = [[block.file] * n, [block.block] * n, kinds, headers, records]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Block | None = None
        for batch in batches:
            # A task may read several blocks; rows of one follow each other.
            ends = pc.run_end_encode(batch.column("block")).run_ends.to_pylist()
            at = 0
            for end in ends:
                for file in dict.fromkeys(batch.column("file").slice(at, end - at).to_pylist()):
                    part = batch.slice(at, end - at)
                    part = part.filter(pc.equal(part.column("file"), file))
                    block = part.column("block")[0].as_py()
                    if now is None or (now.file, now.block) != (file, block):
                        if now is not None:
                            yield from batch_of(now, now.end())
                        now = Block(file, block)
                    yield from batch_of(now, now.take(part.column("value")))
                at = end
        if now is not None:
            yield from batch_of(now, now.end())

    return cut


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, record): the records of the CSV files at `path`, blank ones left out.

    Line ends inside quotes stay as they are; a carriage return before the line end goes. `header` marks the first
    record of a file. Quotes open and close cells and are doubled inside them; a quote that never closes makes the
    rest of its file one record. Each file is scanned three times, by as many tasks as it has splits.
    """
    lines = _lines(spark, path)
    inside = blocks_inside(lines)
    whole = lines.mapInArrow(_cut(inside, False), _PIECES).select("file", "header", "record")
    pieces = lines.mapInArrow(_cut(inside, True), _PIECES)
    # Two pieces a block at most: its first lines end a record of an earlier block, its last ones begin another.
    place = f"if(kind = {FIRST}, 1, 0)"
    numbered = pieces.selectExpr("*", f"sum({place}) OVER (PARTITION BY file ORDER BY block, {place} ROWS UNBOUNDED PRECEDING) AS number")
    listed = f"sort_array(collect_list(struct(block, {place} AS place, record)))"
    joined = numbered.groupBy("file", "number").agg(F.expr("bool_or(header) AS header"), F.expr(f"concat_ws('\n', {listed}.record) AS record"))
    records = whole.unionByName(joined.select("file", "header", "record"))
    return records.selectExpr("file", "header", r"regexp_replace(record, '\r\\z', '') AS record").filter("trim(record) <> ''")
