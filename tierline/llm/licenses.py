"""Fuzzy search for short licence notices: exact seeds by the pigeonhole principle, then bounded-error matching."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.shared import slices

#: Phrases whose words are looked for exactly, by label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices (words in lower case, one blank between them), the label of each, and the edits that it bears.
NOTICES = (
    ("all rights reserved", "reserved", 2),
    ("general public license", "gpl", 2),
    ("gnu lesser general public license", "lgpl", 3),
    ("licensed under the apache license", "apache", 3),
    ("under the apache license version 2 0", "apache", 3),
    ("released under the mit license", "mit", 2),
    ("permission is hereby granted free of charge", "mit", 4),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("mozilla public license", "mpl", 2),
    ("creative commons attribution", "cc-by", 2),
    ("creative commons attribution noncommercial", "cc-by-nc", 3),
    ("licensed under cc by nc", "cc-by-nc", 1),
    ("licensed under cc by sa", "cc-by-sa", 1),
    ("dedicated to the public domain", "public-domain", 2),
)

#: What is not a word: all ASCII but digits and lower-case letters; capitals are lower-cased before.
_CLEAN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def words_line(text: str) -> tuple[str, int]:
    """The words of a text, lower-cased, with a blank before, between and after them; and their number."""
    words = text.encode().translate(_CLEAN).split()
    return f" {b' '.join(words).decode()} ", len(words)


class Notice:
    """A notice of m characters and its edits k: cut into k + 1 seeds, one of which any match with k edits has whole."""

    def __init__(self, text: str, label: str, edits: int) -> None:
        self.text, self.label, self.edits = text, label, edits
        cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
        self.seeds = [(text[a:b], a) for a, b in zip(cuts, cuts[1:])]
        self.pattern = regex.compile(f"(?:{regex.escape(text)}){{e<={edits}}}", regex.BESTMATCH)

    def found(self, line: str) -> list[tuple[int, int, int]]:
        """(begin, end, edits) of the best match in each cluster of candidates, whole words only."""
        reach, places = len(self.text) + self.edits, []
        for seed, offset in self.seeds:
            at = line.find(seed)
            while at >= 0:
                places.append((max(0, at - offset - self.edits), at - offset + reach))
                at = line.find(seed, at + 1)
        out, end = [], -1
        for a, b in sorted(places):  # windows that overlap are searched once, from where the last match ended
            if b <= end:
                continue
            a = max(a, end)
            while a < b and (match := self.pattern.search(line, a, min(b, len(line)))):
                x, y = match.span()
                if x == y:
                    break
                while line[x] == " ":
                    x += 1
                while line[y - 1] == " ":
                    y -= 1
                # Whole words: a word that the match cuts is taken in or left out, whichever costs fewer edits.
                firsts = {line.rfind(" ", 0, x) + 1, line.find(" ", x) + 1 if line[x - 1] != " " else x}
                lasts = {line.find(" ", y), line.rfind(" ", 0, y) if line[y] != " " else y}
                whole = [
                    (sum(m.fuzzy_counts), first, last)
                    for first in firsts
                    for last in lasts
                    if first < last and (m := self.pattern.fullmatch(line, first, last))
                ]
                if whole:
                    edits, first, last = min(whole)
                    out.append((first, last, edits))
                end = a = max(match.end(), a + 1)
        return out


def scanned(line: str, notices: list[Notice]) -> tuple[list[tuple[int, str]], list[tuple]]:
    """Places of phrases (first word, label), and spans of notices (first word, end word, label, edits) of a text."""
    exact: list[tuple[int, str]] = []
    blanks: list[int] = []

    def before(place: int) -> int:
        """Blanks before a place; they are looked up once for a text that has any hit."""
        if not blanks:
            blanks.extend(m.start() for m in re.finditer(" ", line))
        return bisect_left(blanks, place)

    for phrase, label in PHRASES.items():
        look, at = f" {phrase} ", line.find(f" {phrase} ")
        while at >= 0:
            exact.append((before(at), label))
            at = line.find(look, at + 1)
    spans = []
    for notice in notices:
        for x, y, edits in notice.found(line):
            first = before(x) - 1
            spans.append((first, before(y), notice.label, edits, edits / notice.edits if notice.edits else 0.0))
    return exact, spans


def best_spans(spans: list[tuple]) -> list[tuple]:
    """Spans without those that one with the same label and fewer edits overlaps; longer ones come first at a tie."""
    taken: dict[str, list[tuple[int, int]]] = {}  # by label, apart from each other and in order
    out = []
    for s in sorted(spans, key=lambda s: (s[3], s[0] - s[1])):
        own = taken.setdefault(s[2], [])
        at = bisect_left(own, (s[0], s[1]))
        if (at == 0 or own[at - 1][1] <= s[0]) and (at == len(own) or s[1] <= own[at][0]):
            own.insert(at, (s[0], s[1]))
            out.append(s)
    return out


_RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<first:int,end:int,label:string,edits:int>>"
)


def _scan(notices: tuple) -> Callable:
    span = pa.struct([("first", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("edits", pa.int32())])
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
        + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Notice(*n) for n in notices]
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                line, n = words_line(text or "")
                exact, spans = scanned(line, known)
                best = best_spans(spans)
                starts = sorted(x for x, _ in exact)
                base = {label for _, label in exact}
                score = 1.0 if exact else max([1 - s[4] / 2 for s in best], default=0.0)
                rows.append(
                    (
                        doc_id, n, len(exact), starts[0] if starts else None, starts[-1] if starts else None,
                        ",".join(sorted(base)), ",".join(sorted(base | {s[2] for s in best})), score,
                        [dict(zip(("first", "end", "label", "edits"), s)) for s in sorted(best)],
                    )
                )
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return scan


def notices_in(docs: DataFrame, notices: tuple = NOTICES) -> DataFrame:
    """For each row of `docs`: counts and labels of the exact phrases, labels and spans of the notices found.

    Words are runs of ASCII letters, digits and characters beyond ASCII; A-Z count as a-z. Spans count words from 0,
    end exclusive; edits are inserted, deleted and replaced characters. score is 1 where a phrase stands exactly, else
    1 less half the share of its allowed edits that the best notice used, or 0. NULL and empty texts have no words; a row
    without doc_id is scanned too; repeated rows give repeated results. Only doc_id and text are read. Each row is
    scanned by itself, so nothing is shuffled.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return base.mapInArrow(_scan(notices), _RESULT)


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """`notices_in` over all documents, without the spans."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return notices_in(docs).drop("spans")
