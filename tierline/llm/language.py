"""Language by cross-parsing: each language has a suffix automaton of labelled text; a text is cut greedily into the
longest phrases that occur in it, and the language that needs the fewest bits of phrases for the text wins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.shared import slices, text_of

#: Languages learned at most, labelled rows of each, characters of a row (from a place drawn by its id), and bytes
#: of text in all automata together. They bound what the driver and each worker hold.
LANGUAGES, ROWS, EXCERPT, SAMPLE = 256, 96, 1_024, 256 << 10
#: Fixed value: what a text without letters is called.
UNDETERMINED = "und"
#: Symbols that are parsed in one go; a phrase ends where such a block does.
_BLOCK = 1_024
_FLAG = np.uint32(1 << 31)


def lowered(text: str) -> bytes:
    return text.lower().encode()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Automaton:
    """Suffix automaton of a byte string: from the root, the paths are exactly the strings that occur in it."""

    def __init__(self, data: bytes) -> None:
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in data:
            here = len(self.next)
            self.next.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = here
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[q] == length[p] + 1:
                    link[here] = q
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = copy
                        p = link[p]
                    link[q] = link[here] = copy
            last = here


class Parser:
    """The automata of all languages as one table of steps.

    A step from a state by a symbol leads to the next state; where the automaton has none, a phrase ends: the step
    carries a flag and leads to where the symbol leads from the root. A symbol that the sample lacks is a phrase of its
    own and leads to a last state, which has no steps. States are stored as the first entry of their row.
    """

    def __init__(self, samples: dict[str, bytes]) -> None:
        self.languages = sorted(samples)
        byte = np.arange(256)
        letter = (byte >= 0x80) | (byte >= 0x61) & (byte <= 0x7A)
        seen = np.zeros(256, bool)
        for text in samples.values():
            seen[np.unique(np.frombuffer(text, np.uint8))] = True
        # Symbol 0 is anything between words, 1 any letter that no sample has.
        self.symbol = np.where(letter, 1, 0).astype(np.uint8)
        self.symbol[letter & seen] = 2 + np.arange((letter & seen).sum())
        width = int(self.symbol.max(initial=1)) + 1
        tables, roots, base = [], [], 0
        for name in self.languages:
            states = Automaton(self.symbols(samples[name]).tobytes()).next
            table = np.full((len(states) + 1, width), _FLAG | np.uint32(base + len(states) * width), np.uint32)
            for c, to in states[0].items():
                table[:, c] = _FLAG | np.uint32(base + to * width)
            table[0] &= ~_FLAG
            of = np.repeat(np.arange(len(states)), [len(steps) for steps in states])
            by = np.fromiter((c for steps in states for c in steps), np.int64, len(of))
            to = np.fromiter((x for steps in states for x in steps.values()), np.int64, len(of))
            table[of, by] = base + to * width
            tables.append(table.ravel())
            roots.append(base)
            base += table.size
        self.steps = np.concatenate(tables) if tables else np.empty(0, np.uint32)
        self.roots = np.array(roots, np.uint32)
        # A pointer into a sample takes this many bits, however long the phrase it stands for.
        self.bits = np.array([np.log2(len(samples[x]) + 2) for x in self.languages])

    def symbols(self, data: bytes) -> np.ndarray:
        """The symbols of a text: a run of anything that is not a letter is one, and one stands at either end."""
        raw = self.symbol[np.frombuffer(b" " + data + b" ", np.uint8)]
        return raw[(raw != 0) | np.concatenate(([True], raw[:-1] != 0))]

    def phrases(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each text its symbols, and the phrases that each language needs (texts x languages).

        Blocks of texts run side by side, one symbol a step: what differs between them is the state only.
        """
        rows = [self.symbols(t) for t in texts]
        sizes = np.array([len(r) for r in rows], np.int64)
        data = np.concatenate([*rows, np.zeros(_BLOCK, np.uint8)])
        blocks = -(-sizes // _BLOCK)
        owner = np.repeat(np.arange(len(rows)), blocks)
        begin = (np.cumsum(sizes) - sizes)[owner] + (np.arange(len(owner)) - (np.cumsum(blocks) - blocks)[owner]) * _BLOCK
        size = np.minimum(np.cumsum(sizes)[owner] - begin, _BLOCK)
        order = np.argsort(-size, kind="stable")
        begin, size, owner = begin[order], size[order], owner[order]
        counts = np.zeros((len(self.languages), len(order)), np.uint32)
        state = np.repeat(self.roots[:, None], len(order), axis=1)
        alive = np.searchsorted(-size, -np.arange(1, size.max(initial=0) + 1), "right")  # blocks longer than a step
        columns = np.ascontiguousarray(data[begin[:, None] + np.arange(size.max(initial=0))].T) if len(order) else None
        for at, n in enumerate(alive):
            found = self.steps.take(state[:, :n] + columns[at, :n])
            counts[:, :n] += found >> np.uint32(31)
            np.bitwise_and(found, ~_FLAG, out=state[:, :n])
        total = np.zeros((len(rows), len(self.languages)))
        np.add.at(total, owner, counts.T + 1.0)  # the last phrase of a block ends with it
        return sizes, total

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text; see `identified`."""
        out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
        lettered = [i for i, t in enumerate(texts) if has_letter(t)]
        if not lettered or not self.languages:
            return out
        sizes, total = self.phrases([lowered(texts[i]) for i in lettered])
        cost = total * self.bits / sizes[:, None]
        for i, row in zip(lettered, cost):
            best = int(row.argmin())
            others = np.delete(row, best)
            out[i] = (self.languages[best], float(1 - row[best] / others.min()) if len(others) else 1.0)
        return out


def held_out() -> Column:
    """Whether a row is held out: crc32 of its doc_id in decimal leaves 2 when divided by 4; not without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def samples(docs: DataFrame, languages: int = LANGUAGES, rows: int = ROWS, excerpt: int = EXCERPT, total: int = SAMPLE) -> dict[str, bytes]:
    """Labelled text of each of the `languages` most frequent values of lang, from rows that are not held out.

    The documents of the smallest hash of doc_id are taken, `rows` of a language, and `excerpt` characters of each from
    a place drawn by its id. The ids are found without reading texts; only the texts of those ids are read then.
    """
    named = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out())
    drawn = F.xxhash64(F.lit("sample"), "doc_id")
    common = named.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("ids")).orderBy(F.desc("ids"), "lang").limit(languages).collect()
    if not common:
        return {}
    # About three times the wanted rows pass by their hash alone, all rows of an id alike; few languages have few rows.
    share = F.create_map(*[x for r in common for x in (F.lit(r["lang"]), F.lit(min(1.0, 3 * rows / max(r["ids"], 1))))])[F.col("lang")]
    few = named.where(F.pmod(drawn, F.lit(1 << 24)) < share * (1 << 24)).groupBy("lang", "doc_id").agg(F.min(drawn).alias("drawn"))
    few = few.selectExpr("*", "row_number() OVER (PARTITION BY lang ORDER BY drawn, doc_id) AS place").where(f"place <= {rows}")
    ids = [r["doc_id"] for r in few.select("doc_id").distinct().collect()]
    whole = F.length("text")
    place = F.pmod(F.xxhash64(F.lit("place"), "doc_id"), F.greatest(whole - excerpt + 1, F.lit(1)))
    piece = F.substring("text", place.cast("int") + 1, F.lit(excerpt))
    texts = named.where(F.col("doc_id").isin(ids)).groupBy("lang", "doc_id").agg(F.min(piece).alias("piece")).collect()
    out: dict[str, bytes] = {}
    most = total // len(common)
    wanted = {r["lang"] for r in common}
    for r in sorted(texts, key=lambda r: (r["lang"], r["doc_id"])):
        if r["lang"] in wanted and has_letter(r["piece"]):
            out[r["lang"]] = out.get(r["lang"], b"") + lowered(r["piece"]) + b" "
    return {k: v[:most].decode(errors="ignore").encode() for k, v in out.items()}


_ROWS = "doc_id long, held_out boolean, lang_pred string, score double"


def _predict(learned: dict[str, bytes]) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = None
        for batch in slices(batches, "text", 2 << 20):
            parser = parser or Parser(learned)
            found = parser.predict(batch.column("text").to_pylist())
            columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.float64()))]
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), *columns], schema=schema)

    return predict


def identified(docs: DataFrame, learned: dict[str, bytes]) -> DataFrame:
    """For each row of `docs`: doc_id, held_out, lang_pred and score.

    Whole texts are parsed, lower-cased, every run of what is not a letter taken as one symbol, in blocks of 1,024
    symbols. The cost of a language is its phrases times the bits of a pointer into its sample, by symbol of the text;
    the smallest wins, at a tie the first by name. score is 0 where the two best cost the same and comes near 1 where
    the next best needs many times the phrases; 1 if only one language is learned. NULL, empty and letterless texts are
    `und` with score 0, and all texts if nothing is learned. Every row gives one row, repeated ids and rows without
    doc_id too (these are neither held out nor learned from). lang and source aren't read here. An empty table gives an
    empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_of().alias("text"))
    return rows.mapInArrow(_predict(learned), _ROWS)


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """`identified` over all documents by what `samples` learns from those that aren't held out."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    return identified(docs, samples(docs))
