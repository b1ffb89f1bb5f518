"""Self-join of documents on the Jaccard similarity of their word shingles, by chosen paths.

Documents of equal text are one class. Each class has a signature of min-hashes, the embedding in which sampled
shared tokens are coordinates with equal values. A run starts with all classes in one node; a node samples
coordinates, and its members go to one child for each sampled coordinate, by their value there. Small nodes are
compared by brute force; large ones are split on, unless half of a node agrees on a sampled coordinate, for such
nodes are full of similar sets and splitting cannot part them: they are compared in blocks. Runs are repeated until
a pair at the threshold is met with the target recall.

A pair meets in several nodes and is compared in the first of them, by node id, alone. So links are counted once,
and a text is sent to the nodes where it has something to compare.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.shared import (
    column_bytes,
    settled,
    slices,
    space_flags,
    splitmix,
    window_hashes,
    word_bounds,
    word_hashes,
)

_SPACE = space_flags()
#: Coordinates of a signature, and how many a node samples.
_COORDINATES, _SAMPLED = 64, 2
#: Members of a node up to which it is compared without another split.
_SMALL = 256
#: Classes of a node that one task looks at as ids, and as texts (shingles at most).
_IDS, _TEXTS, _SHINGLES = 32_768, 4_096, 4_000_000
_DEPTH = 4


def shingles_of(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of every text, and where each text's begin. Shorter texts are one shingle."""
    data, starts = column_bytes(texts)
    begin, end = word_bounds(data, _SPACE)
    first = np.searchsorted(begin, starts)
    words = word_hashes(data, begin, end)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    hashes = window_hashes(words, size)
    inside = doc[: len(hashes)] == doc[size - 1 :] if len(hashes) else np.empty(0, bool)
    hashes, owner = hashes[inside], doc[: len(hashes)][inside]
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < size))
    if len(short):
        own = np.array([window_hashes(words[first[d] : first[d + 1]], first[d + 1] - first[d])[0] for d in short], np.uint64)
        at = np.searchsorted(owner, short)
        hashes, owner = np.insert(hashes, at, own), np.insert(owner, at, short)
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1))


def _multipliers(seed: int) -> np.ndarray:
    return splitmix(np.arange(1, _COORDINATES + 1, dtype=np.uint64) + np.uint64(seed << 8)) | np.uint64(1)


def _text_id() -> Column:
    """128 bits of a hash of the text: of 10^12 texts two share them with a chance of 10^-15."""
    return F.unhex(F.md5("text"))


def _signed(size: int, seed: int) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("sig", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = _multipliers(seed)
        for batch in slices(batches, "text"):
            hashes, first = shingles_of(batch.column("text"), size)
            n = np.diff(first)
            full = np.flatnonzero(n)
            sig = np.zeros((len(full), _COORDINATES), np.int64)
            with np.errstate(over="ignore"):
                for i in range(_COORDINATES if len(full) else 0):
                    sig[:, i] = np.minimum.reduceat((hashes * odd[i]) >> np.uint64(32), first[:-1][full])
            own = batch.take(pa.array(full))
            offsets = np.arange(len(full) + 1, dtype=np.int32) * _COORDINATES
            yield pa.record_batch(
                [
                    own.column("doc_id"),
                    own.column("digest"),
                    pa.array(n[full]),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig.ravel())),
                ],
                schema=schema,
            )

    return sign


def runs_needed(threshold: float, recall: float, depth: int) -> int:
    """Runs until a pair of just this similarity is missed by all of them with a chance of 1 - recall at most.

    The pair agrees on a binomial number of coordinates; with a share x of them, a node passes it on to a child unless
    every sampled coordinate differs, which is followed down to the given depth.
    """
    shares = [i / _COORDINATES for i in range(_COORDINATES + 1)]
    chance = [math.comb(_COORDINATES, i) * threshold**i * (1 - threshold) ** (_COORDINATES - i) for i in range(len(shares))]
    found = []
    for x in shares:
        q = 1.0
        for _ in range(depth):
            q = 1 - (1 - x * q) ** _SAMPLED
        found.append(q)
    runs = 1
    while sum(p * (1 - q) ** runs for p, q in zip(chance, found)) > 1 - recall:
        runs += 1
    return runs


def _child(node: Column, seed: int, k: int) -> Column:
    """The coordinate that a node samples as its k-th, the members' value there, and so the child."""
    at = F.pmod(F.xxhash64(node, F.lit(seed), F.lit(k)), F.lit(_COORDINATES)).cast("int")
    return F.xxhash64(node, at, F.get("sig", at))


def _leaves(classes: DataFrame, threshold: float, recall: float, seed: int) -> DataFrame:
    """(leaf, cid, size): the nodes to be compared and their members; `size` is the number of members."""
    runs = runs_needed(threshold, recall, _DEPTH)
    roots = [F.xxhash64(F.lit(seed), F.lit(r)) for r in range(runs)]
    at = classes.select("cid", F.explode(F.array_distinct(F.array(*[_child(x, seed, k) for x in roots for k in range(_SAMPLED)]))).alias("node"))
    done, depth = None, 1
    while True:
        at = settled(at)
        sizes = at.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        # Written, so that what reads the nodes below has no joins of earlier depths in its plan.
        at = settled(at.join(sizes, "node"))
        small = at.where(F.col("size") <= _SMALL).select(F.col("node").alias("leaf"), "cid", "size")
        done = small if done is None else done.unionByName(small)
        large = settled(at.where(F.col("size") > _SMALL).join(classes.select("cid", "sig"), "cid"))
        if large.isEmpty():
            return settled(done)
        # What share of a node the most frequent value of a sampled coordinate has.
        value = _child(F.col("node"), seed + 1, 0)
        dense = (
            large.groupBy("node", "size", value.alias("value"))
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("node", "size")
            .agg(F.max("n").alias("most"))
            .where((F.col("most") * 2 >= F.col("size")) | F.lit(depth >= _DEPTH))
            .select("node")
        )
        dense = settled(dense)
        done = done.unionByName(settled(large.join(dense, "node").select(F.col("node").alias("leaf"), "cid", "size")))
        at = large.join(dense, "node", "left_anti").select(
            "cid", F.explode(F.array_distinct(F.array(*[_child(F.col("node"), seed, k) for k in range(_SAMPLED)]))).alias("node")
        )
        depth += 1


def _cells(rows: DataFrame, blocks: Column, salt: str) -> DataFrame:
    """Members of a large node in blocks by hash; a row goes to the cells (i, j), i <= j, that hold its block."""
    own = F.pmod(F.xxhash64("cid", F.lit(salt)), F.col("blocks")).cast("int")
    cell = F.transform(
        F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")), lambda j: F.struct(F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j"))
    )
    return (
        rows.withColumn("blocks", blocks.cast("long"))
        .withColumn("own", own)
        .withColumn("cell", F.explode(cell))
        .select("*", "cell.i", "cell.j")
        .drop("cell", "blocks")
    )


class _Members:
    """The rows of one cell with the node ids of each; says which pairs are compared here."""

    def __init__(self, leaf: int, table: pa.Table) -> None:
        self.leaf = leaf
        self.cid = table["cid"].to_numpy()
        self.own = table["own"].to_numpy()
        self.crossed = len(np.unique(self.own)) > 1 or table["i"][0].as_py() != table["j"][0].as_py()
        nodes = table["nodes"].combine_chunks()
        lengths = np.diff(nodes.offsets.to_numpy())
        values = nodes.flatten().to_numpy()
        rows = np.repeat(np.arange(len(lengths)), lengths)
        earlier = values < leaf
        ids, at = np.unique(values[earlier], return_inverse=True)
        self.seen = np.zeros((len(lengths), len(ids)), np.float32)
        self.seen[rows[earlier], at] = 1
        self.seen = self.seen[:, self.seen.sum(0) > 1]

    def open_pairs(self, a: slice, b: slice) -> np.ndarray:
        """Flags of the pairs of rows a x b that meet in no earlier node; each pair of the cell in one order only."""
        fresh = (self.seen[a] @ self.seen[b].T) == 0 if self.seen.shape[1] else np.ones((len(self.cid[a]), len(self.cid[b])), bool)
        fresh &= self.cid[a][:, None] < self.cid[b][None, :]
        if self.crossed:
            fresh &= self.own[a][:, None] != self.own[b][None, :]
        return fresh


def _involved(key: tuple, table: pa.Table) -> pa.Table:
    members = _Members(key[0].as_py(), table)
    n, step = len(members.cid), 2_048
    used = np.zeros(n, bool)
    for a in range(0, n, step):
        for b in range(0, n, step):
            fresh = members.open_pairs(slice(a, a + step), slice(b, b + step))
            used[a : a + step] |= fresh.any(1)
            used[b : b + step] |= fresh.any(0)
    return pa.table({"leaf": pa.array(np.full(int(used.sum()), members.leaf)), "cid": pa.array(members.cid[used])})


def _intersections(tokens: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets of the pairs (a, b); tokens are sorted and distinct."""
    rows = np.repeat(np.arange(len(tokens)), [len(x) for x in tokens])
    _, at, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    shared = count[at] > 1
    rows, at = rows[shared], np.unique(at[shared], return_inverse=True)[1]
    m = int(at.max()) + 1 if len(at) else 0
    n = len(tokens)
    if m * n * n > len(a) * 600_000:  # few pairs among many: one by one
        return np.array([len(np.intersect1d(tokens[x], tokens[y], assume_unique=True)) for x, y in zip(a, b)], np.int64)
    total = np.zeros((n, n), np.float32)
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    for first in range(0, m, 1_024):
        x, y = np.searchsorted(at, (first, first + 1_024))
        part = np.zeros((n, 1_024), np.float32)
        part[rows[x:y], at[x:y] - first] = 1
        total += part @ part.T
    return total[a, b].astype(np.int64)


def _compared(size: int, threshold: float) -> Callable:
    schema = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.sort(np.unique(table["cid"].to_numpy(), return_index=True)[1])))  # rows that repeat id and text
        members = _Members(key[0].as_py(), table)
        a, b = np.nonzero(members.open_pairs(slice(None), slice(None)))
        hashes, first = shingles_of(table["text"], size)
        tokens = [np.unique(hashes[x:y]) for x, y in zip(first, first[1:])]
        if not len(a):
            return schema.empty_table()
        n = np.array([len(x) for x in tokens])
        # Sets of sizes too far apart cannot be similar.
        near = np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b]) - 1e-9
        a, b = a[near], b[near]
        if not len(a):
            return schema.empty_table()
        both = _intersections(tokens, a, b)
        alike = both >= threshold * (n[a] + n[b] - both) - 1e-9
        a, b = a[alike], b[alike]
        copies = table["copies"].to_numpy()
        links = np.bincount(a, copies[b], len(tokens)) + np.bincount(b, copies[a], len(tokens))
        root = np.arange(len(tokens))
        order = np.argsort(members.cid, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        label = rank.copy()
        while len(a):  # the smallest member of each component within the cell
            before = label.copy()
            np.minimum.at(label, a, label[b])
            np.minimum.at(label, b, label[a])
            label = label[order[label]]
            if (before == label).all():
                break
        root = members.cid[order[label]]
        some = np.flatnonzero(links)
        return pa.table(
            [pa.array(members.cid[some]), pa.array(links[some].astype(np.int64)), pa.array(root[some])], schema=schema
        )

    return compare


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes of the edges (a, b): root is the smallest node of the component.

    Alternates two steps until nothing changes: larger neighbours move to the smallest one, then smaller ones do.
    Each step sums up a node's neighbours to their minimum first; a hot node's rows meet in joins alone.
    """

    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"))

    both = lambda e: e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    edges = settled(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        e = both(edges)
        low = least(e).withColumn("m", F.least("u", "m"))
        large = e.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = settled(large)
        low = least(large)
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
        edges = settled(small.where("a <> b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def _has_word() -> Column:
    """Whether the text has a word; NULL has none."""
    return F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def _linked(named: DataFrame, threshold: float, size: int, recall: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest) of every row of `named`, whose texts have words, and (cid, digest, rep, copies, links, root) of every class.

    rep is the smallest doc_id of the rows of equal text, NULL where none has one; root names the component.
    """
    signed = named.select("doc_id", "text", _text_id().alias("digest")).mapInArrow(
        _signed(size, seed), "doc_id long, digest binary, n long, sig array<long>"
    )
    signed = settled(signed)
    # A class is its text's hash; written with a number for each, which the joins below carry instead.
    classes = settled(
        signed.groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"), F.max("sig").alias("sig"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    leaves = _leaves(classes, threshold, recall, seed)
    nodes = leaves.groupBy("cid").agg(F.sort_array(F.collect_set("leaf")).alias("nodes"))
    ids = _cells(leaves.join(nodes, "cid"), F.ceil(F.col("size") / _IDS), "ids")
    kept = settled(ids.groupBy("leaf", "i", "j").applyInArrow(_involved, "leaf long, cid long").distinct())
    sizes = kept.join(classes.select("cid", "n"), "cid").groupBy("leaf").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles")
    )
    blocks = F.ceil(F.greatest(F.col("members") / _TEXTS, F.col("shingles") / _SHINGLES))
    wanted = classes.join(kept.select("cid").distinct(), "cid", "left_semi").select("cid", "rep", "digest", "copies")
    # A class with ids gives its text from the row of its smallest; one without, from its rows, which are made one.
    source = named.select("doc_id", "text", _text_id().alias("own"))
    with_id = source.where("doc_id IS NOT NULL").join(wanted, (F.col("doc_id") == F.col("rep")) & (F.col("own") == F.col("digest")))
    without = wanted.where("rep IS NULL")
    texts = with_id.select("cid", "text", "copies")
    if not without.isEmpty():
        alone = source.where("doc_id IS NULL").join(without, F.col("own") == F.col("digest"))
        texts = texts.unionByName(alone.groupBy("cid", "copies").agg(F.min("text").alias("text")).select("cid", "text", "copies"))
    cells = _cells(kept.join(sizes, "leaf").join(nodes, "cid"), blocks, "texts").join(texts, "cid")
    found = settled(
        cells.groupBy("leaf", "i", "j").applyInArrow(_compared(size, threshold), "cid long, links long, root long")
    )
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    classed = (
        classes.select("cid", "digest", "rep", "copies")
        .join(links, "cid", "left")
        .join(roots.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("root", F.coalesce("root", "cid"))
    )
    return signed.select("doc_id", "digest"), classed


def _classed(named: DataFrame, threshold: float, size: int, recall: float, seed: int) -> DataFrame:
    """(doc_id, digest, rep, copies, links, root, class_id): every row of `named`, whose texts have words, with its class.

    rep is the smallest doc_id of the rows of equal text, class_id that of the component, which root names. Rows
    without doc_id are members as others are, but name neither; rep and class_id are NULL where no member has one.
    """
    rows, classed = _linked(named, threshold, size, recall, seed)
    smallest = classed.groupBy("root").agg(F.min("rep").alias("class_id"))
    return rows.join(classed.join(smallest, "root"), "digest")


def join(docs: DataFrame, threshold: float = 0.8, size: int = 5, recall: float = 0.9999, seed: int = 17) -> DataFrame:
    """For each row of `docs`: doc_id, rep, class_id, n_copies, n_links.

    rep is the smallest doc_id of the rows of equal text, n_copies their number, class_id the smallest doc_id of the
    component of linked rows, and n_links the number of other rows whose shingle sets have a Jaccard similarity of
    `threshold` or more, copies included. A text of fewer than `size` words is one shingle. Texts without a word, NULL
    among them, have no set and no links: each row is a class of its own, and so is a row without doc_id, whose class_id
    is NULL. Rows that repeat a doc_id count as rows, each by its own text. Other columns are not read. An empty table
    gives an empty result.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    linked = F.col("doc_id").isNotNull() & _has_word()
    grouped = _classed(base.where(linked), threshold, size, recall, seed)
    return grouped.select(
        "doc_id",
        "rep",
        "class_id",
        F.col("copies").alias("n_copies"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
    ).unionByName(
        base.where(~linked).select(
            "doc_id",
            F.col("doc_id").alias("rep"),
            F.col("doc_id").alias("class_id"),
            F.lit(1).cast("long").alias("n_copies"),
            F.lit(0).cast("long").alias("n_links"),
        )
    )


def one_of_each(docs: DataFrame, **how: float) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of their class; one row of those that repeat it.

    Rows without doc_id stay: see one_text_of_each. Columns as in `docs`.
    """
    first = join(docs, **how).where("doc_id = class_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where(F.col("doc_id").isNull())).select(*docs.columns)


def one_text_of_each(
    docs: DataFrame, threshold: float = 0.8, size: int = 5, recall: float = 0.9999, seed: int = 17
) -> DataFrame:
    """One row of each group of linked texts; columns as in `docs`.

    It is the row of the smallest doc_id, at a tie of the smallest hash of its text; rows without doc_id come last, but
    are members of groups as others are. Rows of equal id and text are one, and so are wordless rows (NULL and empty
    texts) of equal id; those without id all stay.
    """
    key, digest = "o_doc", "o_digest"
    while {key, digest} & set(docs.columns):
        key, digest = f"{key}_", f"{digest}_"
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(_has_word())
    # A class gives the row of its smallest id, one of those without id where it has no other.
    member = F.struct(F.col("rep").isNull().alias("last"), F.col("rep").alias("doc_id"), "digest")
    first = _linked(base, threshold, size, recall, seed)[1].groupBy("root").agg(F.min(member).alias("first"))
    first = first.select(F.col("first.doc_id").alias(key), F.col("first.digest").alias(digest))
    own = F.col("doc_id").cast("long")
    rows = docs.where(_has_word())
    kept = rows.join(first, _text_id().eqNullSafe(F.col(digest)) & own.eqNullSafe(F.col(key)))
    # A group's first row may stand in the table more than once.
    kept = kept.dropDuplicates([key, digest]).select(*docs.columns)
    wordless = docs.where(~_has_word())
    once = wordless.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    return kept.unionByName(once).unionByName(wordless.where("doc_id IS NULL"))


def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """`join` over all documents: shingles of five words, a similarity of 0.8."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return join(docs)
