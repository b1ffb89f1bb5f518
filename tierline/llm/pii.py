"""Personal data: generators propose spans, boosted trees score them by format and context, calibrated thresholds choose.

Everything that touches text is an expression on columns. The trees are grown from a contingency table: the features
of a candidate are bits, so that all candidates of all documents are summed up to a bounded number of cells, and only
these counts come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.shared import settled, text_of

#: Kinds, in the order of results. The first four have fixed rules; what these find always stays.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]

#: The base patterns, leftmost and non-overlapping. They are written so that no place is tried twice: a
#: match begins where the last one ended (\G) or where a run begins, and runs are not given back where the sign that
#: must follow cannot be part of them. A run that fails from its first character fails from any other.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generous patterns, whose matches are candidates only.
_GENEROUS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?+(?:@|\(at\)|\[at\])\x20?+[A-Za-z0-9-]++(?:(?:\.|\x20?+[(\[]dot[)\]]\x20?+)[A-Za-z0-9-]++)*+",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\x20?+[.:]\x20?+[0-9]++){2,}+",
    "card": r"[0-9](?:[\x20.-]?[0-9]){11,}+",
    "phone": r"(?:\+\x20?+)?+\(?+[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+",
    "secret": r"(?:\G|(?<![A-Za-z0-9_-]))[A-Za-z0-9_-]{20,}+",
}
#: Words that stand near personal data of a kind, and ends of host names in wide use.
_NEAR = {
    "email": r"(?i)\b(?:e-?mail|contact|write|reach|reply|address)",
    "ip": r"(?i)\b(?:ip|host|server|address|gateway|router|ping|subnet|dns|client)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment)",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|fax|mobile|cell|dial|contact)\b",
    "secret": r"(?i)mail|phone|tel|call|contact|card|visa|address|server|host",
}
_HOST_ENDS = "com|org|net|edu|gov|mil|int|info|biz|io|co|us|uk|de|fr|es|it|nl|eu|ch|at|be|se|no|dk|pl|pt|br|ca|au|jp|cn|in|ru|mx"
_ASSIGNED = r"(?i)(?:token|key|secret|password|passwd|pwd)\x20?[=:]\x20?[\"']?$"
#: A sign of the usual form of a kind; one of the features.
_FORMS = {
    "email": r"(?:\.|dot[)\]]\x20?)[A-Za-z]{2,}$",
    "ip": r"^[0-9]{1,3}(?:[^0-9]+[0-9]{1,3}){3}$",
    "card": r"[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}",
    "phone": r"\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}",
    "secret": r"^[0-9a-f]{32,}$",
}
_BITS = 12
_CONTEXT = 24


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _prefix_sums(lengths: Column) -> Column:
    """Running sums, each without its own entry, in blocks so that long arrays are not copied once an entry."""
    size = 256
    zero = F.array(F.lit(0).cast("long"))
    running = lambda xs: F.aggregate(
        xs, zero, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))
    )
    blocks = lambda xs: F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size(xs), F.lit(1)) - 1) / size).cast("int")),
        lambda b: running(F.slice(xs, b * size + 1, F.lit(size))),
    )
    shifted = lambda b, by: F.transform(F.slice(b, F.lit(1), F.size(b) - 1), lambda x: x + by)
    joined = lambda bs: _let(
        running(F.transform(bs, lambda b: F.element_at(b, -1))),
        lambda totals: F.flatten(F.transform(bs, lambda b, i: shifted(b, F.get(totals, i)))),
    )
    return _let(lengths, lambda xs: _let(blocks(xs), joined))


def _matches(text: Column, pattern: str, kind: str, guard: Column) -> Column:
    """array<struct<kind, start, end, found, before, after>> of a pattern's matches; places in code points.

    Spark has no positions of matches, but the pieces between them: their lengths and the matches' add up to places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)

    def span(s: Column, at: Column, m: Column, i: Column) -> Column:
        start = F.get(at, i) + F.length(F.get(s["p"], i))
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            start.alias("start"),
            (start + F.length(m)).alias("end"),
            m.alias("found"),
            F.right(F.get(s["p"], i), F.lit(_CONTEXT)).alias("before"),
            F.left(F.get(s["p"], i + 1), F.lit(_CONTEXT)).alias("after"),
        )

    def placed(s: Column) -> Column:
        lengths = F.transform(s["m"], lambda m, i: F.length(F.get(s["p"], i)).cast("long") + F.length(m))
        return _let(_prefix_sums(lengths), lambda at: F.transform(s["m"], lambda m, i: span(s, at, m, i)))

    return F.when(guard, _let(F.struct(found.alias("m"), pieces.alias("p")), placed))


_NONE = "array<struct<kind:int,start:bigint,end:bigint,found:string,before:string,after:string>>"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(found: Column, least: int = 16) -> Column:
    digits = _digits(found)
    n = F.length(digits)
    worth = lambda i: F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + F.when(worth(i) > 9, worth(i) - 9).otherwise(worth(i)))
    return F.when(n.between(least, 19), total % 10 == 0).otherwise(F.lit(False))


def _valid(kind: str, found: Column) -> Column:
    """What a match of a base pattern must also satisfy."""
    if kind == "ip":
        return F.forall(
            F.split(found, r"\."),
            lambda x: F.coalesce(F.regexp_replace(x, "^0+(?=[0-9])", "").try_cast("int") <= 255, F.lit(False)),
        )
    if kind == "card":
        return _luhn(found)
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    return F.lit(True)


def _label(kind: str, c: Column) -> Column:
    """Whether there is evidence, beyond the base patterns, that a candidate is what its kind says. The trees learn from it.

    Email: what is left without disguise is a host name of proper labels with an end in wide use. IP: four octets
    without leading zeros, and a word about networks nearby. Card: 13 to 19 digits of a known issuer's range that pass Luhn.
    Phone: an area and exchange of the North American plan or a country code, and a word about calls nearby or the
    area in brackets. Secret: a value assigned to a name for secrets.
    """
    found, near = c["found"], c["before"].rlike(_NEAR[kind]) | c["after"].rlike(_NEAR[kind])
    if kind == "secret":
        return c["before"].rlike(_ASSIGNED)
    if kind == "email":
        plain = F.regexp_replace(F.regexp_replace(F.lower(found), r"\x20?[(\[]at[)\]]\x20?", "@"), r"\x20?[(\[]dot[)\]]\x20?", ".")
        return F.replace(plain, F.lit(" "), F.lit("")).rlike(
            rf"^[a-z0-9][a-z0-9._%+-]*+@(?:[a-z0-9]++(?:-++[a-z0-9]++)*+\.)*?[a-z0-9]++(?:-++[a-z0-9]++)*+\.(?:{_HOST_ENDS})$"
        )
    if kind == "ip":
        return found.rlike(r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:[\x20.:]+|$)){4}$") & near
    if kind == "card":
        return _digits(found).rlike("^(?:3[47]|4|5[1-5]|2[2-7]|6)") & _luhn(found, 13)
    digits = F.regexp_replace(_digits(found), "^1(?=[0-9]{10}$)", "")
    area = digits.rlike("^[2-9][0-9]{2}[2-9][0-9]{6}$")
    abroad = found.startswith("+") & digits.rlike("^[1-9][0-9]{7,14}$")
    return (area | abroad) & (near | found.rlike(r"\([2-9][0-9]{2}\)"))


def _cell(kind: str, c: Column) -> Column:
    """The features of a candidate as bits of one number."""
    found, before, after = c["found"], c["before"], c["after"]
    n = F.length(_digits(found))
    bits = (
        n >= 10,
        n >= 16,
        found.contains("."),
        found.rlike(r"[\x20-]"),
        found.rlike(r"[(+]"),
        found.rlike("[A-Za-z]"),
        found.contains("@"),
        F.length(found) >= 30,
        before.rlike(r"[\"'=:(]\x20?$"),
        before.rlike(_NEAR[kind]) | after.rlike(_NEAR[kind]),
        after.rlike("^[0-9A-Za-z]"),
        found.rlike(_FORMS[kind]),
    )
    return sum((F.when(b, 1 << i).otherwise(0) for i, b in enumerate(bits)), F.lit(0)).cast("int")


def proposed(docs: DataFrame) -> DataFrame:
    """`docs` with p_base (spans by the fixed rules) and p_more (candidates: kind, start, end, cell, label)."""
    digits, signs = F.col("p_text").rlike("[0-9]"), F.col("p_text").rlike(r"@|[(\[]at[)\]]")
    out = docs.withColumn("p_text", text_of()).withColumns({"p_digits": digits, "p_signs": signs})
    guards = {k: F.col("p_signs" if k == "email" else "p_digits") for k in KINDS}
    none = F.array().cast(_NONE)
    out = out.withColumns({f"p_{k}": F.coalesce(_matches(F.col("p_text"), _PATTERNS[k], k, guards[k]), none) for k in BASE})
    out = out.withColumns({f"p_more_{k}": F.coalesce(_matches(F.col("p_text"), _GENEROUS[k], k, guards[k]), none) for k in KINDS})
    place = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    passing = lambda k: F.filter(f"p_{k}", lambda c: _valid(k, c["found"]))
    base = F.concat(*[F.transform(passing(k), place) for k in BASE])
    out = out.withColumn("p_base", base)
    alone = lambda c: ~F.exists("p_base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    described = lambda k: F.transform(
        f"p_more_{k}",
        lambda c: F.struct(
            c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), _cell(k, c).alias("cell"),
            _label(k, c).alias("label"), alone(c).alias("alone"),
        ),
    )
    more = F.concat(*[described(k) for k in KINDS])
    return out.withColumn("p_more", more).drop("p_text", "p_digits", "p_signs", *[f"p_{k}" for k in BASE], *[f"p_more_{k}" for k in KINDS])


@dataclass
class Tree:
    """A split on a bit, or a leaf's value."""

    bit: int = -1
    value: float = 0.0
    parts: list[Tree] = field(default_factory=list)

    def at(self, cell: int) -> float:
        return self.value if self.bit < 0 else self.parts[cell >> self.bit & 1].at(cell)


def _grown(cells: list[tuple[int, float, float]], depth: int, ridge: float = 1.0) -> Tree:
    """cells: (cell, gradient, curvature). Splits where the penalised second-order gain is largest."""
    g, h = sum(c[1] for c in cells), sum(c[2] for c in cells)
    leaf = Tree(value=g / (h + ridge))
    if not depth:
        return leaf
    best, best_bit = 1e-6, -1
    for bit in range(_BITS):
        g1, h1 = sum(c[1] for c in cells if c[0] >> bit & 1), sum(c[2] for c in cells if c[0] >> bit & 1)
        gain = g1**2 / (h1 + ridge) + (g - g1) ** 2 / (h - h1 + ridge) - g**2 / (h + ridge)
        if gain > best:
            best, best_bit = gain, bit
    if best_bit < 0:
        return leaf
    parts = [_grown([c for c in cells if (c[0] >> best_bit & 1) == side], depth - 1, ridge) for side in (0, 1)]
    return Tree(best_bit, 0.0, parts)


def boosted(counts: dict[int, tuple[int, int]], rounds: int = 30, depth: int = 3, rate: float = 0.3) -> Callable[[int], float]:
    """Probability by cell, from (negative, positive) counts by cell, by gradient boosting of the logistic loss."""
    bad, good = (sum(c[k] for c in counts.values()) for k in (0, 1))
    start = math.log((good + 0.5) / (bad + 0.5))
    trees: list[Tree] = []
    score = dict.fromkeys(counts, start)
    for _ in range(rounds):
        rows = []
        for cell, (b, a) in counts.items():
            p = 1 / (1 + math.exp(-score[cell]))
            rows.append((cell, a - (a + b) * p, (a + b) * p * (1 - p)))
        tree = _grown(rows, depth)
        trees.append(tree)
        for cell in score:
            score[cell] += rate * tree.at(cell)
    return lambda cell: 1 / (1 + math.exp(-start - rate * sum(t.at(cell) for t in trees)))


def calibrated(model: Callable[[int], float], held: dict[int, tuple[int, int]], precision: float) -> float:
    """The least threshold from which on the held-out candidates are right with `precision`, on all that reach it.

    Two imagined errors are added to each count, so that a few lucky cells don't pass; what is more likely wrong than
    right never does.
    """
    rows = sorted(((model(c), b, a) for c, (b, a) in held.items()), reverse=True)
    good = bad = 0
    threshold = math.inf
    for i, (p, b, a) in enumerate(rows):
        good, bad = good + a, bad + b
        if (i + 1 == len(rows) or rows[i + 1][0] < p) and good >= precision * (good + bad + 2) and p >= 0.5:
            threshold = p
    return threshold


def learned(candidates: DataFrame, precision: float = 0.9) -> dict[str, list[int]]:
    """The cells that are redacted, by kind. `candidates` has doc_id, p_base and p_more; all its rows are counted.

    Trees learn from all candidates. Thresholds are set on those that no base span overlaps, as only these are chosen;
    but a card that passes Luhn mostly is a base span, so cards are judged by all.
    """
    rows = candidates.select(F.pmod(F.xxhash64("doc_id", "p_base"), F.lit(2)).alias("half"), F.explode("p_more").alias("c"))
    number = lambda when: F.sum(F.when(when, 1).otherwise(0))
    label, alone = F.col("c.label"), F.col("c.alone")
    counts = rows.groupBy("half", "c.kind", "c.cell").agg(
        number(~label).alias("bad"), number(label).alias("good"), number(~label & alone).alias("bad_more"), number(label & alone).alias("good_more")
    )
    table: dict[tuple[int, int], dict[int, tuple[int, ...]]] = {}
    for half, kind, cell, *seen in counts.collect():  # two halves of 5 kinds of 4,096 cells at most
        table.setdefault((kind, half), {})[cell] = tuple(seen)
    chosen: dict[str, list[int]] = {}
    for k, name in enumerate(KINDS):
        train, held = table.get((k, 0), {}), table.get((k, 1), {})
        if sum(c[1] for c in train.values()) and held:
            model = boosted({c: x[:2] for c, x in train.items()})
            judged = {c: x[:2] if name == "card" else x[2:] for c, x in held.items()}
            least = calibrated(model, judged, precision)
            chosen[name] = sorted(c for c in train.keys() | held.keys() if model(c) >= least)
    return chosen


def found(candidates: DataFrame, chosen: dict[str, list[int]]) -> DataFrame:
    """`candidates` with p_spans: base spans and chosen candidates that no base span overlaps, in order.

    Of candidates that overlap each other the longest stays, of equally long ones that of the first kind.
    """
    wanted = lambda c: F.array_contains(
        F.get(F.array(*[F.array(*map(F.lit, chosen.get(k, []))).cast("array<int>") for k in KINDS]), c["kind"]), c["cell"]
    )
    place = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    more = F.transform(F.filter("p_more", lambda c: c["alone"] & wanted(c)), place)
    out = candidates.withColumn("p_chosen", more)
    rank = lambda c: F.struct(c["start"] - c["end"], c["kind"])
    first = lambda c: ~F.exists(
        "p_chosen", lambda d: (rank(d) < rank(c)) & (d["start"] < c["end"]) & (c["start"] < d["end"])
    )
    return out.withColumn("p_spans", F.array_sort(F.concat("p_base", F.filter("p_chosen", first)))).drop("p_chosen")


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def detected(docs: DataFrame, precision: float = 0.9) -> DataFrame:
    """For each row of `docs`: doc_id, p_base and p_spans, arrays of (kind, start, end) in code points.

    The trees learn from one half of the documents, by a hash of id and base spans, and thresholds are set on the other: the
    least at which there is evidence (see _label) for `precision` of the held-out candidates. Where a kind has no such
    candidates, its base spans are all that is found. NULL and empty texts have no spans; a row without doc_id is read
    too; repeated rows get repeated results. Columns doc_id and text are read. An empty table gives an empty result.
    """
    candidates = settled(proposed(docs.select("doc_id", "text")).drop("text"))
    return found(candidates, learned(candidates, precision))


def redacted(docs: DataFrame, precision: float = 0.9) -> DataFrame:
    """`docs` with each span of the text replaced by its kind, as in [EMAIL], and n_chars set anew.

    NULL and empty texts stay as they are, repeated rows are redacted alike, an empty table gives an empty result.
    """
    candidates = settled(proposed(docs.select("doc_id", "text")).select("doc_id", "p_base", "p_more"))
    rows = found(proposed(docs.select("text", F.struct("*").alias("p_row"))), learned(candidates, precision))
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    text = F.aggregate(
        F.array_sort(F.transform("p_spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("far"), s["end"].alias("end"), s["kind"].alias("kind")))),
        start,
        lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(
            F.struct(
                F.concat(
                    a["out"],
                    F.substring("text", (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int")),
                    F.get(marks, s["kind"]),
                ).alias("out"),
                s["end"].alias("at"),
            )
        ),
        lambda a: F.concat(a["out"], F.substring("text", (a["at"] + 1).cast("int"), F.length("text"))),
    )
    rows = rows.withColumn("text", F.when(F.size("p_spans") > 0, text).otherwise(F.col("text")))
    kind = dict(docs.dtypes).get("n_chars", "long")
    new = {"text": F.col("text"), "n_chars": F.when(F.col("text").isNotNull(), F.char_length("text")).cast(kind)}
    return rows.select(*[new.get(c, F.col("p_row")[c]).alias(c) for c in docs.columns])


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    """`detected` over all documents, as counts, a digest of the base spans and a list of all spans."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    number = lambda k: F.size(F.filter("p_base", lambda s: s["kind"] == k)).cast("long")
    return detected(docs).select(
        "doc_id",
        *[number(k).alias(f"n_{name}") for k, name in enumerate(BASE)],
        F.sha2(_listed(F.array_sort("p_base")), 256).alias("base_sha256"),
        _listed(F.col("p_spans")).alias("spans"),
    )
