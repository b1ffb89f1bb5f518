"""Value-level statistics of text columns, and describe/histogram of numeric ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from fractions import Fraction
from math import ceil, floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.exact import half_up
from tierline.functions.kinds import kind_bits
from tierline.operators.measures import add, aggregate, same


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(columna, valor, n): how often each value, NULL included, occurs in each text column.

    One scan and one shuffle for all columns. Counts are combined before the shuffle, so a value
    that fills a third of the rows travels as one row per task. A column that is alone is counted by its values only.
    """
    if len(columns) == 1:
        return aggregate(df, {"valor": f"`{columns[0]}`"}, {"n": "count(*)"}).selectExpr(f"'{columns[0]}' AS columna", "valor", "n")
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) AS (columna, valor)")
    return aggregate(long, same("columna", "valor"), {"n": "count(*)"})


def first_values(counts: DataFrame, k: int = 10) -> DataFrame:
    """(columna, ejemplos): the first k values of each column in text order, joined by ', '.

    Ranking keeps k rows per column before the shuffle, so nothing unbounded is collected.
    """
    # NULLs rank last and are dropped after it, so that the counts can be shared with other uses of them.
    ranked = add(counts, {"_rank": "row_number() OVER (PARTITION BY columna ORDER BY valor NULLS LAST)"})
    listed = "sort_array(collect_list(struct(_rank, valor))).valor"
    return aggregate(ranked.filter(f"_rank <= {k} AND valor IS NOT NULL"), same("columna"), {"ejemplos": f"concat_ws(', ', {listed})"})


def type_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(columna, bits, n): how many values of each text column are accepted by the same types (see kind_bits).

    bits is NULL for values that are NULL or blank. A task sends at most 2**len(KINDS) + 1 rows a column, whatever the
    number of distinct values; what merges them is a sum.
    """
    pairs = ", ".join(f"'{c}', nullif(trim(`{c}`), '')" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) AS (columna, _text)")
    bits = f"if(_text IS NULL, NULL, {kind_bits('_text')})"
    return aggregate(long, {"columna": "columna", "bits": bits}, {"n": "count(*)"})


def row_text(columns: list[str]) -> str:
    """SQL of a row as 'column=value, ...'; NULL is written out."""
    return "concat_ws(', ', " + ", ".join(f"concat('{c}=', coalesce(cast(`{c}` AS string), 'NULL'))" for c in columns) + ")"


def first_violations(df: DataFrame, conditions: Mapping[str, str], key: str, columns: list[str], k: int) -> DataFrame:
    """(codigo, posicion, clave, fila): for each condition the first k rows that meet it, by key and row text.

    One scan serves all conditions. The ranks keep k rows a condition and task before the one shuffle, so a
    condition that a third of all rows meet sends no more than another.
    """
    codes = ", ".join(f"if({sql}, '{code}', NULL)" for code, sql in conditions.items())
    met = add(df, {"_codes": f"array_compact(array({codes}))"}).filter("size(_codes) > 0")
    each = met.selectExpr("explode(_codes) AS codigo", f"cast(`{key}` AS string) AS clave", f"{row_text(columns)} AS fila")
    rank = "row_number() OVER (PARTITION BY codigo ORDER BY clave NULLS LAST, fila)"
    return add(each, {"_rank": rank}).filter(f"_rank <= {k}").selectExpr("codigo", "cast(_rank AS bigint) AS posicion", "clave", "fila")


def table_profile(df: DataFrame) -> DataFrame:
    """One row (filas, nulos_totales, duplicados): rows, NULLs, and rows beyond the first of each set of equal rows.

    Equal rows are counted before the one shuffle; rows and NULLs are the same groups, weighed by their counts.
    """
    groups = aggregate(df, same(*df.columns), {"_n": "count(*)"})
    nulls = " + ".join(f"if(`{c}` IS NULL, 1, 0)" for c in df.columns)
    return aggregate(
        groups,
        {},
        {
            "filas": "coalesce(sum(_n), 0)",
            "nulos_totales": f"coalesce(sum(_n * ({nulls})), 0)",
            "duplicados": "coalesce(sum(_n - 1), 0)",
        },
    )


def exact_quantiles(df: DataFrame, units: str, fractions: Sequence[float], rows: int, low: int, high: int, bins: int = 1 << 12) -> list[Fraction | None]:
    """Quantiles of whole numbers (SQL `units`; NULLs don't count), interpolated between neighbouring ranks, exact.

    `rows`, `low` and `high` are the number of values and their range. Each round counts the values of every interval
    that a wanted rank still lies in by `bins` bins of it, and goes on with the bin that holds the rank; a bin one
    unit wide is the value. So a round sends at most bins x ranks counts, whatever the number of distinct values, and
    2**63 units need six rounds.
    """
    if not rows:
        return [None] * len(fractions)
    spots = [Fraction(f).limit_denominator(10**9) * (rows - 1) for f in fractions]
    # rank -> first and last unit of the interval that holds it, and how many values lie before the interval
    held = {rank: (low, high, 0) for spot in spots for rank in {floor(spot), ceil(spot)}}
    while any(a < b for a, b, _ in held.values()):
        intervals = sorted({(a, b) for a, b, _ in held.values() if a < b})
        width = {(a, b): -(-(b - a + 1) // bins) for a, b in intervals}
        found = " ".join(f"WHEN _u BETWEEN {a}L AND {b}L THEN struct({i} AS at, (_u - {a}L) div {width[a, b]}L AS bin)" for i, (a, b) in enumerate(intervals))
        spread = df.selectExpr(f"cast({units} AS bigint) AS _u").selectExpr(f"CASE {found} END AS spot").filter("spot IS NOT NULL")
        counts: dict[int, list[tuple[int, int]]] = {}
        for r in aggregate(spread, {"at": "spot.at", "bin": "spot.bin"}, {"n": "count(*)"}).collect():  # bins x ranks at most
            counts.setdefault(r["at"], []).append((r["bin"], r["n"]))
        for rank, (a, b, before) in held.items():
            if a < b:
                for bin_, n_ in sorted(counts[intervals.index((a, b))]):
                    if rank < before + n_:
                        break
                    before += n_
                first = a + bin_ * width[a, b]
                held[rank] = (first, min(b, first + width[a, b] - 1), before)
    return [held[floor(s)][0] + (s - floor(s)) * (held[ceil(s)][0] - held[floor(s)][0]) for s in spots]


def describe(df: DataFrame, column: str, digits: int) -> DataFrame:
    """(estadistica, valor) of a decimal column, at four decimals; sample standard deviation.

    One aggregate without a shuffle of values, and rounds of counts for the quartiles: nothing grows with the number of
    distinct values.
    """
    known = df.selectExpr(f"cast({column} AS decimal(12,{digits})) AS v").filter("v IS NOT NULL")
    units = f"v * {10**digits}BD"
    total = aggregate(
        known,
        {},
        {
            "rows": "count(*)",
            "mean": half_up("sum(v)", "count(v)", 4, digits),
            "spread": "(sum(v * v) - sum(v) * sum(v) / nullif(count(v), 0)) / nullif(count(v) - 1, 0)",
            "low": "min(v)",
            "high": "max(v)",
            "first": f"cast(min({units}) AS bigint)",
            "last": f"cast(max({units}) AS bigint)",
        },
    )
    one = total.first()
    quartiles = exact_quantiles(known, units, (0.25, 0.5, 0.75), one["rows"], one["first"] or 0, one["last"] or 0, 1 << 14)
    at_four = lambda q: Decimal(floor(abs(q) * 10**4 / 10**digits + Fraction(1, 2))).scaleb(-4) * (-1 if q < 0 else 1)
    spread = max(float(one["spread"] or 0), 0.0)
    # Names of the statistics.
    statistics = {
        "count": one["rows"], "mean": one["mean"], "std": f"sqrt({spread!r}D)" if one["rows"] > 1 else None, "min": one["low"],
        **{name: None if q is None else at_four(q) for name, q in zip(("25%", "50%", "75%"), quartiles)}, "max": one["high"],
    }
    number = lambda v: f"cast(round({'NULL' if v is None else v if isinstance(v, str) else f'{v}BD'}, 4) AS decimal(28,4))"
    pairs = ", ".join(f"'{name}', {number(value)}" for name, value in statistics.items())
    return df.sparkSession.range(1).selectExpr(f"stack({len(statistics)}, {pairs}) AS (estadistica, valor)")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """(bin, desde, hasta, cantidad): equal-width bins from minimum to maximum; the last one is closed.

    Empty bins are listed with 0. Values have two decimals; bin numbers come from whole cents.
    """
    known = df.filter(f"{column} IS NOT NULL")
    counted = aggregate(known, {"v": f"cast({column} * 100 AS bigint)"}, {"n": "count(*)"})
    edges = aggregate(counted, {}, {"low": "min(v)", "high": "max(v)"}).filter("low IS NOT NULL")
    spot = f"if(high = low, 0, least({bins - 1}, (v - low) * {bins} div (high - low)))"
    bounded = counted.withColumns({c: edges.select(c).scalar() for c in ("low", "high")})
    filled = aggregate(bounded, {"b": spot}, {"n": "sum(n)"})
    all_bins = edges.selectExpr("low", "high", f"explode(sequence(0L, {bins - 1}L)) AS bin")
    edge = lambda i: f"cast((low * {bins} + (high - low) * ({i})) / {100 * bins}BD AS decimal(18,4))"
    return all_bins.join(filled, F.expr("bin = b"), "left").selectExpr(
        "bin", f"{edge('bin')} AS desde", f"{edge('bin + 1')} AS hasta", "coalesce(n, 0) AS cantidad"
    )
