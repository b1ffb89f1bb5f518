from __future__ import annotations

import random
from fractions import Fraction

import pytest

from tierline.operators.values import describe, exact_quantiles


def plain(values, f):
    values = sorted(values)
    spot = Fraction(f).limit_denominator(10**9) * (len(values) - 1)
    low = values[int(spot)]
    return low + (spot - int(spot)) * (values[min(int(spot) + 1, len(values) - 1)] - low)


FRACTIONS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)


@pytest.mark.parametrize("bins", [2, 16, 4096])
@pytest.mark.parametrize("make", [lambda r: r.randrange(-50, 50), lambda r: r.choice([7, 7, 7, 10**12, -(10**15)]), lambda r: r.getrandbits(62) - (1 << 61)])
def test_quantiles_equal_sorting(spark, bins, make):
    draw = random.Random(bins)
    values = [make(draw) for _ in range(301)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "u long")
    got = exact_quantiles(frame, "u", FRACTIONS, len(values), min(values), max(values), bins)
    assert got == [plain(values, f) for f in FRACTIONS]


def test_a_million_distinct_values_in_few_counts(spark):
    """Far more distinct values than a task may hold: what a round sends is bounded by its bins."""
    n = 1_200_000
    frame = spark.range(0, n, 1, 8).selectExpr("id * 7919 % 1200007 * 1000003 AS u")
    values = [i * 7919 % 1200007 * 1000003 for i in range(n)]
    rounds = []

    class Counting:
        def __init__(self, df):
            self.df = df

        def selectExpr(self, *sql):
            rounds.append(sql)
            return self.df.selectExpr(*sql)

    got = exact_quantiles(Counting(frame), "u", (0.25, 0.5, 0.75), n, min(values), max(values), 1 << 12)
    assert got == [plain(values, f) for f in (0.25, 0.5, 0.75)]
    assert len(rounds) <= 4


def test_describe_of_empty_single_and_tied_columns(spark):
    one = lambda rows, digits=2: {r.estadistica: r.valor for r in describe(spark.createDataFrame(rows, "v decimal(12,2)"), "v", digits).collect()}
    from decimal import Decimal as D

    empty = one([(None,)])
    assert empty.pop("count") == 0 and set(empty.values()) == {None}
    single = one([(D("2.50"),), (None,)])
    assert single["std"] is None and {k: v for k, v in single.items() if k not in ("std", "count")} == dict.fromkeys(("mean", "min", "25%", "50%", "75%", "max"), D("2.5000"))
    tied = one([(D("-1.00"),)] * 3 + [(D("4.00"),)])
    assert (tied["25%"], tied["50%"], tied["75%"], tied["std"]) == (D("-1"), D("-1"), D("0.25"), D("2.5"))
