"""Composition of CTEs, and exact half-up ratios in DuckDB SQL."""

from __future__ import annotations

import re


def compose(final: str, ctes: dict[str, str]) -> str:
    """`final` preceded by the CTEs it needs, each after the ones it reads."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\b[bsgk]_[a-z0-9_]+\b", sql):
            if name in ctes and name not in ordered:
                visit(ctes[name])
                if name not in ordered:
                    ordered.append(name)

    visit(final)
    if not ordered:
        return final.strip()
    return "WITH " + ",\n".join(f"{name} AS ({ctes[name].strip()})" for name in ordered) + "\n" + final.strip()


def ratio(num: str, den: str, places: int = 2) -> str:
    """round-half-up(num / den) for whole, non-negative num and den; NULL when den is 0 or NULL."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    units = f"CAST(({n} * {2 * 10**places} + {d}) // (2 * {d}) AS BIGINT)"
    step = f"CAST({10**-places:.{places}f} AS DECIMAL({places + 1},{places}))"
    return f"CASE WHEN ({den}) > 0 THEN CAST({units} * {step} AS DECIMAL(18,{places})) END"


def pct(part: str, whole: str) -> str:
    return ratio(f"({part}) * 100", whole)


def cents(value: str) -> str:
    return f"({value}) * 100"


def avg2(value: str, places: int = 2) -> str:
    """Mean of a two-decimal column over its non-null rows."""
    return ratio(cents(f"sum({value})"), f"count({value}) * 100", places)


def money(value: str) -> str:
    return f"CAST({value} AS DECIMAL(28,2))"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"
