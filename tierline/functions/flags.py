"""SQL texts for row flags. Each evaluates to TRUE or FALSE, never NULL."""

from __future__ import annotations

from collections.abc import Iterable


def _never_null(condition: str) -> str:
    return f"coalesce({condition}, false)"


def member(column: str, values: Iterable[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return _never_null(f"{column} IN ({listed})")


def holds(condition: str) -> str:
    return _never_null(condition)


def between(column: str, low: object, high: object) -> str:
    return _never_null(f"{column} BETWEEN {low} AND {high}")


def in_order(first: str, second: str, strict: bool = False) -> str:
    return _never_null(f"{first} {'<' if strict else '<='} {second}")


def close(left: str, right: str, tolerance: str) -> str:
    return _never_null(f"abs({left} - {right}) <= {tolerance}")


def known(column: str) -> str:
    return f"{column} IS NOT NULL"


def filled(column: str) -> str:
    return _never_null(f"trim({column}) <> ''")
