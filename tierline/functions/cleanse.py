"""SQL texts from text to typed values. Text that does not convert becomes NULL, never an error."""

from __future__ import annotations

_TEXT = {
    "text": "trim({c})",
    "lower": "lower(trim({c}))",
    "upper": "upper(trim({c}))",
    "title": "initcap(trim({c}))",
    "optional": "nullif(trim({c}), '')",
}
_SQL_TYPE = {
    "integer": "int",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp_ntz",
}


def blank(column: str) -> str:
    """NULL, empty or spaces only."""
    return f"({column} IS NULL OR trim({column}) = '')"


def sql_type(kind: str) -> str:
    """Spark type name of a column kind; text kinds are strings."""
    if kind.startswith("decimal"):
        return kind
    return _SQL_TYPE.get(kind, "string")


def converted(column: str, target: str) -> str:
    """The trimmed text as `target`, or NULL."""
    text = f"trim(`{column}`)"
    if target == "boolean":
        text = f"lower({text})"
    return f"try_cast({text} AS {target})"


def typed(column: str, kind: str) -> str:
    """Trim the text column and bring it to the type of `kind`."""
    if kind in _TEXT:
        return _TEXT[kind].format(c=f"`{column}`")
    return converted(column, sql_type(kind))
