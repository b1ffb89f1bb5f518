"""Which types a text could be a value of, as bits, so that whole columns merge by counting."""

from __future__ import annotations

#: Types from narrow to wide; `string` accepts what none of them does. Integers are decimals, dates are timestamps.
KINDS = ("boolean", "integer", "decimal", "date", "timestamp")

_DAY = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
# How a value of each type is written.
PATTERNS = {
    "boolean": "(?i:true|false)",
    "integer": "[+-]?[0-9]{1,18}",
    "decimal": "[+-]?([0-9]{1,28}([.][0-9]{0,10})?|[.][0-9]{1,10})",
    "date": _DAY,
    "timestamp": f"{_DAY}([ T][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}([.][0-9]{{1,6}})?)?)?",
}
_CALENDAR = {"date": "date", "timestamp": "timestamp_ntz"}


def kind_bits(text: str) -> str:
    """SQL of the types that accept `text`, bit i for KINDS[i]; 0 if only a string does."""
    terms = []
    for i, kind in enumerate(KINDS):
        fits = f"{text} RLIKE '^(?:{PATTERNS[kind]})\\\\z'"
        if kind in _CALENDAR:  # the calendar decides, but only on texts of the right form
            fits = f"if({fits}, try_cast({text} AS {_CALENDAR[kind]}) IS NOT NULL, false)"
        terms.append(f"if({fits}, {1 << i}, 0)")
    return " + ".join(terms)


def narrowest(accepted: dict[str, str], condition: str) -> str:
    """SQL of the first type whose count of accepted values, {0} in `condition`, meets it; else string."""
    arms = " ".join(f"WHEN {condition.format(accepted[kind])} THEN '{kind}'" for kind in KINDS)
    return f"CASE {arms} ELSE 'string' END"
