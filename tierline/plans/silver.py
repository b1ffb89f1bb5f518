"""Bronze to silver: trimmed and typed columns, one boolean per quality rule, no row dropped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tierline.catalogue import LINEAGE, SILVER_LINEAGE, TABLES
from tierline.functions.cleanse import typed
from tierline.operators.links import attach_group, link
from tierline.operators.measures import add


def _repeated_combination(df: DataFrame) -> DataFrame:
    keys = ["student_id", "course_id", "semester_id"]
    counted = attach_group(df, keys, "enrollment_id", {"_rows_in_group": "count(*)"})
    return add(counted, {"is_repeated_combination": "_rows_in_group > 1"})


def _weights_per_enrollment(df: DataFrame) -> DataFrame:
    stats = {"_weight_sum": "sum(weight)", "_weight_missing": "count(*) - count(weight)"}
    return attach_group(df, ["enrollment_id"], "grade_id", stats)


_GROUP_STEP: dict[str, Callable[[DataFrame], DataFrame]] = {
    "enrollments": _repeated_combination,
    "grades": _weights_per_enrollment,
}
#: Silver columns that these steps make.
GROUP_COLUMNS: dict[str, tuple[str, ...]] = {
    "enrollments": ("is_repeated_combination",),
    "grades": ("total_weight", "is_weight_sum_one"),
}


def base_columns(name: str, bronze: DataFrame, *columns: str) -> DataFrame:
    """Typed silver columns that need neither flags nor links, straight from bronze."""
    table = TABLES[name]
    source = {table.rename.get(c, c): (c, kind) for c, kind in table.columns.items()}
    return bronze.selectExpr(*[f"{typed(*source[c])} AS {c}" for c in columns])


def refine(name: str, bronze: DataFrame, reference: Callable[..., DataFrame]) -> DataFrame:
    """Silver form of one bronze table. `reference(parent, *columns)` reads a parent's silver columns."""
    table = TABLES[name]
    df = bronze.selectExpr(
        *[f"{typed(c, kind)} AS {table.rename.get(c, c)}" for c, kind in table.columns.items()],
        LINEAGE[0],
        f"{LINEAGE[1]} AS {SILVER_LINEAGE[1]}",
        LINEAGE[2],
    )
    if name in _GROUP_STEP:
        df = _GROUP_STEP[name](df)
    df = add(df, {column: sql for column, (sql, _) in table.derived.items()})
    df = add(df, table.flags)
    for ln in table.links:
        parent_key = TABLES[ln.parent].key[0]
        row_id = next(k for k in table.key[::-1] if k != ln.column)
        parent = reference(ln.parent, parent_key, *ln.carry)
        df = link(df, parent, ln.column, parent_key, ln.flag, row_id, ln.carry)
    df = add(df, table.after_links)
    return df.selectExpr(*table.silver_columns(), *SILVER_LINEAGE[:3], f"current_timestamp() AS {SILVER_LINEAGE[3]}")


def business_columns(df: DataFrame) -> DataFrame:
    return df.drop(*SILVER_LINEAGE)
