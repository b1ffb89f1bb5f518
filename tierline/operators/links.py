"""Equi-joins between a table and its parents that hold up under hot and missing keys.

A third of all rows may carry the same key. Every join here is written so that both sides get
their own exchange right below the join, which is what adaptive execution needs to split a hot
partition: the second join column is the hash of the first one, so the partitioning an earlier
distinct or groupBy left behind does not satisfy the join. Rows whose key is NULL can never
match; they are spread over many partitions instead of piling up in one. No side is broadcast by
hand: parents grow with the data, and Spark broadcasts a side only when its measured size allows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.cleanse import blank
from tierline.operators.measures import add, aggregate, same

def hot_key_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, row_id: str, how: str = "left", stored: bool = True
) -> DataFrame:
    """Join on text keys; `right_key` is dropped from the result. `row_id` spreads NULL keys.

    The hash is computed by the exchanges, so that no row is shuffled with it; so is a key that is not `stored`, which saves
    a second text where the left key is read later on.
    """
    key = left_key
    if how == "left":
        # No trimmed key starts with a control character, so these texts match nothing.
        key = f"coalesce({left_key}, concat(char(31), xxhash64({row_id})))"
    if not stored:
        on = F.expr(f"{key} = {right_key} AND xxhash64({key}) = xxhash64({right_key})")
        return left.join(right, on, how).drop(right_key)
    on = F.expr(f"_key = {right_key} AND xxhash64(_key) = xxhash64({right_key})")
    return add(left, {"_key": key}).join(right, on, how).drop("_key", right_key)


def link(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    flag: str,
    row_id: str,
    carry: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add `flag` (does the parent row exist?) and the parent columns in `carry` (name -> new name).

    The child keeps its row count: the parent side holds one row per key.
    """
    carry = dict(carry or {})
    ref = parent.filter(f"{parent_key} IS NOT NULL")
    if carry:
        ref = aggregate(ref, {"_ref": parent_key}, {new: f"min({old})" for old, new in carry.items()})
    else:
        ref = ref.selectExpr(f"{parent_key} AS _ref").distinct()
    joined = hot_key_join(child, add(ref, {"_found": "_ref"}), child_key, "_ref", row_id)
    return add(joined, {flag: "_found IS NOT NULL"}).drop("_found")


def attach_group(df: DataFrame, keys: list[str], row_id: str, stats: Mapping[str, str]) -> DataFrame:
    """Give each row the aggregates of its group; rows with NULL keys form groups of their own.

    Stands in for whole-partition window functions, which would hold a hot group in one task:
    the groups are pre-aggregated on the map side and joined back.
    """
    # Length-prefixed, so no two key tuples share a text and NULL differs from any value.
    parts = ", ".join(f"coalesce(concat(length({k}), ':', {k}), '-')" for k in keys)
    marked = add(df, {"_group": f"concat({parts})"})
    grouped = aggregate(marked, {"_group_ref": "_group"}, stats)
    return hot_key_join(marked, grouped, "_group", "_group_ref", row_id).drop("_group")


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row (duplicate_groups): how many key values occur more than once."""
    groups = aggregate(df, same(*keys), {"_n": "count(*)"})
    return groups.selectExpr("count_if(_n > 1) AS duplicate_groups")


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-blank child keys (column _id) that no parent row has.

    Both sides are counted per key, put in one frame and counted once more, so that no join is needed.
    """
    sides = []
    for df, key, side in ((child, child_key, 0), (parent, parent_key, 1)):
        sides.append(df.selectExpr(f"trim({key}) AS _id", f"{side} AS _side").filter(f"NOT {blank('_id')}"))
    owners = aggregate(sides[0].unionByName(sides[1]), {"_id": "_id"}, {"_owned": "max(_side)"})
    return owners.filter("_owned = 0").select("_id")


def orphan_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row (row_count, null_values, orphan_values); children are counted per key before the join."""
    counted = aggregate(child, {"_fk": child_key}, {"_n": "count(*)"})
    parents = parent.selectExpr(f"{parent_key} AS _pk").filter("_pk IS NOT NULL").distinct()
    return counted.join(parents, F.expr("_fk = _pk"), "left").selectExpr(
        "coalesce(sum(_n), 0) AS row_count",
        "coalesce(sum(_n) FILTER (WHERE _fk IS NULL), 0) AS null_values",
        "coalesce(sum(_n) FILTER (WHERE _fk IS NOT NULL AND _pk IS NULL), 0) AS orphan_values",
    )
