"""Building blocks shared by the plans. Measures are SQL texts keyed by their output name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.exact import percent


def named(measures: Mapping[str, str]) -> list[str]:
    return [f"{sql} AS `{name}`" for name, sql in measures.items()]


def aggregate(df: DataFrame, keys: Mapping[str, str], measures: Mapping[str, str]) -> DataFrame:
    """Group by `keys` (output name -> SQL; none for one global row) and compute the measures."""
    if not keys:
        return df.selectExpr(*named(measures))
    return df.groupBy(*[F.expr(k) for k in named(keys)]).agg(*[F.expr(m) for m in named(measures)])


def same(*columns: str) -> dict[str, str]:
    return {c: c for c in columns}


def add(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.selectExpr("*", *named(columns)) if columns else df


def n(condition: str) -> str:
    return f"count_if({condition})"


def per_code(column: str, codes: Mapping[str, str]) -> dict[str, str]:
    """One count per accepted code: {output name: code}."""
    return {name: n(f"{column} = '{code}'") for name, code in codes.items()}


def sum_if(value: str, condition: str) -> str:
    return f"sum({value}) FILTER (WHERE {condition})"


def count_of(value: str, condition: str) -> str:
    """Total of an already counted column over some rows; 0 where there are none."""
    return f"coalesce({sum_if(value, condition)}, 0)"


def sums(names: Mapping[str, str]) -> dict[str, str]:
    """Totals of count columns: {output name: input column}."""
    return {out: f"cast(sum({src}) AS bigint)" for out, src in names.items()}


def zero(columns: Iterable[str]) -> list[str]:
    return [f"coalesce({c}, 0) AS {c}" for c in columns]


FULL_NAME = "concat_ws(' ', first_name, last_name)"


def labelled(df: DataFrame, label: str, value: str, entries: Mapping[str, str]) -> DataFrame:
    """One wide row to (label, value) rows: {label text: SQL}. Values share one type."""
    pairs = ", ".join(f"'{text}', {sql}" for text, sql in entries.items())
    return df.selectExpr(f"stack({len(entries)}, {pairs}) AS ({label}, {value})")


def with_share(df: DataFrame, value: str, share: str) -> DataFrame:
    """Percent of the column total. Only for frames already aggregated to a handful of rows."""
    return add(df, {share: percent(value, f"sum({value}) OVER ()")})


def top(df: DataFrame, by: str, tie_break: str, k: int = 10) -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie_break)).limit(k)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def side_by_side(frames: list[DataFrame]) -> DataFrame:
    """One row with the columns of several one-row frames, which share no column name."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.selectExpr(*[f"max({c}) AS {c}" for c in stacked.columns])
