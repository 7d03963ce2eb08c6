"""Sorting, top rows, positional slices, unions and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopanel.operators.numbering import row_numbers
from thermopanel.operators.series import IDX, LEN


def sort_by(df: DataFrame, keys: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*[F.desc(k) if k in descending else F.asc(k) for k in keys])


def top_rows(df: DataFrame, column: str, n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc(column), *tie_break).limit(n)


def order_by_list(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """Sort by the place of a label in a given list; unknown labels go last."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(column)).cast("int")
    return df.orderBy(F.when(place > 0, place).otherwise(len(order) + 1), column)


def position_slice(df: DataFrame, order: Sequence[str], first: int, last: int) -> DataFrame:
    """Rows at positions first..last-1 of the order; negative positions count from the end, as does 0 as ``last``.

    Slices of one end are taken as the top rows from there; others number the whole table.
    """
    if 0 <= first and 0 < last:
        return df.orderBy(*order).offset(first).limit(max(0, last - first))
    if first < 0 and last <= 0:
        return df.orderBy(*[F.desc(c) for c in order]).offset(-last).limit(max(0, last - first))
    indexed = row_numbers(df, order, IDX, LEN)
    a = F.lit(first) if first >= 0 else F.col(LEN) + first
    b = F.lit(last) if last > 0 else F.col(LEN) + last
    return indexed.filter((F.col(IDX) >= a) & (F.col(IDX) < b)).drop(IDX, LEN)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
