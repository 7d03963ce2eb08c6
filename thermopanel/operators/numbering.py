"""Positions and fills along one order of a whole table, without a task that sees all of it.

Rows are range-partitioned by the order, sorted inside their partitions and written out with a partition number and a place in
it. What precedes a partition is then a prefix over one number (or one row of last values) per partition, which the driver
adds up: as many rows as there are partitions, whatever the table's size. Rows alike in all order columns are told
apart by a hash of the whole row, so that many of them still spread over partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermopanel.session import materialise

PLACE, PART = "__place", "__part"
#: ``monotonically_increasing_id`` keeps the partition above these bits and the row below
ROW_BITS = 33


def placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with their partition and place in the order."""
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    sorted_rows = df.repartitionByRange(*[F.col(c) for c in order], tie).sortWithinPartitions(*[F.col(c) for c in order], tie)
    written = materialise(sorted_rows.withColumn(PLACE, F.monotonically_increasing_id()))
    return written.withColumns({
        PART: F.shiftright(PLACE, ROW_BITS).cast("int"), PLACE: F.col(PLACE).bitwiseAND(F.lit((1 << ROW_BITS) - 1)),
    })


def row_numbers(df: DataFrame, order: Sequence[str], index: str, length: str) -> DataFrame:
    """0-based position of every row along the order, and the number of rows."""
    rows = placed(df, order)
    counts = {r[PART]: r["n"] for r in rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for part in range(max(counts, default=0) + 1):
        before.append(total)
        total += counts.get(part, 0)
    start = F.get(F.lit(before), F.col(PART)).cast("long")
    return rows.withColumns({index: start + F.col(PLACE), length: F.lit(total).cast("long")}).drop(PLACE, PART)


def filled_along(df: DataFrame, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Nulls replaced by the last known value along the order; the first ones stay null."""
    rows = placed(df, order)
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(PLACE))).alias(c) for c in columns]
    known = {r[PART]: r for r in rows.groupBy(PART).agg(*last).collect()}
    carried, now = [], dict.fromkeys(columns)
    for part in range(max(known, default=0) + 1):
        carried.append(tuple(now[c] for c in columns))
        if part in known:
            now = {c: now[c] if known[part][c] is None else known[part][c] for c in columns}

    def passed_on(c: str, at: int) -> Column:
        kind = df.schema[c].dataType
        return F.get(F.array(*[F.lit(row[at]) for row in carried]).cast(T.ArrayType(kind)), F.col(PART))

    inside = Window.partitionBy(PART).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumns({
        c: F.coalesce(F.last(c, ignorenulls=True).over(inside), passed_on(c, at)) for at, c in enumerate(columns)
    })
    return out.select(*df.columns)
