"""Positional work on long series without a task per series.

A panel has few, long series (one per site), so ``Window.partitionBy(site)``
would put a whole site into one task. Everything here works on bounded pieces:

* *chunks* cut a series along its axis (time or a number). Sums, counts and last
  known values are taken per chunk, carried over a one-row-per-chunk summary,
  and joined back on the chunk the rows are already partitioned by.
* *blocks* hold a fixed number of consecutive rows plus as many neighbouring rows
  (the halo) as the widest frame needs. Lags, leads and ROWS frames inside a block
  equal those over the whole series, because the halo is counted in rows.

A per-chunk summary reads its input a second time. Index a frame once with
:meth:`Series.row_index` and later block operators reuse the index; where the frame is
costly to compute, pass as ``source`` a cheap frame with the same rows.

Series keys and order columns must not be null; rows with a null key are dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

IDX, LEN, BLOCK, OWN = "__idx", "__len", "__block", "__own"

#: hours per chunk; a multiple of 24, so a calendar day never straddles two chunks
SPAN_HOURS = 2016
#: rows per block; with a week as halo it stays below 4096, up to which a window keeps
#: its rows in a plain array (beyond, every frame reads them through a spillable buffer)
BLOCK_ROWS = 3584


@dataclass(frozen=True)
class Series:
    """How rows form series: ``keys`` name a series, ``order`` is unique inside it.

    ``axis`` is the order column that is cut into chunks of ``span`` (hours for a
    timestamp, days for a date, units for a number). Order columns before it stay
    whole, those after it only order rows inside a chunk.
    """

    keys: tuple[str, ...] = ("branch_id",)
    order: tuple[str, ...] = ("tm",)
    axis: str = "tm"
    span: int = SPAN_HOURS
    block_rows: int = BLOCK_ROWS

    def with_keys(self, *keys: str) -> Series:
        return replace(self, keys=tuple(keys))

    # ---- chunks -------------------------------------------------------
    def _chunk_columns(self) -> list[str]:
        return [f"__chunk{i}" for i in range(self.order.index(self.axis) + 1)]

    def chunked(self, df: DataFrame) -> DataFrame:
        names = self._chunk_columns()
        kind = df.schema[self.axis].dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            cut = F.floor(F.unix_seconds(F.col(self.axis).cast("timestamp")) / F.lit(self.span * 3600))
        elif isinstance(kind, T.DateType):
            cut = F.floor(F.unix_date(self.axis) / F.lit(self.span))
        else:
            cut = F.floor(F.col(self.axis) / F.lit(self.span))
        parts = [F.col(c) for c in self.order[: len(names) - 1]] + [cut]
        return df.select("*", *[part.alias(name) for part, name in zip(parts, names)])

    def chunk_window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, *self._chunk_columns()).orderBy(*self.order)

    def _carried(self, df: DataFrame, totals: Sequence[Column], carries) -> DataFrame:
        """Per-chunk totals, and what the chunks before (or after) each one pass on."""
        names = self._chunk_columns()
        whole = Window.partitionBy(*self.keys)
        before = whole.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
        # growing frames only: a frame that shrinks from the far end is evaluated anew per row
        after = whole.orderBy(*[F.desc(c) for c in names]).rowsBetween(Window.unboundedPreceding, -1)
        summary = df.groupBy(*self.keys, *names).agg(*totals)
        return summary.select(*self.keys, *names, *carries(before, after, whole))

    def _join_carried(self, df: DataFrame, summary: DataFrame) -> DataFrame:
        return df.join(summary, [*self.keys, *self._chunk_columns()])

    def _drop_chunks(self, df: DataFrame) -> DataFrame:
        return df.drop(*self._chunk_columns())

    # ---- whole-series positions, sums and fills -----------------------
    def row_index(self, df: DataFrame, source: DataFrame | None = None) -> DataFrame:
        """Exact 0-based position ``__idx`` and series length ``__len``.

        They hold until rows are filtered out; drop them then.
        """
        cut = self.chunked(df.drop(IDX, LEN))
        summary = self._carried(
            cut if source is None else self.chunked(source),
            [F.count(F.lit(1)).alias("__n")],
            lambda before, after, whole: [
                F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
                F.sum("__n").over(whole).alias(LEN),
            ],
        )
        numbered = cut.select("*", F.row_number().over(self.chunk_window()).alias("__rn"))
        out = self._join_carried(numbered, summary)
        out = out.withColumn(IDX, F.col("__offset") + F.col("__rn") - 1).drop("__rn", "__offset")
        return self._drop_chunks(out)

    def running_sum(self, df: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
        """Add running totals from the first row of the series up to each row."""
        cut = self.chunked(df)
        frame = self.chunk_window().rowsBetween(Window.unboundedPreceding, 0)
        summary = self._carried(
            cut,
            [F.sum(value).alias(f"__t_{name}") for name, value in sums.items()],
            lambda before, after, whole: [
                F.coalesce(F.sum(f"__t_{name}").over(before), F.lit(0)).alias(f"__c_{name}") for name in sums
            ],
        )
        within = cut.select("*", *[F.sum(value).over(frame).alias(f"__w_{name}") for name, value in sums.items()])
        out = self._join_carried(within, summary)
        out = out.withColumns({name: F.coalesce(f"__w_{name}", F.lit(0)) + F.col(f"__c_{name}") for name in sums})
        return self._drop_chunks(out.drop(*[f"__{p}_{name}" for name in sums for p in "wc"]))

    def fill(
        self, df: DataFrame, columns: Sequence[str], forward: bool | Sequence[str] = True,
        backward: bool | Sequence[str] = False, source: DataFrame | None = None,
    ) -> DataFrame:
        """Replace nulls by the last known value, then (if asked) by the next one.

        ``forward`` and ``backward`` may name the columns they are meant for.
        """
        chosen = {
            "f": [c for c in columns if forward is True or (forward and c in forward)],
            "b": [c for c in columns if backward is True or (backward and c in backward)],
        }
        # order columns before the axis are the same in a whole chunk; a plain axis lets totals be hashed, not sorted
        inside = self.order[self.order.index(self.axis):]
        place = F.col(inside[0]) if len(inside) == 1 else F.struct(*inside)
        chunk = Window.partitionBy(*self.keys, *self._chunk_columns())
        orders = {"f": list(self.order), "b": [F.desc(c) for c in self.order]}
        pick = {"f": F.max_by, "b": F.min_by}
        cut = self.chunked(df)
        totals = [
            pick[way](c, F.when(F.col(c).isNotNull(), place)).alias(f"__{way}t_{c}") for way in "fb" for c in chosen[way]
        ]

        def carries(before, after, whole):
            frame = {"f": before, "b": after}
            return [
                F.last(f"__{way}t_{c}", ignorenulls=True).over(frame[way]).alias(f"__{way}c_{c}")
                for way in "fb" for c in chosen[way]
            ]

        summary = self._carried(cut if source is None else self.chunked(source), totals, carries)
        within = [
            F.last(c, ignorenulls=True)
            .over(chunk.orderBy(*orders[way]).rowsBetween(Window.unboundedPreceding, 0)).alias(f"__{way}w_{c}")
            for way in "fb" for c in chosen[way]
        ]
        out = self._join_carried(cut.select("*", *within), summary)
        filled = {
            c: F.coalesce(c, *[F.col(f"__{way}{k}_{c}") for way in "fb" if c in chosen[way] for k in "wc"])
            for c in columns
        }
        return out.withColumns(filled).select(*df.columns)

    # ---- blocks with a halo -------------------------------------------
    def blocks(
        self, df: DataFrame, before: int = 0, after: int = 0, source: DataFrame | None = None
    ) -> DataFrame:
        """Rows in blocks, with ``before``/``after`` neighbours copied into each.

        Use :meth:`window` for expressions and :meth:`own_rows` to drop the copies.
        """
        size = self._block_size(before, after)
        indexed = df if IDX in df.columns else self.row_index(df, source)
        place, home = F.pmod(F.col(IDX), F.lit(size)), F.floor(F.col(IDX) / F.lit(size))
        targets = [home]
        if before:
            targets.append(F.when(place >= size - before, home + 1))
        if after:
            targets.append(F.when((place < after) & (home > 0), home - 1))
        if len(targets) == 1:
            return indexed.select("*", home.alias(BLOCK), F.lit(True).alias(OWN))
        spread = F.explode(F.filter(F.array(*targets), lambda b: b.isNotNull()))
        out = indexed.select("*", home.alias("__home"), spread.alias(BLOCK))
        return out.withColumn(OWN, F.col("__home") == F.col(BLOCK)).drop("__home")

    def _block_size(self, before: int, after: int) -> int:
        return max(self.block_rows, before, after, 1)

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, BLOCK).orderBy(IDX)

    @staticmethod
    def own_rows(df: DataFrame, indexed: bool = False) -> DataFrame:
        """Drop the copies; keep the index only if the caller's frame had it."""
        return df.filter(F.col(OWN)).drop(BLOCK, OWN, *([] if indexed else [IDX, LEN]))

    def apply(
        self, df: DataFrame, columns: Sequence[Column], before: int = 0, after: int = 0,
        source: DataFrame | None = None,
    ) -> DataFrame:
        """Add window expressions written against :meth:`window`."""
        laid = self.blocks(df, before, after, source).select("*", *columns)
        return self.own_rows(laid, IDX in df.columns)


#: one hourly series per site
SITE_HOURS = Series()
