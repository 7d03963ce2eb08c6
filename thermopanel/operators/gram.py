"""Centred products of column pairs, in blocks.

A task turns the rows it has into matrices, one per group, and multiplies them: counts, sums and products of all pairs of columns over
the rows that have both. It hands on one row per group and pair; these are written, and merged around a mean of their
own. No row is multiplied by the number of pairs, and a group with most of the rows is summed by as many tasks as hold it.

Null and NaN are missing. Sums are taken about the first value of a column, so large offsets cost no digits and a
constant column has a spread of exactly 0.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermopanel.session import materialise

#: numbers a task holds for its groups before it hands them on
HELD = 1 << 23
#: a spread below this share of the squares is rounding
ROUNDING = 1e-13
_PARTS = ("n", "mx", "my", "cxx", "cyy", "cxy")


def _groups(batch: pa.RecordBatch, keys: Sequence[str]) -> list[tuple[tuple, np.ndarray]]:
    """(key values, row numbers) of a batch."""
    if not keys:
        return [((), np.arange(batch.num_rows))]
    columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
    code = np.zeros(batch.num_rows, np.int64)
    for column in columns:
        encoded = pc.dictionary_encode(column, null_encoding="encode")
        _, code = np.unique(code * (len(encoded.dictionary) + 1) + encoded.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    order = np.argsort(code, kind="stable")
    cuts = np.flatnonzero(np.diff(code[order])) + 1
    return [(tuple(c[int(rows[0])].as_py() for c in columns), rows) for rows in np.split(order, cuts) if len(rows)]


def _matrix(batch: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """Columns as a matrix of doubles, missing as NaN."""
    out = np.empty((batch.num_rows, len(columns)))
    for i, c in enumerate(columns):
        out[:, i] = batch.column(batch.schema.get_field_index(c)).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return out


class _Products:
    """Running sums of one group about its first values."""

    def __init__(self, a: int, b: int):
        self.first = (np.full(a, np.nan), np.full(b, np.nan))
        self.sums = [np.zeros((a, b)) for _ in _PARTS]

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        sides = []
        for values, first in zip((x, y), self.first):
            there = ~np.isnan(values)
            new = np.isnan(first) & there.any(axis=0)
            first[new] = values[there.argmax(axis=0), np.arange(values.shape[1])][new]
            sides += [np.where(there, values - np.where(np.isnan(first), 0, first), 0), there.astype(float)]
        dx, vx, dy, vy = sides
        for total, part in zip(self.sums, (vx.T @ vy, dx.T @ vy, vx.T @ dy, (dx * dx).T @ vy, vx.T @ (dy * dy), dx.T @ dy)):
            total += part

    def parts(self, wanted: np.ndarray) -> list[np.ndarray]:
        n, sx, sy, sxx, syy, sxy = (s.ravel()[wanted] for s in self.sums)
        some = np.maximum(n, 1)
        spread = [np.where(c <= ROUNDING * s, 0, c) for c, s in ((sxx - sx * sx / some, sxx), (syy - sy * sy / some, syy))]
        a, b = self.sums[0].shape
        fx, fy = np.repeat(self.first[0], b)[wanted], np.tile(self.first[1], a)[wanted]
        # a pair that no row has keeps its row, without means
        fx[n == 0] = fy[n == 0] = np.nan
        return [n, fx + sx / some, fy + sy / some, *spread, sxy - sx * sy / some]


def pair_products(df: DataFrame, left: Sequence[str], right: Sequence[str], keys: Sequence[str] = (), half: bool = False) -> DataFrame:
    """(keys, pair, n, cxx, cyy, cxy): centred sums of each left with each right column over the rows that have both.

    A group has a row for every pair, null sums where no row has both.

    ``pair`` is left number x right columns + right number; ``half`` leaves out the pairs below the diagonal.
    """
    keys, left, right = list(keys), list(left), list(right)
    a, b = np.divmod(np.arange(len(left) * len(right)), max(1, len(right)))
    wanted = np.flatnonzero((a <= b) | (not half))
    most = max(1, HELD // max(1, len(_PARTS) * len(left) * len(right)))
    fields = [*[df.schema[k] for k in keys], T.StructField("pair", T.IntegerType()), *[T.StructField(p, T.DoubleType()) for p in _PARTS]]

    def work(batches):
        held: dict[tuple, _Products] = {}

        def told():
            rows = [(key, products.parts(wanted)) for key, products in held.items()]
            held.clear()
            arrays = [
                pa.array([key[i] for key, _ in rows for _ in wanted], kind) for i, kind in enumerate(kinds)
            ] + [pa.array(np.tile(wanted, len(rows)), pa.int32())]
            for i in range(len(_PARTS)):
                values = np.concatenate([parts[i] for _, parts in rows])
                arrays.append(pa.array(values, pa.float64(), mask=np.isnan(values)))
            return pa.RecordBatch.from_arrays(arrays, names=[*keys, "pair", *_PARTS])

        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = kinds or [batch.schema.field(k).type for k in keys]
            x, y = _matrix(batch, left), _matrix(batch, right)
            for key, rows in _groups(batch, keys):
                if key not in held:
                    held[key] = _Products(len(left), len(right))
                held[key].add(x[rows], y[rows])
            if len(held) > most:
                yield told()
        if held:
            yield told()

    columns = list(dict.fromkeys([*left, *right]))
    narrow = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns if c not in keys])
    parts = materialise(narrow.mapInArrow(work, T.StructType(fields)))
    # merged about the least of the means, which equals all of them for a constant column; a row per task and pair
    tasks = Window.partitionBy(*keys, "pair")
    about = parts.withColumns({"dx": F.col("mx") - F.min("mx").over(tasks), "dy": F.col("my") - F.min("my").over(tasks)})
    dx, dy, n = F.col("dx"), F.col("dy"), F.col("n")
    sums = about.groupBy(*keys, "pair").agg(
        F.sum("n").alias("n"), F.sum(n * dx).alias("sx"), F.sum(n * dy).alias("sy"),
        F.sum(F.col("cxx") + n * dx * dx).alias("cxx"), F.sum(F.col("cyy") + n * dy * dy).alias("cyy"),
        F.sum(F.col("cxy") + n * dx * dy).alias("cxy"),
    )
    less = lambda c, s, t: (F.col(c) - F.try_divide(F.col(s) * F.col(t), F.col("n"))).alias(c)
    return sums.select(*keys, "pair", "n", less("cxx", "sx", "sx"), less("cyy", "sy", "sy"), less("cxy", "sx", "sy"))


def correlations(df: DataFrame, left: Sequence[str], right: Sequence[str], keys: Sequence[str] = (), half: bool = False) -> DataFrame:
    """(keys, pair, corr) for all pairs of a group's columns; null where a column is constant or no row has both."""
    left, right = list(left), list(right)
    products = pair_products(df, left, right, keys, half)
    spread = F.sqrt(F.greatest("cxx", F.lit(0.0))) * F.sqrt(F.greatest("cyy", F.lit(0.0)))
    return products.select(*keys, "pair", F.try_divide(F.col("cxy"), spread).alias("corr"))
