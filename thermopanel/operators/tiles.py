"""Work on all pairs of two sets without holding either set in one place.

Rows are dealt by a hash of their id to tiles of bounded size; every tile of one set meets every tile of the other in a task of
its own. A task sees two tiles, whatever the sets' sizes, and hands on sums that are added up afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopanel.session import materialise

#: numbers in the vectors of a tile, and most rows of one
TILE_NUMBERS, TILE_ROWS = 1 << 18, 2048


def numbered(df: DataFrame, name: str = "id") -> DataFrame:
    """Rows with a unique id; written out, so that the ids stay."""
    return materialise(df.withColumn(name, F.monotonically_increasing_id()))


def tile_count(df: DataFrame, vector: str, rows: int | None = None) -> int:
    """Tiles that the rows of a written frame need."""
    n, width = df.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(vector)), F.lit(1))).first()
    return max(1, math.ceil(n / (rows or max(16, min(TILE_ROWS, TILE_NUMBERS // max(1, width))))))


def over_tile_pairs(left: DataFrame, right: DataFrame, n_left: int, n_right: int, work: Callable, schema: str) -> DataFrame:
    """``work(left tile, right tile)`` over all pairs of tiles, as Arrow tables; both frames have a column ``id``."""

    def dealt(df: DataFrame, own: str, n: int, other: str, n_other: int) -> DataFrame:
        tile = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        return df.select("*", tile.alias(own), copies.alias(other)).groupBy("__left", "__right")

    a, b = dealt(left, "__left", n_left, "__right", n_right), dealt(right, "__right", n_right, "__left", n_left)
    return a.cogroup(b).applyInArrow(work, schema)


def vectors_of(table: pa.Table, name: str) -> np.ndarray:
    """A column of equally long arrays as a matrix."""
    column = table.column(name).combine_chunks()
    flat = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """From every row to every row, summed entry by entry, so that near points keep their digits."""
    out = np.zeros((len(x), len(y)))
    for k in range(x.shape[1] if len(y) else 0):
        out += np.subtract.outer(x[:, k], y[:, k]) ** 2
    return out
