"""Seasonal-trend decomposition by loess, computed block by block.

Every step of the decomposition looks at a bounded neighbourhood: loess windows and
moving averages. The reach of one inner iteration, times the number of iterations,
is the halo after which a block's own rows equal those of the whole series, so a
series of any length is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermopanel.operators.joins import salted_join
from thermopanel.operators.quantiles import exact_quantiles
from thermopanel.operators.series import BLOCK, IDX, LEN, OWN, SITE_HOURS, Series
from thermopanel.session import materialise

# ---- fixed values: the usual defaults of the method -----------------------
SEASONAL_WINDOW, INNER_ITERATIONS, MIN_ROWS = 7, 5, 48
ROBUST_ROUNDS, ROBUST_ITERATIONS = 15, 2
# ---- end of fixed values --------------------------------------------------
STL_BLOCK_ROWS = 16384
STL_SERIES = replace(SITE_HOURS, block_rows=STL_BLOCK_ROWS)


def odd_at_least(x: float) -> int:
    n = int(np.ceil(x))
    return n if n % 2 else n + 1


def trend_window(period: int, seasonal: int = SEASONAL_WINDOW) -> int:
    return odd_at_least(1.5 * period / (1 - 1.5 / seasonal))


def reach(period: int, iterations: int = INNER_ITERATIONS, seasonal: int = SEASONAL_WINDOW) -> int:
    """Rows to either side that can influence a row's result."""
    low_pass = odd_at_least(period + 1)
    one_pass = trend_window(period, seasonal) + low_pass + 2 * period + 3 + seasonal * period
    return one_pass * iterations // 2 + period


def loess_kernel(n: int, window: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbour indices and distance weights of a loess on positions 0..n-1, per point."""
    size = min(window, n)
    left = np.clip(np.floor(at).astype(int) - (size - 1) // 2, 0, n - size)
    near = left[:, None] + np.arange(size)
    gap = np.abs(near - at[:, None])
    radius = np.maximum(at - left, left + size - 1 - at) + max(window - n, 0) // 2
    share = gap / np.maximum(radius, 1e-12)[:, None]
    w = np.where(share <= 0.999, (1 - np.minimum(share, 1.0) ** 3) ** 3, 0.0)
    return near, np.where(share <= 0.001, 1.0, w)


def loess_filter(near: np.ndarray, kernel: np.ndarray, at: np.ndarray, n: int, row_weights=None) -> np.ndarray:
    """Local linear fit as one weight per neighbour; equal weights where all are zero."""
    w = kernel if row_weights is None else kernel * row_weights[near]
    total = w.sum(axis=1, keepdims=True)
    w = np.where(total > 0, w / np.where(total > 0, total, 1.0), 1.0 / near.shape[1])
    centre = (w * near).sum(axis=1, keepdims=True)
    spread = (w * (near - centre) ** 2).sum(axis=1, keepdims=True)
    sloped = np.sqrt(spread) > 0.001 * max(n - 1, 1)
    slope = np.where(sloped, (at[:, None] - centre) / np.where(sloped, spread, 1.0), 0.0)
    return w * (1 + slope * (near - centre))


class Loess:
    """Loess at fixed points of an evenly spaced series; reused while row weights stay.

    ``whole`` is the length of the series that the n points are a piece of: it decides what counts as a slope.
    """

    def __init__(self, n: int, window: int, at: np.ndarray, row_weights: np.ndarray | None = None, whole: int | None = None):
        self.near, kernel = loess_kernel(n, window, at)
        self.weights = loess_filter(self.near, kernel, at, whole or n, row_weights)

    def __call__(self, y: np.ndarray) -> np.ndarray:
        return (y[self.near] * self.weights).sum(axis=1)


def moving_mean(x: np.ndarray, size: int) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(x)])
    return (total[size:] - total[:-size]) / size


def stl_arrays(
    y: np.ndarray, period: int, iterations: int = INNER_ITERATIONS, seasonal_window: int = SEASONAL_WINDOW,
    row_weights: np.ndarray | None = None, trend: np.ndarray | None = None, first: int = 0, whole: int | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """(trend, seasonal) of one piece of an evenly spaced series without gaps.

    The piece begins at position ``first`` of a series of ``whole`` points.
    """
    n = len(y)
    whole = whole or n
    everywhere = np.arange(n, dtype=float)
    trend_loess = Loess(n, trend_window(period, seasonal_window), everywhere, row_weights, whole)
    low_loess = Loess(n, odd_at_least(period + 1), everywhere, whole=whole)
    phases = []
    for p in range(period):
        count = len(range(p, n, period))
        # one point more on either end, for the averages that follow
        weights = None if row_weights is None else row_weights[p::period]
        in_series = len(range((first + p) % period, whole, period))
        phases.append(Loess(count, seasonal_window, np.arange(-1.0, count + 1.0), weights, in_series))
    trend = np.zeros(n) if trend is None else trend
    seasonal = np.zeros(n)
    for _ in range(iterations):
        detrended = y - trend
        cycle = np.empty(n + 2 * period)
        for p, smooth in enumerate(phases):
            cycle[p::period] = smooth(detrended[p::period])
        low = low_loess(moving_mean(moving_mean(moving_mean(cycle, period), period), 3))
        seasonal = cycle[period : period + n] - low
        trend = trend_loess(y - seasonal)
    return trend, seasonal


PARTS = ("trend", "seasonal", "resid")
GAP = "__gap"


def stl(
    df: DataFrame, column: str = "ta", period: int = 24, min_rows: int = MIN_ROWS,
    iterations: int = INNER_ITERATIONS, series: Series = STL_SERIES,
) -> DataFrame:
    """Add trend, seasonal and resid of ``column`` per series.

    The column must hold no nulls inside a series (interpolate or fill first); a
    series with one, or shorter than ``min_rows`` or two periods, gets trend = value
    and seasonal = 0.
    """
    return _one_pass(df, column, period, max(min_rows, 2 * period), iterations, series)


def _one_pass(
    df: DataFrame, column: str, period: int, shortest: int, iterations: int, series: Series, weight: str | None = None
) -> DataFrame:
    """Inner iterations over blocks; with ``weight`` they start from the trend found before."""
    halo = reach(period, iterations)
    indexed = df if IDX in df.columns else series.row_index(df)
    # Python sees the place, the value and what weighs it; the other columns wait in the JVM for the result
    before = [c for c in (weight, "trend" if weight else None) if c]
    narrow = indexed.select(*series.keys, IDX, LEN, column, *before)
    # one null anywhere leaves the whole series as it is, whichever block it is in
    gaps = narrow.groupBy(*series.keys).agg(F.max(F.col(column).isNull() | F.isnan(F.col(column).cast("double"))).alias(GAP))
    laid = series.blocks(narrow, before=halo, after=halo)
    laid = salted_join(laid, gaps, list(series.keys), F.col(IDX)) if series.keys else laid.crossJoin(gaps)
    kept = [f for f in laid.schema if f.name in (*series.keys, IDX)]
    out_schema = T.StructType(kept + [T.StructField(c, T.DoubleType()) for c in PARTS])

    def decompose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(IDX)
        y = pdf[column].to_numpy(dtype=float)
        if pdf[LEN].iloc[0] >= shortest and not pdf[GAP].iloc[0]:
            known = {} if weight is None else {
                "row_weights": pdf[weight].to_numpy(dtype=float), "trend": pdf["trend"].to_numpy(dtype=float)
            }
            place = {"first": int(pdf[IDX].iloc[0]), "whole": int(pdf[LEN].iloc[0])}
            trend, seasonal = stl_arrays(y, period, iterations, **known, **place)
        else:
            trend, seasonal = y, np.zeros(len(y))
        pdf = pdf.assign(trend=trend, seasonal=seasonal, resid=y - trend - seasonal)
        return pdf.loc[pdf[OWN], [f.name for f in out_schema]]

    parts = laid.groupBy(*series.keys, BLOCK).applyInPandas(decompose, out_schema)
    place = F.floor(F.col(IDX) / F.lit(series.block_rows))  # rows of a place meet in bounded groups
    out = indexed.drop(*PARTS).withColumn("__at", place).join(parts.withColumn("__at", place), [*series.keys, "__at", IDX])
    return out.drop("__at", *([] if IDX in df.columns else [IDX, LEN])).select(
        *[c for c in df.columns if c not in PARTS], *PARTS)


def robust_stl(
    df: DataFrame, column: str = "ta", period: int = 24, min_rows: int = MIN_ROWS,
    rounds: int = ROBUST_ROUNDS, iterations: int = ROBUST_ITERATIONS, series: Series = STL_SERIES,
) -> DataFrame:
    """Decomposition that plays down outliers.

    After each round a row weighs (1 - (r/h)^2)^2, where r is its absolute residual and
    h six times the median of its series. The median spans blocks, so every round is a
    job of its own and its rows are written to the shared folder.
    """
    shortest, keys = max(min_rows, 2 * period), list(series.keys)
    out = materialise(_one_pass(series.row_index(df), column, period, shortest, iterations, series))
    for _ in range(rounds):
        medians = exact_quantiles(out.withColumn("__r", F.abs("resid")), keys, "__r", {"__h": 0.5})
        share = F.coalesce(F.try_divide(F.abs("resid"), 6 * F.col("__h")), F.lit(0.0))
        weight = F.when(share <= 0.001, 1.0).when(share <= 0.999, F.pow(1 - share * share, F.lit(2))).otherwise(0.0)
        weighted = salted_join(out, medians, keys, F.col(IDX)).withColumn("__weight", weight).drop("__h")
        out = materialise(_one_pass(weighted, column, period, shortest, iterations, series, "__weight").drop("__weight"))
    return out.drop(IDX, LEN)
