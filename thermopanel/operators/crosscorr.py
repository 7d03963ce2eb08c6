"""Cross-correlation of the target with each variable over many lags."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermopanel.functions.numeric import unpivot
from thermopanel.operators.series import BLOCK, IDX, OWN, SITE_HOURS, Series


def _block_sums(names: Sequence[str], max_lag: int):
    """Per lag k, over the block's own rows t: number, sum of x[t+k] y[t], of x[t+k] and of y[t]."""

    def work(block: pa.Table) -> pa.Table:
        block = block.sort_by(IDX)
        x, y = block.column("x").to_numpy(), block.column("y").to_numpy()
        # own rows come first, the halo behind them
        own = int(np.count_nonzero(block.column(OWN).to_numpy()))
        ends = [max(0, min(own, len(x) - k)) for k in range(1, max_lag + 1)]
        sums = [(n, x[k:k + n] @ y[:n], x[k:k + n].sum(), y[:n].sum()) for k, n in enumerate(ends, 1)]
        key = {c: pa.repeat(block.column(c)[0], max_lag) for c in names}
        count, sxy, sx, sy = zip(*sums)
        return pa.table({
            **key, "lag": pa.array(range(1, max_lag + 1), pa.int32()), "n": pa.array(count, pa.int64()),
            "sxy": pa.array(sxy, pa.float64()), "sx": pa.array(sx, pa.float64()), "sy": pa.array(sy, pa.float64()),
        })

    return work


def cross_correlation(
    df: DataFrame, target: str, variables: Sequence[str], max_lag: int = 100, series: Series = SITE_HOURS
) -> DataFrame:
    """ccf(k) = mean of (x[t+k] - mean x)(y[t] - mean y) over the n-k pairs / (sd x * sd y).

    x is the target, y the variable, both over the rows that have both; population
    standard deviations. One row per series, variable and lag 1..max_lag, with the
    95 % band 1.96 / sqrt(n).

    A block of rows with a halo of ``max_lag`` turns into one product of arrays per lag; what is summed over blocks are four
    numbers per lag, centred afterwards by the means of the series.
    """
    keys = [*series.keys, "variable"]
    long = unpivot(df.select(*series.keys, *series.order, target, *variables), [*series.keys, *series.order, target],
                   variables, "variable", "y").withColumnRenamed(target, "x")
    long = long.withColumn("x", F.col("x").cast("double")).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    lane = series.with_keys(*keys)
    laid = lane.blocks(long, after=max_lag).select(*keys, BLOCK, IDX, OWN, "x", "y")
    fields = [*[laid.schema[k] for k in keys], T.StructField("lag", T.IntegerType()), T.StructField("n", T.LongType())]
    fields += [T.StructField(c, T.DoubleType()) for c in ("sxy", "sx", "sy")]
    parts = laid.groupBy(*keys, BLOCK).applyInArrow(_block_sums(keys, max_lag), T.StructType(fields))
    sums = parts.groupBy(*keys, "lag").agg(*[F.sum(c).alias(c) for c in ("n", "sxy", "sx", "sy")])
    totals = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("all"), *[F.avg(c).alias(f"m{c}") for c in "xy"], *[F.stddev_pop(c).alias(f"d{c}") for c in "xy"])
    n, mx, my = F.col("n"), F.col("mx"), F.col("my")
    centred = F.col("sxy") - mx * F.col("sy") - my * F.col("sx") + n * mx * my
    value = F.try_divide(F.try_divide(centred, n), F.col("dx") * F.col("dy"))
    band = F.lit(1.96) / F.sqrt("all")
    return sums.join(totals, keys).select(*keys, "lag", value.alias("ccf"), band.alias("band"))


def best_lag(ccf: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lag of the strongest correlation by absolute value; the smallest among ties."""
    strongest = F.max_by(F.struct("lag", "ccf"), F.struct(F.abs("ccf"), -F.col("lag")))
    best = ccf.filter(F.col("ccf").isNotNull()).groupBy(*keys).agg(strongest.alias("__b"))
    return best.select(*keys, F.col("__b.lag").alias("best_lag"), F.col("__b.ccf").alias("ccf_value"))
