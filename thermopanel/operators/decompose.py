"""Classical additive decomposition by centred moving averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopanel.operators.joins import salted_join
from thermopanel.operators.series import IDX, Series

DAILY = Series(keys=(), order=("date",), axis="date", span=1024)


def additive_decomposition(
    df: DataFrame, column: str, period: int, series: Series = DAILY, prefix: str = ""
) -> DataFrame:
    """Add trend, seasonal and residual of each series.

    Trend: centred mean over one period (for an even period the two end rows count
    half); null where the frame is cut off. Seasonal: mean of value - trend per phase
    (row position modulo period) less the mean over phases.
    """
    half, even = period // 2, period % 2 == 0
    w, keys = series.window(), list(series.keys)
    full = w.rowsBetween(-half, half)
    total = F.sum(column).over(full)
    if even:
        total = total - (F.lag(column, half).over(w) + F.lead(column, half).over(w)) / 2
    trend = F.when(F.count(column).over(full) == 2 * half + 1, total / period)
    laid = series.blocks(df, before=half, after=half)
    smooth = laid.select("*", trend.alias("__trend"), F.pmod(F.col(IDX), F.lit(period)).alias("__phase"))
    smooth = series.own_rows(smooth)

    phases = (
        smooth.groupBy(*keys, "__phase")
        .agg(F.avg(F.col(column) - F.col("__trend")).alias("__raw"))
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("__phase", "__raw")).alias("__all"), F.avg("__raw").alias("__mean"))
        .select(*keys, "__mean", F.inline("__all"))
        .select(*keys, "__phase", (F.col("__raw") - F.col("__mean")).alias("__seasonal"))
    )
    joined = salted_join(smooth, phases, [*keys, "__phase"], F.col(series.axis))
    return joined.withColumns({
        f"{prefix}trend": F.col("__trend"),
        f"{prefix}seasonal": F.col("__seasonal"),
        f"{prefix}resid": F.col(column) - F.col("__trend") - F.col("__seasonal"),
    }).drop("__phase", "__trend", "__seasonal")


def daily_mean(df: DataFrame, column: str, keys: Sequence[str] = (), tm: str = "tm") -> DataFrame:
    return df.groupBy(*keys, F.to_date(tm).alias("date")).agg(F.avg(column).alias(column))
