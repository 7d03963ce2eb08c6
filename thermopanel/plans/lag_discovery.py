"""Which lags matter: residual cross-correlation and correlation of lagged features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopanel.functions.calendar import is_long_summer
from thermopanel.operators import aggregates, crosscorr, stats, stl
from thermopanel.operators.lags import change_exprs, lag_exprs
from thermopanel.operators.series import IDX, LEN, SITE_HOURS

SEASONS = replace(stl.STL_SERIES, keys=("is_summer",))
SERIES = replace(stl.STL_SERIES, keys=("is_summer", "variable"))


def residual_lags(
    df: DataFrame, target: str, variables: Sequence[str], max_lag: int = 100, robust: bool = True, period: int = 24
) -> DataFrame:
    """Best lag per season and variable between residuals of hourly means over sites."""
    marked = df.withColumn("is_summer", is_long_summer(F.month("tm")).cast("int"))
    hourly = aggregates.group_means(marked, ["is_summer", "tm"], [target, *variables])
    decompose = stl.robust_stl if robust else stl.stl
    # all columns and seasons are series of one table, so that a round of weights is one job for all of them
    columns = [target, *variables]
    long = hourly.unpivot(["is_summer", "tm"], [F.col(f"{c}_mean").alias(c) for c in columns], "variable", "v")
    resid = decompose(long.filter(F.col("v").isNotNull()), "v", period, series=SERIES)
    wide = resid.groupBy("is_summer", "tm").pivot("variable", columns).agg(F.first("resid"))
    ccf = crosscorr.cross_correlation(wide, target, variables, max_lag, SEASONS)
    return crosscorr.best_lag(ccf, ["is_summer", "variable"])


def lagged_correlations(
    df: DataFrame, target: str, variables: Sequence[str], longest: int = 23, change_of: str = "ta",
    shifts: Sequence[int] = (1, 3, 5, 7), by: Sequence[str] = ("branch_id",),
) -> DataFrame:
    """Correlation of the target with every variable, its lags and the changes of one of them."""
    w = SITE_HOURS.window()
    grid = lag_exprs(w, {c: range(1, longest + 1) for c in variables}, "{c}_shift_{n}h")
    laid = SITE_HOURS.blocks(df, before=max(longest, *shifts)).select("*", *grid, *change_exprs(w, change_of, shifts))
    wide = SITE_HOURS.own_rows(laid)
    features = [c for c in wide.columns if c not in df.columns and c not in (IDX, LEN)] + list(variables)
    return stats.correlation_with(wide, target, features, list(by))


def common_features(df: DataFrame, target: str, variables: Sequence[str], n: int = 50, without: Sequence[str] = ()) -> DataFrame:
    return stats.common_top_features(lagged_correlations(df, target, variables), n, without=without)
