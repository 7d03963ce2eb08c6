"""Correlation tables, feature selection, tests and simple fits."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermopanel.functions.numeric import col
from thermopanel.operators.gram import correlations


def pearson(a: str | Column, b: str | Column) -> Column:
    """Correlation over the rows that have both; null (no error) for a constant column."""
    a, b = col(a).cast("double"), col(b).cast("double")
    both = a.isNotNull() & b.isNotNull()
    spread = F.stddev_pop(F.when(both, a)) * F.stddev_pop(F.when(both, b))
    return F.try_divide(F.covar_pop(a, b), spread)


def correlation_matrix(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every two columns over the rows that have both: (keys, a, b, corr)."""
    columns = list(columns)
    half = correlations(df, columns, columns, keys, half=True)
    names = F.lit(columns)
    first, second = F.get(names, F.floor(F.col("pair") / len(columns)).cast("int")), F.get(names, F.col("pair") % len(columns))
    named = half.select(*keys, first.alias("a"), second.alias("b"), "corr")
    both_ways = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    return named.select(*keys, "corr", F.inline(both_ways))


def correlation_with(df: DataFrame, target: str, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Correlation of each column with the target: (keys, feature, corr)."""
    columns = list(columns)
    return correlations(df, columns, [target], keys).select(*keys, F.get(F.lit(columns), F.col("pair")).alias("feature"), "corr")


def correlation_difference(
    long: DataFrame, split: str, first, second, keys: Sequence[str] = ("feature",)
) -> DataFrame:
    """Correlations of two groups side by side and their absolute difference."""
    by = F.col(split)
    out = long.groupBy(*keys).agg(
        F.max(F.when(by == first, F.col("corr"))).alias(f"{first}_corr"),
        F.max(F.when(by == second, F.col("corr"))).alias(f"{second}_corr"),
    )
    return out.withColumn("diff", F.abs(F.col(f"{first}_corr") - F.col(f"{second}_corr")))


def feature_ranking(long: DataFrame) -> DataFrame:
    """Mean absolute correlation over sites and the spread between sites, per feature."""
    return long.groupBy("feature").agg(
        F.avg(F.abs("corr")).alias("mean_abs_corr"), (F.max("corr") - F.min("corr")).alias("max_diff")
    )


def common_top_features(long: DataFrame, n: int, site: str = "branch_id", without: Sequence[str] = ()) -> DataFrame:
    """Features among the n strongest of every site; names holding a given text are left out."""
    known = long.filter(F.col("corr").isNotNull())
    # a site has one row per feature column, so its window stays as small as the schema
    strongest = Window.partitionBy(site).orderBy(F.desc(F.round(F.abs("corr"), 9)), "feature")
    top = known.withColumn("__r", F.row_number().over(strongest)).filter(F.col("__r") <= n)
    shared = top.groupBy("feature").agg(F.count_distinct(site).alias("__sites"))
    sites = known.agg(F.count_distinct(site).alias("__all"))
    out = shared.join(F.broadcast(sites), F.col("__sites") == F.col("__all")).select("feature")
    for text in without:
        out = out.filter(~F.col("feature").contains(text))
    return out


def strong_common_features(
    long: DataFrame, threshold: float = 0.3, season: str = "season", site: str = "branch_id"
) -> DataFrame:
    """Per season, features beyond the threshold at every site, by mean absolute correlation."""
    strong = long.filter(F.abs("corr") >= threshold)
    found = strong.groupBy(season, "feature").agg(
        F.avg(F.abs("corr")).alias("mean_abs_corr"), F.count_distinct(site).alias("__sites")
    )
    sites = long.groupBy(season).agg(F.count_distinct(site).alias("__all"))
    joined = found.join(sites, season).filter(F.col("__sites") == F.col("__all"))
    return joined.select(season, "feature", "mean_abs_corr").orderBy(season, F.desc("mean_abs_corr"), "feature")


def welch_test(df: DataFrame, value: str, group: str, first, second) -> DataFrame:
    """Unequal-variance t-test between two groups: t, degrees of freedom, two-sided p."""
    stats = {}
    for tag, level in (("a", first), ("b", second)):
        v = F.when(F.col(group) == level, F.col(value))
        stats |= {f"n_{tag}": F.count(v), f"m_{tag}": F.avg(v), f"v_{tag}": F.var_samp(v)}
    one = df.agg(*[e.alias(n) for n, e in stats.items()])
    ea, eb = F.col("v_a") / F.col("n_a"), F.col("v_b") / F.col("n_b")
    t = F.try_divide(F.col("m_a") - F.col("m_b"), F.sqrt(ea + eb))
    freedom = F.try_divide(
        (ea + eb) * (ea + eb), ea * ea / (F.col("n_a") - 1) + eb * eb / (F.col("n_b") - 1)
    )
    return one.select(t.alias("t"), freedom.alias("df")).withColumn("p", _student_p("t", "df"))


@F.pandas_udf(T.DoubleType())
def _student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([
        student_two_sided(a, b) if pd.notna(a) and pd.notna(b) else None for a, b in zip(t, df)
    ], dtype="float64")


def student_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|): the regularised incomplete beta function at df / (df + t^2)."""
    return _beta_share(df / 2.0, 0.5, df / (df + t * t))


def _beta_share(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _beta_share(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    # continued fraction, evaluated from its tail
    tail = 0.0
    for m in range(400, 0, -1):
        half, odd = divmod(m, 2)
        if odd:
            step = -(a + half) * (a + b + half) * x / ((a + 2 * half) * (a + 2 * half + 1))
        else:
            step = half * (b - half) * x / ((a + 2 * half - 1) * (a + 2 * half))
        tail = step / (1.0 + tail)
    return front / (a * (1.0 + tail))


def variance_inflation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Variance inflation per column over complete rows: the diagonal of the inverse
    correlation matrix, which one aggregation reduces to columns x columns numbers."""
    columns = list(columns)
    complete = df.select(*columns).na.drop("any")
    cells = F.array_sort(F.collect_list(F.struct("pair", "corr")))
    row = correlations(complete, columns, columns).agg(F.transform(cells, lambda c: c["corr"]).alias("m"))
    names = F.lit(columns)
    row = row.select(F.arrays_zip(names.alias("feature"), _inverse_diagonal("m").alias("vif")).alias("z"))
    return row.select(F.inline("z")).toDF("feature", "vif")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _inverse_diagonal(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for matrices in batches:
        out = []
        for m in matrices:
            cells = np.asarray(m, dtype=float)
            values = cells.reshape(round(len(cells) ** 0.5), -1)
            try:
                out.append(np.diag(np.linalg.inv(values)).tolist())
            except np.linalg.LinAlgError:
                out.append([float("inf")] * len(values))
        yield pd.Series(out)


def linear_fits(df: DataFrame, target: str, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of the target on each column, overall or per group."""
    entries = []
    for c in columns:
        both = F.col(c).isNotNull() & F.col(target).isNotNull()
        entries.append(F.struct(
            F.lit(c).alias("feature"), F.count_if(both).alias("n"),
            F.regr_slope(target, c).alias("slope"), F.regr_intercept(target, c).alias("intercept"),
            F.regr_r2(target, c).alias("r2"),
        ))
    return df.groupBy(*keys).agg(F.array(*entries).alias("__f")).select(*keys, F.inline("__f"))
