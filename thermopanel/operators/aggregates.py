"""Reports, group statistics, pivots, histograms and daily change tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermopanel.functions import calendar as cal
from thermopanel.functions import weather
from thermopanel.functions.numeric import unpivot
from thermopanel.operators.joins import inner_chain, salted_join
from thermopanel.operators.quantiles import exact_mode, exact_quantiles
from thermopanel.operators.series import SITE_HOURS, Series

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def rows() -> Column:
    return F.count(F.lit(1))


# ---- reports --------------------------------------------------------------
def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with nulls: how many, and the share in percent."""
    cols = list(columns or df.columns)
    nulls = df.agg(rows().alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = nulls.unpivot(["__rows"], cols, "variable", "missing_count").filter("missing_count > 0")
    share = (F.col("missing_count") * 100.0 / F.col("__rows")).alias("missing_percent")
    return long.select("variable", "missing_count", share).orderBy(F.desc("missing_count"), "variable")


def missing_by_site(df: DataFrame, column: str = "ta") -> DataFrame:
    nulls = df.filter(F.col(column).isNull()).groupBy("branch_id").agg(rows().alias("missing"))
    return nulls.orderBy(F.desc("missing"), "branch_id")


def describe(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles and max per column (and group)."""
    keys = [*keys, "variable"]
    long = unpivot(df, keys[:-1], columns).filter(F.col("value").isNotNull())
    basic = long.groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    return basic.join(exact_quantiles(long, keys, "value", QUARTILES), keys)


def central_tendency(df: DataFrame, column: str, keys: Sequence[str] = ("branch_id",)) -> DataFrame:
    keys = list(keys)
    mean = df.groupBy(*keys).agg(F.avg(column).alias("mean"))
    median = exact_quantiles(df, keys, column, {"median": 0.5})
    return inner_chain([mean, median, exact_mode(df, keys, column)], keys)


def sample_skewness(column: str) -> Column:
    """Bias-corrected skewness; Spark's own is the population form."""
    n = F.count(column)
    return F.when(n > 2, F.skewness(column) * F.sqrt(n * (n - 1)) / (n - 2))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(rows().alias("count")).orderBy(F.desc("count"), column)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct values per column: two plain aggregations, no key is expanded per column."""
    long = df.unpivot([], [F.col(c).cast("string").alias(c) for c in columns], "variable", "value")
    return long.filter(F.col("value").isNotNull()).distinct().groupBy("variable").agg(rows().alias("distinct"))


# ---- group means and pivots ----------------------------------------------
def group_means(df: DataFrame, keys: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"{c}_mean") for c in columns])


def pivot_mean(
    df: DataFrame, row: Sequence[str], column: str, values: Sequence, value: str, prefix: str = ""
) -> DataFrame:
    wide = df.groupBy(*row).pivot(column, list(values)).agg(F.avg(value))
    return wide.select(*row, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values])


PATTERN_CELLS = (
    [f"hour_{h}" for h in range(24)]
    + [f"bucket_{b}" for b in range(8)]
    + [f"month_{m}" for m in range(1, 13)]
    + [f"season_{s}" for s in cal.SEASON_LABELS]
)


def pattern_matrix(df: DataFrame, target: str = "heat_demand", site: str = "branch_id", tm: str = "tm") -> DataFrame:
    """Per site the median target by hour, 3-hour bucket, month and season: 48 columns."""
    hour, month = F.hour(tm), F.month(tm)
    cells = F.array(
        F.concat(F.lit("hour_"), hour),
        F.concat(F.lit("bucket_"), cal.hour_group(hour)),
        F.concat(F.lit("month_"), month),
        F.concat(F.lit("season_"), cal.season(month)),
    )
    long = df.select(site, F.col(target).alias("value"), F.explode(cells).alias("cell"))
    medians = exact_quantiles(long, [site, "cell"], "value", {"median": 0.5})
    return medians.groupBy(site).pivot("cell", PATTERN_CELLS).agg(F.first("median"))


def pattern_means_joined(df: DataFrame, target: str = "heat_demand", site: str = "branch_id") -> DataFrame:
    """Mean target by hour bucket, month, season and weekend, four tables joined on the site."""
    tm, month = F.col("tm"), F.month("tm")
    marked = df.select(
        site, target, cal.hour_group(F.hour(tm)).alias("bucket"), month.alias("month"),
        cal.season(month).alias("season"), (F.weekday(tm) >= 5).cast("int").alias("weekend"),
    )
    parts = [("bucket", range(8)), ("month", range(1, 13)), ("season", cal.SEASON_LABELS), ("weekend", (0, 1))]
    tables = [pivot_mean(marked, [site], name, values, target, f"{name}_") for name, values in parts]
    return inner_chain(tables, [site])


def site_profile(df: DataFrame, target: str = "heat_demand", site: str = "branch_id") -> DataFrame:
    return df.groupBy(site).agg(
        F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"),
        F.max(target).alias("max"), F.min(target).alias("min"),
    )


def mean_by_sector(df: DataFrame, target: str = "heat_demand", wd: str = "wd") -> DataFrame:
    """Mean target per wind sector, in the order of the compass; unknown directions left out."""
    names = F.array(*[F.lit(s) for s in weather.SECTORS8])
    known = df.withColumn("sector", weather.wind_sector8(wd)).filter(F.col("sector") != "Unknown")
    means = known.groupBy("sector").agg(F.avg(target).alias("mean"))
    return means.withColumn("sector_no", F.array_position(names, F.col("sector")).cast("int")).orderBy("sector_no")


# ---- histograms and box statistics ---------------------------------------
def wind_rose(df: DataFrame, wd: str = "wd", width: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Counts per direction bin [0, 360); empty bins are there with 0."""
    by, n = list(by), 360 // width
    bins = df.filter((F.col(wd) >= 0) & (F.col(wd) < 360)).groupBy(
        *by, F.floor(F.col(wd) / width).cast("int").alias("bin")
    ).agg(rows().alias("count"))
    spread = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("bin")
    spine = df.select(*by).distinct().select("*", spread) if by else df.sparkSession.range(1).select(spread)
    out = spine.join(bins, [*by, "bin"], "left")
    return out.select(*by, "bin", F.coalesce("count", F.lit(0)).alias("count"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed; empty bins count 0."""
    known = df.select(F.col(column).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    low, high = known.agg(F.min("__v")).scalar(), known.agg(F.max("__v")).scalar()
    placed = known.select("__v", low.alias("__lo"), ((high - low) / bins).alias("__width"))
    place = F.least(F.floor(F.try_divide(F.col("__v") - F.col("__lo"), F.col("__width"))), F.lit(bins - 1))
    counts = placed.groupBy(F.coalesce(place, F.lit(0)).cast("int").alias("bin")).agg(rows().alias("count"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    start = low + F.col("bin") * ((high - low) / bins)
    return spine.join(counts, "bin", "left").select(
        "bin", F.coalesce("count", F.lit(0)).alias("count"), start.alias("bin_start")
    )


def box_statistics(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Quartiles, mean, and whiskers: the outermost values within 1.5 interquartile ranges."""
    keys = list(keys)
    known = df.select(*keys, column).filter(F.col(column).isNotNull())
    quartiles = exact_quantiles(known, keys, column, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    # whiskers need the fences on every row; equal values are counted first
    counted = known.groupBy(*keys, column).agg(rows().alias("__n"))
    joined = salted_join(counted, quartiles, keys, F.col(column), how="inner")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col(column).between(F.col("q1") - reach, F.col("q3") + reach)
    return joined.groupBy(*keys, "q1", "median", "q3").agg(
        (F.sum(F.col(column) * F.col("__n")) / F.sum("__n")).alias("mean"),
        F.min(F.when(inside, F.col(column))).alias("whisker_low"),
        F.max(F.when(inside, F.col(column))).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("__n")).otherwise(0)).alias("outliers"),
    )


# ---- rain and daily change ------------------------------------------------
def rain_row_match(df: DataFrame, series: Series = SITE_HOURS) -> DataFrame:
    """Does the change of the daily rain equal the hourly rain (2 decimals)?"""
    step = F.col("rn_day") - F.lag("rn_day", 1).over(series.window())
    diffed = series.apply(df, [step.alias("__step")], before=1)
    change = F.coalesce("__step", F.lit(0.0))
    match = F.coalesce(F.round("rn_hr1", 2) == F.round(change, 2), F.lit(False)).cast("int")
    return diffed.withColumns({"rn_day_diff": change, "rn_hr1_diff_match": match}).drop("__step")


def rain_day_match(df: DataFrame, keys: Sequence[str] = ("branch_id",)) -> DataFrame:
    """Sum of hourly rain of a date against the daily rain at 00h of that date."""
    keys = [*keys, "date"]
    dated = df.withColumn("date", F.to_date("tm"))
    midnight = dated.filter(F.hour("tm") == 0).select(*keys, F.col("rn_day").alias("rn_day_00h"))
    total = dated.groupBy(*keys).agg(F.coalesce(F.sum("rn_hr1"), F.lit(0.0)).alias("rn_hr1_sum"))
    match = F.coalesce(F.round("rn_day_00h", 2) == F.round("rn_hr1_sum", 2), F.lit(False)).cast("int")
    return midnight.join(total, keys).withColumn("match", match)


DAY_SERIES = Series(keys=("branch_id",), order=("date",), axis="date", span=1024)


def daily_change(df: DataFrame, column: str = "ta", series: Series = DAY_SERIES) -> DataFrame:
    """Per site and date mean, max, min, range, and their change against the day before."""
    daily = df.groupBy(*series.keys, F.to_date("tm").alias("date")).agg(
        F.avg(column).alias(f"{column}_mean"), F.max(column).alias(f"{column}_max"),
        F.min(column).alias(f"{column}_min"),
    )
    w, out = series.window(), []
    for part in ("mean", "max", "min"):
        name = f"{column}_{part}"
        earlier = F.lag(name, 1).over(w)
        out.append((F.col(name) - earlier).alias(f"{name}_diff"))
        out.append(F.try_divide(F.col(name) - earlier, earlier).alias(f"{name}_pct_change"))
    out.append((F.col(f"{column}_max") - F.col(f"{column}_min")).alias(f"{column}_range"))
    return series.apply(daily, out, before=1)


def demand_against_change(df: DataFrame, target: str = "heat_demand", column: str = "ta") -> DataFrame:
    """Daily demand next to the relative temperature change; incomplete days left out."""
    keys = ["branch_id", "date"]
    demand = df.groupBy("branch_id", F.to_date("tm").alias("date")).agg(
        F.avg(target).alias(f"{target}_mean"), F.max(target).alias(f"{target}_max"), F.min(target).alias(f"{target}_min")
    )
    pct = [f"{column}_{p}_pct_change" for p in ("mean", "max", "min")]
    merged = demand.join(daily_change(df, column).select(*keys, *pct), keys)
    return merged.na.drop("any").orderBy(pct[0], *keys)
