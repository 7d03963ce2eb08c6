"""Runs of missing readings, missing hours, spines and interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermopanel.operators.series import IDX, LEN, SITE_HOURS, Series

SHORT_GAP, LONGEST_GAP = 3, 24


def null_runs(df: DataFrame, column: str, series: Series = SITE_HOURS) -> DataFrame:
    """Consecutive nulls per site: first and last hour and number of rows.

    All nulls between two readings share the number of readings before them, so a
    running count names the run and a plain aggregation (combined before the
    shuffle) measures it, however long it is.
    """
    keys = list(series.keys)
    counted = series.running_sum(df.select(*keys, *series.order, column), {
        "__seen": F.when(F.col(column).isNotNull(), F.lit(1)).otherwise(F.lit(0))
    })
    axis = series.axis
    runs = counted.filter(F.col(column).isNull()).groupBy(*keys, "__seen")
    return runs.agg(
        F.min(axis).alias("start_time"), F.max(axis).alias("end_time"), F.count(F.lit(1)).alias("length")
    ).drop("__seen")


def length_counts(runs: DataFrame, length: str = "length") -> DataFrame:
    return runs.groupBy(length).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc(length))


def outage_runs(
    df: DataFrame, columns: Sequence[str], step: str = "INTERVAL 1 HOUR", series: Series = SITE_HOURS
) -> DataFrame:
    """Runs of rows that lack every given column; a step other than one hour starts a new run."""
    keys = list(series.keys)
    blank = F.lit(True)
    for c in columns:
        blank = blank & F.col(c).isNull()
    rows = df.filter(blank).select(*keys, *series.order)
    w, tm = series.window(), F.col(series.axis)
    before = F.lag(series.axis, 1).over(w)
    starts = series.apply(rows, [
        F.when(before.isNull() | (tm != before + F.expr(step)), F.lit(1)).otherwise(F.lit(0)).alias("__start")
    ], before=1)
    numbered = series.running_sum(starts, {"__run": F.col("__start")})
    return numbered.groupBy(*keys, "__run").agg(
        F.min(series.axis).alias("start_time"),
        F.max(series.axis).alias("end_time"),
        F.count(F.lit(1)).alias("duration"),
    ).drop("__run")


def value_before_nulls(df: DataFrame, column: str, series: Series = SITE_HOURS) -> DataFrame:
    """How often each value stands right before a run of nulls."""
    w = series.window()
    lagged = series.apply(df.select(*series.keys, *series.order, column), [
        F.lag(column, 1).over(w).alias("previous"),
    ], before=1)
    edge = lagged.filter(F.col(column).isNull() & F.col("previous").isNotNull())
    return edge.groupBy("previous").agg(F.count(F.lit(1)).alias("count"))


def hour_spine(df: DataFrame, keys: Sequence[str] = ("branch_id",), tm: str = "tm") -> DataFrame:
    """Every hour from the first to the last of each group, expanded by day, then by hour."""
    ends = df.groupBy(*keys).agg(F.min(tm).alias("__a"), F.max(tm).alias("__b"))
    days = ends.select("*", F.explode(F.expr("sequence(to_date(__a), to_date(__b))")).alias("__day"))
    # spread the days, so that a long series is not expanded by one task
    days = days.repartition(*keys, "__day")
    hours = days.select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("__h"))
    stamped = hours.withColumn(tm, F.expr("cast(__day as timestamp) + make_dt_interval(0, __h)"))
    return stamped.filter(F.col(tm).between(F.col("__a"), F.col("__b"))).select(*keys, tm)


def missing_hours(df: DataFrame, keys: Sequence[str] = ("branch_id",), tm: str = "tm") -> DataFrame:
    return hour_spine(df, keys, tm).join(df.select(*keys, tm), [*keys, tm], "left_anti")


def daily_resample(df: DataFrame, column: str, keys: Sequence[str] = (), tm: str = "tm") -> DataFrame:
    """Calendar-day mean; a day without rows is there with null."""
    keys = list(keys)
    daily = df.groupBy(*keys, F.to_date(tm).alias("date")).agg(F.avg(column).alias(column))
    ends = daily.groupBy(*keys).agg(F.min("date").alias("__a"), F.max("date").alias("__b"))
    spine = ends.select(*keys, F.explode(F.sequence("__a", "__b")).alias("date"))
    return spine.join(daily, [*keys, "date"], "left")


def interpolate_gaps(
    df: DataFrame, columns: Sequence[str], mode: str = "linear", series: Series = SITE_HOURS,
    short_gap: int = SHORT_GAP, longest_gap: int = LONGEST_GAP,
) -> DataFrame:
    """Fill runs of at most ``longest_gap`` nulls by row position.

    Runs up to ``short_gap`` are linear. Longer ones are linear too, or with
    ``mode='quadratic'`` follow the parabola through the readings on both sides and
    the one next to them (linear where that one is missing). Longer runs and leading
    nulls stay; trailing nulls take the last reading. No frame reaches further than
    ``longest_gap`` + 2 rows.
    """
    if mode not in ("linear", "quadratic"):
        raise ValueError(f"unknown mode {mode!r}")
    w, reach = series.window(), longest_gap + 1
    past, future = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, reach)
    anchors, fills = [], {}
    for c in columns:
        known = F.col(c).isNotNull()
        here = F.struct(F.col(IDX).alias("i"), F.col(c).alias("v"), F.lag(c, 1).over(w).alias("outer_v"))
        there = F.struct(F.col(IDX).alias("i"), F.col(c).alias("v"), F.lead(c, 1).over(w).alias("outer_v"))
        anchors += [
            F.when(known, here).alias(f"__a_{c}"),
            F.when(known, there).alias(f"__b_{c}"),
        ]
    sides = []
    for c in columns:
        sides.append(F.last(f"__a_{c}", ignorenulls=True).over(past).alias(f"__p_{c}"))
        sides.append(F.first(f"__b_{c}", ignorenulls=True).over(future).alias(f"__n_{c}"))
        fills[c] = _filled(c, mode, short_gap, longest_gap)
    laid = series.blocks(df, before=reach + 1, after=reach + 1)
    out = laid.select("*", *anchors).select("*", *sides).withColumns(fills)
    return series.own_rows(out, IDX in df.columns).select(*df.columns)


def _filled(c: str, mode: str, short_gap: int, longest_gap: int) -> Column:
    i = F.col(IDX).cast("double")
    p, n = F.col(f"__p_{c}"), F.col(f"__n_{c}")
    x0, y0, x1, y1 = p["i"].cast("double"), p["v"], n["i"].cast("double"), n["v"]
    run = x1 - x0 - 1
    straight = y0 + (y1 - y0) * (i - x0) / (x1 - x0)
    between = straight
    if mode == "quadratic":
        # Newton form: the chord plus a term that vanishes at both readings
        def bend(x2, y2):
            chord = y0 + (y1 - y0) * (x2 - x0) / (x1 - x0)
            return straight + (y2 - chord) / ((x2 - x0) * (x2 - x1)) * (i - x0) * (i - x1)

        curved = F.coalesce(bend(x0 - 1, p["outer_v"]), bend(x1 + 1, n["outer_v"]), straight)
        between = F.when(run <= short_gap, straight).otherwise(curved)
    trailing = F.col(LEN) - 1 - p["i"]
    return (
        F.when(F.col(c).isNotNull(), F.col(c))
        .when(p.isNotNull() & n.isNotNull() & (run <= longest_gap), between)
        .when(p.isNotNull() & n.isNull() & (trailing <= longest_gap), y0)
    )


def interpolate_in_time(df: DataFrame, column: str, series: Series) -> DataFrame:
    """Linear in the time axis between readings; edges take the nearest reading."""
    axis = F.col(series.axis)
    when = F.unix_date(axis) if dict(df.dtypes)[series.axis] == "date" else F.unix_seconds(axis)
    point = F.struct(when.cast("double").alias("t"), F.col(column).alias("v"))
    marked = df.select("*", F.when(F.col(column).isNotNull(), point).alias("__past")).withColumn(
        "__next", F.col("__past")
    )
    both = series.fill(marked, ["__past", "__next"], forward=["__past"], backward=["__next"])
    p, n = F.col("__past"), F.col("__next")
    line = p["v"] + (n["v"] - p["v"]) * F.try_divide(when - p["t"], n["t"] - p["t"])
    value = F.when(F.col(column).isNotNull(), F.col(column)).otherwise(F.coalesce(line, p["v"], n["v"]))
    return both.withColumn(column, value).drop("__past", "__next")
