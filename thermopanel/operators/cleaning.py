"""Missing codes, ranges, night radiation, fills, filters and audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermopanel import rules
from thermopanel.functions import calendar as cal
from thermopanel.functions.numeric import floor_at, numeric_columns, present, unpivot
from thermopanel.operators.numbering import filled_along
from thermopanel.operators.quantiles import exact_quantiles
from thermopanel.operators.series import SITE_HOURS, Series

MISSING = -99.0
EXTRA_MISSING = {"wd": (-9.9,)}


def sentinel_to_null(
    df: DataFrame, columns: Sequence[str] | None = None, extra: Mapping[str, tuple[float, ...]] = EXTRA_MISSING
) -> DataFrame:
    cols = columns or numeric_columns(df, exclude=["id"])
    return df.withColumns({c: F.when(~F.col(c).isin(MISSING, *extra.get(c, ())), F.col(c)) for c in cols})


def sentinel_audit(df: DataFrame, sentinel: float = MISSING, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: does it hold the sentinel, and in how many rows; one pass."""
    cols = columns or numeric_columns(df, exclude=["id"])
    counts = df.agg(*[F.count_if(F.col(c) == sentinel).alias(c) for c in cols])
    long = counts.unpivot([], cols, "variable", "rows")
    return long.withColumn("has_sentinel", (F.col("rows") > 0).cast("int"))


def rows_with_sentinel(df: DataFrame, sentinel: float = MISSING, columns: Sequence[str] | None = None) -> DataFrame:
    cols = columns or numeric_columns(df, exclude=["id"])
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.coalesce(F.col(c) == sentinel, F.lit(False))
    return df.agg(F.count_if(hit).alias("rows"))


def drop_null_target(df: DataFrame, target: str = "heat_demand") -> DataFrame:
    return df.na.drop(subset=[target])


def with_calendar(df: DataFrame, tm: str = "tm") -> DataFrame:
    return df.withColumns(cal.calendar_parts(tm))


def clip_ranges(df: DataFrame) -> DataFrame:
    out = {}
    if "wd" in df.columns:
        out["wd"] = F.pmod(F.col("wd"), F.lit(360.0))
    for c in present(df, ["si", "ws", "rn_day", "rn_hr1"]):
        out[c] = floor_at(c, 0)
    return df.withColumns(out) if out else df


def night_hours_dark(df: DataFrame) -> DataFrame:
    """Set ``si`` to 0 in the night hours of each site's schedule.

    A schedule is a fixed nine rows per site, so it becomes one array per site on a
    table of at most 19 rows, broadcast. A day on which two periods meet belongs to
    both; testing for any matching period never repeats a row.
    """
    rule = F.struct("start_md", "end_md", "night_start", "night_end")
    schedule = rules.night_rule_table(df.sparkSession).groupBy("branch_id").agg(F.collect_list(rule).alias("__nights"))
    md, hour = cal.month_day("tm"), F.hour("tm")
    dark = F.exists(
        "__nights",
        lambda r: md.between(r["start_md"], r["end_md"]) & ((hour >= r["night_start"]) | (hour <= r["night_end"])),
    )
    joined = df.join(F.broadcast(schedule), "branch_id", "left")
    return joined.withColumn("si", F.when(dark, F.lit(0.0)).otherwise(F.col("si"))).select(*df.columns)


def fill_for_scoring(
    df: DataFrame, columns: Sequence[str], series: Series = SITE_HOURS, across_groups: bool = False
) -> DataFrame:
    """Last known value, then 0. ``across_groups`` follows the row id over all sites."""
    filled = filled_along(df, ["id"], columns) if across_groups else series.fill(df, columns)
    return filled.na.fill(0.0, subset=list(columns))


def fill_residual(
    df: DataFrame, columns: Sequence[str], group: str = "cluster_key", across_groups: bool = False,
    series: Series = SITE_HOURS, source: DataFrame | None = None,
) -> DataFrame:
    """Forward then backward fill; over (site, time) of a whole group if ``across_groups``."""
    keys = (group,) if across_groups else (group, "branch_id")
    order = ("branch_id", "tm") if across_groups else ("tm",)
    return replace(series, keys=keys, order=order).fill(df, columns, True, True, source)


def valid_target(df: DataFrame, target: str = "heat_demand", limit: float = 1e10) -> DataFrame:
    y = F.col(target)
    return df.filter(y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")) & (y <= limit))


def above_threshold(df: DataFrame, column: str, threshold: float, site: str | None = None) -> DataFrame:
    hits = df.filter(F.col(column) >= threshold)
    if site is not None:
        hits = hits.filter(F.col("branch_id") == site)
    return hits.orderBy(F.desc(column), "id")


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: Tukey fences from exact quartiles, rows outside, their share."""
    long = unpivot(df, [], columns)
    q = exact_quantiles(long, ["variable"], "value", {"q1": 0.25, "q3": 0.75})
    width = F.col("q3") - F.col("q1")
    fences = q.select(
        "variable", (F.col("q1") - 1.5 * width).alias("lower_bound"), (F.col("q3") + 1.5 * width).alias("upper_bound")
    )
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    # the fences are one row per given column
    marked = long.join(F.broadcast(fences), "variable")
    return marked.groupBy("variable", "lower_bound", "upper_bound").agg(
        F.count_if(outside).alias("num_outliers"),
        F.round(100.0 * F.count_if(outside) / F.count(F.lit(1)), 2).alias("percent_outliers"),
    )


def drop_service_columns(
    df: DataFrame, columns: Sequence[str] = ("season", "wd", "quarter", "day_of_week", "date")
) -> DataFrame:
    return df.drop(*columns)


def date_slice(df: DataFrame, start: str, end: str, site: str | None = None, closed: bool = False) -> DataFrame:
    """Rows from ``start`` up to ``end``; the end belongs to a closed slice only."""
    first, last, tm = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"), F.col("tm")
    out = df.filter((tm >= first) & ((tm <= last) if closed else (tm < last)))
    return out.filter(F.col("branch_id") == site) if site is not None else out


def unique_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once. Counting first keeps a repeated key out of one task."""
    once = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n = 1").drop("__n")
    return df.join(once, list(keys), "left_semi")


def finite_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Infinite values become null, then rows with any null among the columns go."""
    inf = float("inf")
    return df.withColumns({c: F.when(F.abs(c) < inf, F.col(c)) for c in columns}).na.drop("any", subset=list(columns))


def infinite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.abs(c) == float("inf")).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "variable", "infinite")


def domain_audit(df: DataFrame, columns: Sequence[str], rain: Sequence[str] = ("rn_day", "rn_hr1")) -> DataFrame:
    """Per column: negative readings that are no missing code, zeros, nulls."""

    def rule(c: str, which: str) -> Column:
        v = F.col(c)
        known = (MISSING, *EXTRA_MISSING.get(c, ()))
        test = {"negative": (v < 0) & ~v.isin(*known), "zero": v == 0, "missing": v.isNull() | v.isin(*known)}[which]
        return F.count_if(test)

    kinds = ("negative", "zero", "missing")
    entry = [F.struct(F.lit(c).alias("variable"), *[rule(c, k).alias(k) for k in kinds]) for c in columns]
    return df.agg(F.array(*entry).alias("a")).select(F.inline("a"))


def strict_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast to double; under ANSI mode unreadable text raises."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
