"""The composed feature job: raw panel to one feature frame per model group."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermopanel import rules
from thermopanel.functions import calendar as cal
from thermopanel.functions import weather
from thermopanel.functions.numeric import present
from thermopanel.models.splits import with_cluster_key
from thermopanel.operators import cleaning, gaps, joins, lags, stl
from thermopanel.operators.series import IDX, LEN, SITE_HOURS, Series
from thermopanel.session import materialise
from thermopanel.sources.panels import WEATHER

GROUP_SITES = Series(keys=("cluster_key", "branch_id"), order=("tm",), axis="tm")


def base_frame(raw: DataFrame, is_test: bool = False) -> DataFrame:
    """Steps that are the same for all groups: clean, date, clip, darken nights, wind."""
    df = cleaning.drop_null_target(cleaning.sentinel_to_null(raw))
    df = cleaning.night_hours_dark(cleaning.clip_ranges(cleaning.with_calendar(df)))
    if is_test:
        df = cleaning.fill_for_scoring(df, present(df, WEATHER))
    df = df.withColumns(weather.wind_vector())
    return df.withColumns({"wd_group": weather.wind_sector4(), "ws_group": weather.wind_speed_class()})


def with_trend(df: DataFrame, column: str, min_rows: int, series: Series) -> DataFrame:
    """Trend and seasonal part of a gap-free column per site."""
    return stl.stl(df, column, min_rows=min_rows, series=replace(series, block_rows=stl.STL_BLOCK_ROWS)).drop("resid")


def gap_free(df: DataFrame, column: str, name: str, series: Series, source: DataFrame) -> DataFrame:
    """A copy of the column without nulls: short gaps interpolated, the rest filled from
    the neighbouring readings. The source holds the column as it was read."""
    copy = gaps.interpolate_gaps(df.withColumn(name, F.col(column)), [name], series=series)
    return series.fill(copy, [name], True, True, source.withColumn(name, F.col(column)))


def site_trend(df: DataFrame, column: str | None, rows: DataFrame) -> DataFrame:
    """Trend of a column known to be gap-free, or of a gap-free copy of ``ta``."""
    if column is None:
        df, column = gap_free(df, "ta", "__ta", GROUP_SITES, rows), "__ta"
    return with_trend(df, column, stl.MIN_ROWS, GROUP_SITES).drop("__ta")


def grouped_base(raw: DataFrame, keys: Sequence[str], is_test: bool = False, decompose: bool = True) -> DataFrame:
    """Cleaned rows of all asked groups with their group and place in it: the panel is read once for all of them.

    The rows are written out, as every group's summaries and blocks start from them.
    """
    clusters = sorted({int(key[len("cluster"):][0]) for key in keys})
    sites = [site for c in clusters for site in rules.cluster_members(c)]
    df = base_frame(raw.filter(F.col("branch_id").isin(sites)), is_test)
    df = base = materialise(with_cluster_key(joins.with_cluster(df)).drop("cluster_id"))
    if decompose and 2 in clusters:
        # the trend of these sites runs through both seasons
        split = F.col("branch_id").isin(rules.cluster_members(2))
        two = base.filter(split)
        two = gap_free(SITE_HOURS.row_index(two), "ta", "__ta", SITE_HOURS, two)
        two = with_trend(two, "__ta", 72, SITE_HOURS).drop("__ta", IDX, LEN)
        df = two.unionByName(base.filter(~split), allowMissingColumns=True) if len(clusters) > 1 else two
    return materialise(GROUP_SITES.row_index(df.filter(F.col("cluster_key").isin(list(keys))), source=base))


def group_frame(raw: DataFrame, cluster_key: str, is_test: bool = False, decompose: bool = True, **options) -> DataFrame:
    """Features of one model group, one row per site and hour; see :func:`frame_of`."""
    return frame_of(grouped_base(raw, [cluster_key], is_test, decompose), cluster_key, decompose, **options)


def frame_of(
    base: DataFrame,
    cluster_key: str,
    decompose: bool = True,
    padded: bool = True,
    fill: str | None = "site",
    lag_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Features of one model group from :func:`grouped_base`.

    ``padded``: the first hours of the group's lag list borrow from the head of their
    own series; else they are null. ``fill`` says how nulls are filled: 'site' fills
    the readings of each site before lags are taken; 'group' takes the group's lags
    first and then fills readings and lags over the whole group in (site, time) order,
    which differs in the first hours of a site only; None leaves nulls. Padding and
    backward fills look ahead in time: switch both off to train without leakage.
    """
    df = rows = base.filter(F.col("cluster_key") == cluster_key)
    through_seasons = cluster_key.startswith("cluster2")
    if not (decompose and through_seasons):
        df = rows = rows.drop("trend", "seasonal")

    wanted = {c: n for c, n in rules.LAG_LISTS[cluster_key].items() if c in df.columns}
    if lag_columns is not None:
        wanted = {c: n for c, n in wanted.items() if c in lag_columns}
    readings = [*present(df, WEATHER), "wd_rad", "wd_sin", "wd_cos"]
    w, longest = GROUP_SITES.window(), lags.longest_lag(wanted)
    means, widest = lags.past_frames(lags.LAG_COLUMNS, lags.ROLL_HOURS), max(lags.ROLL_HOURS) + 1
    general = lags.lag_exprs(w, {c: lags.LAG_HOURS for c in lags.LAG_COLUMNS})

    def with_listed(laid: DataFrame, also: Sequence[Column] = ()) -> DataFrame:
        if padded:
            return lags.with_padded_lags(laid, w, wanted, also)
        return laid.select("*", *lags.lag_exprs(w, wanted, "{c}_plag{n}"), *also)

    # the daily flags read their own narrow fill: a summary of the wide frame would compute it twice
    days = rows.select("cluster_key", "branch_id", "tm", "date", "ta")
    if fill:
        days = cleaning.fill_residual(days, ["ta"], across_groups=fill == "group", source=days)
    flags = joins.daily_temperature_flags(days)

    listed: dict[str, Column] = {}
    if fill == "group":
        df, listed = lags.group_filled(df, readings, wanted, padded, GROUP_SITES)
    elif fill == "site":
        df = GROUP_SITES.fill(df, readings, True, True, source=rows)
    if decompose and not through_seasons:
        df = site_trend(df, "ta" if fill else None, rows)
    df = joins.join_daily(joins.with_temperature_zone(lags.running_radiation(df)), flags)
    scalars = {
        **cal.cyclical_parts(),
        **weather.temperature_features(),
        "rain_intensity": weather.rain_intensity(),
        "day_flag": cal.day_flag("hour"),
        "season_group": cal.season_group("month"),
        "dew_point": weather.dew_point(),
        "DI_interaction": weather.discomfort_interaction(cal.season_group("month")),
        "heat_demand_log": F.log1p("heat_demand"),
    }
    # means first, while rows are narrow, as every window node copies whole rows; then all
    # lags and scalar features in one projection, after the shuffle
    laid = lags.with_frame_means(GROUP_SITES.blocks(df, before=max(longest, widest)), w, means)
    added = [*general, *[c.alias(name) for name, c in scalars.items()]]
    if fill == "group":
        wide = laid.select("*", *[c.alias(name) for name, c in listed.items()], *added)
        wide = wide.drop("__site", *[lags.KNOWN.format(c=c) for c in wanted])
    else:
        wide = with_listed(laid, added)
    return cleaning.drop_service_columns(GROUP_SITES.own_rows(wide))


def group_frames(
    raw: DataFrame, keys: Sequence[str] = rules.CLUSTER_KEYS, is_test: bool = False, decompose: bool = True, **options
) -> dict[str, DataFrame]:
    """A frame per group, from one pass over the panel."""
    base = grouped_base(raw, keys, is_test, decompose)
    return {key: frame_of(base, key, decompose, **options) for key in keys}


def all_groups(raw: DataFrame, keys: Sequence[str] = rules.CLUSTER_KEYS, **options) -> DataFrame:
    """All groups in one frame; a lag only some groups have is null elsewhere."""
    frames = group_frames(raw, keys, **options).values()
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def smoothed_daily(raw: DataFrame) -> DataFrame:
    """First slice end to end: daily mean demand and 24-hour past mean temperature per site."""
    df = cleaning.drop_null_target(cleaning.sentinel_to_null(raw))
    df = cleaning.clip_ranges(cleaning.with_calendar(df))
    df = lags.past_means(df, ["ta"], [24])
    return df.groupBy("branch_id", "date").agg(
        F.avg("heat_demand").alias("demand_mean"), F.avg("ta_roll24").alias("ta_roll24_mean"),
        F.count(F.lit(1)).alias("hours"),
    )
