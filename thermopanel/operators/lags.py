"""Lags, rolling means, running sums and changes along each site's hours."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from thermopanel.functions.numeric import present
from thermopanel.operators.series import IDX, LEN, SITE_HOURS, Series
from thermopanel.session import materialise

LAG_COLUMNS = ("ta", "ws", "rn_hr1", "hm", "si", "ta_chi")
LAG_HOURS = (1, 3, 24)
ROLL_HOURS = (3, 24, 72, 168)
SHORT_LAG_COLUMNS, SHORT_LAG_HOURS = ("ta", "hm", "si", "ta_chi"), (1, 2, 24, 25)
AVERAGE_COLUMNS = ("wd", "ws", "rn_hr1", "rn_day")


# ---- expressions against a block window ----------------------------------
def lag_exprs(w: WindowSpec, lags: Mapping[str, Sequence[int]], name: str = "{c}_lag{n}") -> list[Column]:
    return [F.lag(c, n).over(w).alias(name.format(c=c, n=n)) for c, ns in lags.items() for n in ns]


def with_frame_means(laid: DataFrame, w: WindowSpec, frames: Mapping[str, tuple[str, int, int]]) -> DataFrame:
    """Means over ROWS frames, null unless every row of the frame has a finite value.

    ``frames`` maps a name to (column, first, last) relative to the row. A frame is the
    difference of two running sums of the block, so its width costs nothing; a frame
    evaluated row by row would read every row once per frame it belongs to.
    """
    columns = sorted({c for c, _, _ in frames.values()})
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    finite = {c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c)) for c in columns}
    sums = [F.sum(F.coalesce(finite[c], F.lit(0.0))).over(upto).alias(f"__s_{c}") for c in columns]
    counts = [F.count(finite[c]).over(upto).alias(f"__n_{c}") for c in columns]
    means = []
    for name, (c, first, last) in frames.items():
        size = last - first + 1

        def between(kind: str) -> Column:
            end = F.lag(f"__{kind}_{c}", -last).over(w) if last else F.col(f"__{kind}_{c}")
            return end - F.coalesce(F.lag(f"__{kind}_{c}", 1 - first).over(w), F.lit(0))

        means.append(F.when(between("n") == size, between("s") / size).alias(name))
    summed = laid.select("*", *sums, *counts).select("*", *means)
    return summed.drop(*[f"__{kind}_{c}" for c in columns for kind in "sn"])


def past_frames(columns: Sequence[str], hours: Sequence[int]) -> dict[str, tuple[str, int, int]]:
    return {f"{c}_roll{k}": (c, -k, -1) for c in columns for k in hours}


def change_exprs(w: WindowSpec, column: str, shifts: Sequence[int], prefix: str | None = None) -> list[Column]:
    prefix = prefix or column
    out = []
    for n in shifts:
        earlier = F.lag(column, n).over(w)
        out.append((F.col(column) - earlier).alias(f"{prefix}_diff_{n}h"))
        out.append(F.try_divide(F.col(column) - earlier, earlier).alias(f"{prefix}_pct_{n}h"))
    return out


def head_exprs(w: WindowSpec, lags: Mapping[str, Sequence[int]]) -> list[Column]:
    """The first rows of the series, as many as the largest lag, as one array per column in the block that
    holds them; empty in blocks without them."""
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    head = F.col(IDX) < longest_lag(lags)
    return [F.collect_list(F.when(head, F.struct(F.col(c).alias("x")))).over(whole).alias(f"__head_{c}") for c in lags]


def padded_lag_exprs(w: WindowSpec, lags: Mapping[str, Sequence[int]], name: str = "{c}_plag{n}") -> list[Column]:
    """Lags as if the first rows of the series stood once more in front of it.

    With p = min(largest lag, length), the lag n of row i is x[i-n], or x[p-n+i] for
    the first rows. That row is read from the array of :func:`head_exprs`, which must have been
    selected before: a lead would be computed for every row, though only the first ones use it.
    """
    idx, pad = F.col(IDX), F.least(F.col(LEN), F.lit(longest_lag(lags)))
    return [
        F.when(idx >= n, F.lag(c, n).over(w)).otherwise(F.get(f"__head_{c}", (pad - n + idx).cast("int"))["x"])
        .alias(name.format(c=c, n=n))
        for c, ns in lags.items() for n in ns
    ]


def with_padded_lags(
    laid: DataFrame, w: WindowSpec, lags: Mapping[str, Sequence[int]], also: Sequence[Column] = ()
) -> DataFrame:
    arrays = laid.select("*", *head_exprs(w, lags))
    return arrays.select("*", *padded_lag_exprs(w, lags), *also).drop(*[f"__head_{c}" for c in lags])


def longest_lag(lags: Mapping[str, Sequence[int]]) -> int:
    return max((max(ns) for ns in lags.values()), default=0)


# ---- lags filled over a whole group ----------------------------------------
KNOWN = "__known_{c}"


def _passed_on(sites: Sequence[Mapping], c: str, n: int, longest: int, padded: bool) -> list:
    """What the lag n of a column is in the first n rows of each site, and after them before the site's first
    reading: n + 1 values per site, sites in order. ``longest`` is the padding's length."""
    heads, lasts, firsts = [], [], []
    for site in sites:
        size, rows = site["size"], site["rows"]
        pad = min(longest, size) if padded else 0
        at = [pad - n + i for i in range(min(n, size))]
        head = [rows[j][c] if 0 <= j < pad else None for j in at]
        seen = [v for v in head if v is not None]
        last = rows[size - 1 - n][KNOWN.format(c=c)] if size > n else None
        heads.append(head)
        lasts.append(last if last is not None else seen[-1] if seen else None)
        begins = last is not None and site["first"][c]
        firsts.append(seen[0] if seen else begins["v"] if begins else None)
    out, before = [], None
    for k, head in enumerate(heads):
        now = before if before is not None else next((v for v in firsts[k:] if v is not None), None)
        for i in range(n + 1):
            now = head[i] if i < len(head) and head[i] is not None else now
            out.append(now)
        before = lasts[k] if lasts[k] is not None else before
    return out


def group_filled(
    df: DataFrame, columns: Sequence[str], wanted: Mapping[str, Sequence[int]], padded: bool, series: Series,
    site: str = "branch_id",
) -> tuple[DataFrame, dict[str, Column]]:
    """Readings of one group filled forward, then backward in (site, time) order, and the same of their lags.

    A lag's last known value is the lag of the last known reading, except in the first rows of a site and before its
    first reading. What stands there is fixed by the first and last rows of the sites, a few dozen per site, so no
    lag is filled column by column. Returns the frame with a column more per reading, and the lags as expressions
    against a block window. The frame must be indexed and hold the rows of one group.
    """
    longest = longest_lag(wanted)
    both = list(dict.fromkeys([*columns, *wanted]))
    known = {c: KNOWN.format(c=c) for c in both}
    # last known readings of each site; backward only after that, over the group
    copies = df.select("*", *[F.col(c).alias(name) for c, name in known.items()])
    out = materialise(series.fill(copies, list(known.values()), source=copies))
    ends = out.filter((F.col(IDX) <= longest) | (F.col(IDX) >= F.col(LEN) - 1 - longest))
    place = F.col(IDX)
    first = out.groupBy(site).agg(*[
        F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in both
    ])
    sites: dict[str, dict] = {}
    for row in ends.select(site, IDX, LEN, *both, *known.values()).toLocalIterator():
        found = sites.setdefault(row[site], {"size": row[LEN], "rows": {}})
        found["rows"][row[IDX]] = row
    for row in first.collect():
        sites[row[site]]["first"] = {c: None if row[c] is None else {"v": row[c]} for c in both}
    names = sorted(sites)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    number = F.array_position(F.array(*[F.lit(s) for s in names]).cast("array<string>"), F.col(site)).cast("int") - 1

    def carried(c: str, n: int) -> Column:
        values = _passed_on([sites[s] for s in names], c, n, longest, padded)
        text = F.lit(",".join("" if v is None else repr(v) for v in values))
        return F.get(F.split(text, ",").try_cast(f"array<{kinds[c]}>"), F.col("__site") * (n + 1) + F.least(place, F.lit(n)).cast("int"))

    out = out.withColumn("__site", number)
    out = out.withColumns({c: F.coalesce(known[c], carried(c, 0)) for c in columns})
    w = series.window()
    lagged = {
        f"{c}_plag{n}": F.coalesce(F.lag(known[c], n).over(w), carried(c, n)) for c, ns in wanted.items() for n in ns
    }
    return out.drop(*[name for c, name in known.items() if c not in wanted]), lagged


# ---- operators ------------------------------------------------------------
def with_lags(
    df: DataFrame, lags: Mapping[str, Sequence[int]], series: Series = SITE_HOURS, name: str = "{c}_lag{n}"
) -> DataFrame:
    return series.apply(df, lag_exprs(series.window(), lags, name), before=longest_lag(lags))


def lag_set(df: DataFrame, series: Series = SITE_HOURS) -> DataFrame:
    return with_lags(df, {c: LAG_HOURS for c in present(df, LAG_COLUMNS)}, series)


def short_lag_set(df: DataFrame, series: Series = SITE_HOURS) -> DataFrame:
    return with_lags(df, {c: SHORT_LAG_HOURS for c in present(df, SHORT_LAG_COLUMNS)}, series, "{c}_lag_{n}")


def lag_grid(df: DataFrame, columns: Sequence[str], longest: int = 23, series: Series = SITE_HOURS) -> DataFrame:
    return with_lags(df, {c: range(1, longest + 1) for c in columns}, series, "{c}_shift_{n}h")


def past_means(
    df: DataFrame, columns: Sequence[str] = LAG_COLUMNS, hours: Sequence[int] = ROLL_HOURS, series: Series = SITE_HOURS
) -> DataFrame:
    """Means of the k rows before each row."""
    laid = series.blocks(df, before=max(hours) + 1)
    return series.own_rows(with_frame_means(laid, series.window(), past_frames(columns, hours)), IDX in df.columns)


def moving_averages(
    df: DataFrame, columns: Sequence[str] = AVERAGE_COLUMNS, size: int = 3, series: Series = SITE_HOURS
) -> DataFrame:
    """Means of the last ``size`` rows, the current one included."""
    laid = series.blocks(df, before=size)
    means = with_frame_means(laid, series.window(), {f"{c}_ma": (c, 1 - size, 0) for c in columns})
    return series.own_rows(means, IDX in df.columns)


def changes(
    df: DataFrame, column: str, shifts: Sequence[int] = (1, 3, 5, 7, 24), series: Series = SITE_HOURS,
    prefix: str | None = None,
) -> DataFrame:
    return series.apply(df, change_exprs(series.window(), column, shifts, prefix), before=max(shifts))


def first_differences(df: DataFrame, columns: Sequence[str], series: Series = SITE_HOURS) -> DataFrame:
    w = series.window()
    return series.apply(df, [(F.col(c) - F.lag(c, 1).over(w)).alias(f"{c}_diff") for c in columns], before=1)


def padded_lags(df: DataFrame, lags: Mapping[str, Sequence[int]], series: Series = SITE_HOURS) -> DataFrame:
    """Padded lags of the columns the frame has; unknown column names are skipped."""
    known = {c: list(ns) for c, ns in lags.items() if c in df.columns}
    laid = series.blocks(df, before=longest_lag(known))
    return series.own_rows(with_padded_lags(laid, series.window(), known), IDX in df.columns)


def running_radiation(df: DataFrame, site: str = "branch_id", tm: str = "tm") -> DataFrame:
    """Sum of ``si`` since midnight; null where ``si`` is null. A group is one site-day."""
    day = Window.partitionBy(site, F.to_date(tm)).orderBy(tm).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("cumulative_si", F.when(F.col("si").isNotNull(), F.sum("si").over(day)))
