"""Queries on correlations, feature selection, tests and fits."""

from pyspark.sql import functions as F

from thermopanel.catalog import HOURLY, SEASON, frames, query
from thermopanel.catalog.series import lag_sql, names
from thermopanel.operators import lags, stats
from thermopanel.sources.panels import NUMERIC, WEATHER


def corr_sql(a: str, b: str) -> str:
    return f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END"


PAIRS = ["ta", "wd", "ws", "hm", "ta_chi", "heat_demand"]


@query(
    "correlation_matrix_st1",
    HOURLY + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {corr_sql(a, b)} AS corr FROM clean" for a in PAIRS for b in PAIRS
    ),
    "corr",
)
def _(spark, d):
    return stats.correlation_matrix(frames.clean(spark, d), PAIRS)


PRICES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "lineitem_correlation_st1",
    " UNION ALL ".join(
        f"SELECT l_returnflag, '{a}' AS a, '{b}' AS b, {corr_sql(a, b)} AS corr FROM lineitem GROUP BY 1"
        for a in PRICES for b in PRICES
    ),
    "corr",
)
def _(spark, d):
    return stats.correlation_matrix(frames.table(spark, d, "lineitem"), PRICES, ["l_returnflag"])


def with_target_sql(features, keys: str, source: str = "clean") -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{f}' AS feature, {corr_sql(f, 'heat_demand')} AS corr FROM {source} GROUP BY {keys}"
        for f in features
    )


@query("correlation_with_target_st2", HOURLY + with_target_sql(WEATHER, "branch_id"), "corr")
def _(spark, d):
    return stats.correlation_with(frames.clean(spark, d), "heat_demand", WEATHER, ["branch_id"])


MONTHLY = "marked AS (SELECT *, month(tm) AS month, CASE WHEN month(tm) BETWEEN 6 AND 9 THEN 'summer' ELSE 'other' END " \
    "AS season FROM clean)"


def marked(spark, d):
    season = F.when(F.month("tm").between(6, 9), "summer").otherwise("other")
    return frames.clean_season(spark, d).withColumns({"month": F.month("tm"), "season": season})


@query("correlation_by_month_st3", f"{SEASON}, {MONTHLY} " + with_target_sql(["ta", "ta_chi"], "month", "marked"), "corr")
def _(spark, d):
    return stats.correlation_with(marked(spark, d), "heat_demand", ["ta", "ta_chi"], ["month"])


@query(
    "correlation_by_site_and_month_st3",
    f"{SEASON}, {MONTHLY} " + with_target_sql(["ta_chi", "ws"], "branch_id, month", "marked"), "corr",
)
def _(spark, d):
    return stats.correlation_with(marked(spark, d), "heat_demand", ["ta_chi", "ws"], ["branch_id", "month"])


@query(
    "season_correlation_difference_st3",
    f"""{SEASON}, {MONTHLY}, long AS ({with_target_sql(WEATHER, 'branch_id, season', 'marked')}),
    wide AS (SELECT branch_id, feature, max(corr) FILTER (season = 'summer') AS summer_corr,
    max(corr) FILTER (season = 'other') AS other_corr FROM long GROUP BY 1, 2)
    SELECT *, abs(summer_corr - other_corr) AS diff FROM wide""",
    "summer_corr other_corr diff",
)
def _(spark, d):
    long = stats.correlation_with(marked(spark, d), "heat_demand", WEATHER, ["branch_id", "season"])
    return stats.correlation_difference(long, "season", "summer", "other", ["branch_id", "feature"])


GRID = {c: range(1, 24) for c in WEATHER}
GRID_NAMES = names(GRID, "{c}_shift_{n}h")
GRID_FEATURES = [*GRID, *GRID_NAMES]
GRID_SQL = f"grid AS (SELECT *, {lag_sql(GRID, '{c}_shift_{n}h')} FROM clean WINDOW w AS (PARTITION BY branch_id ORDER BY tm)),\n" \
    f"long AS ({with_target_sql(GRID_FEATURES, 'branch_id', 'grid')})"


def grid_correlations(spark, d):
    rows = frames.clean(spark, d).select("branch_id", "tm", "heat_demand", *GRID)
    grid = lags.lag_grid(rows, list(GRID))
    return stats.correlation_with(grid, "heat_demand", GRID_FEATURES, ["branch_id"])


@query(
    "feature_ranking_st4",
    f"{HOURLY}, {GRID_SQL} SELECT feature, avg(abs(corr)) AS mean_abs_corr, max(corr) - min(corr) AS max_diff FROM long GROUP BY 1",
    "mean_abs_corr max_diff",
)
def _(spark, d):
    return stats.feature_ranking(grid_correlations(spark, d))


@query(
    "common_top_features_st5",
    f"""{HOURLY}, {GRID_SQL}, r AS (SELECT branch_id, feature, row_number() OVER (PARTITION BY branch_id
    ORDER BY round(abs(corr), 9) DESC, feature) AS rn FROM long WHERE corr IS NOT NULL)
    SELECT feature FROM r WHERE rn <= 32 AND NOT contains(feature, 'hm') GROUP BY 1
    HAVING count(DISTINCT branch_id) = (SELECT count(DISTINCT branch_id) FROM r)""",
)
def _(spark, d):
    return stats.common_top_features(grid_correlations(spark, d), 32, without=["hm"])


SEASON_FEATURES = ["ta", "ta_chi", "ws", "hm", "si"]


@query(
    "strong_common_features_st6",
    f"""{SEASON}, {MONTHLY}, long AS ({with_target_sql(SEASON_FEATURES, 'branch_id, season', 'marked')})
    SELECT season, feature, avg(abs(corr)) AS mean_abs_corr FROM long l WHERE abs(corr) >= 0.3 GROUP BY 1, 2
    HAVING count(DISTINCT branch_id) = (SELECT count(DISTINCT branch_id) FROM long x WHERE x.season = l.season)""",
    "mean_abs_corr",
)
def _(spark, d):
    long = stats.correlation_with(marked(spark, d), "heat_demand", SEASON_FEATURES, ["branch_id", "season"])
    return stats.strong_common_features(long, 0.3)


@query(
    "welch_test_st7",
    f"""{SEASON}, {MONTHLY}, a AS (SELECT count(heat_demand) AS n, avg(heat_demand) AS m, var_samp(heat_demand) AS v
    FROM marked WHERE season = 'summer'), b AS (SELECT count(heat_demand) AS n, avg(heat_demand) AS m,
    var_samp(heat_demand) AS v FROM marked WHERE season = 'other')
    SELECT (a.m - b.m) / sqrt(a.v / a.n + b.v / b.n) AS t, (a.v / a.n + b.v / b.n) * (a.v / a.n + b.v / b.n)
    / ((a.v / a.n) * (a.v / a.n) / (a.n - 1) + (b.v / b.n) * (b.v / b.n) / (b.n - 1)) AS df FROM a, b""",
    "t df",
)
def _(spark, d):
    return stats.welch_test(marked(spark, d), "heat_demand", "season", "summer", "other").select("t", "df")


#: Simpson's rule over the density of Student's t from 0 to |t|
@query(
    "welch_test_p_value_st7",
    f"""{SEASON}, {MONTHLY}, a AS (SELECT count(heat_demand) AS n, avg(heat_demand) AS m, var_samp(heat_demand) AS v
    FROM marked WHERE season = 'summer'), b AS (SELECT count(heat_demand) AS n, avg(heat_demand) AS m,
    var_samp(heat_demand) AS v FROM marked WHERE season = 'other'),
    w AS (SELECT (a.m - b.m) / sqrt(a.v / a.n + b.v / b.n) AS t, (a.v / a.n + b.v / b.n) * (a.v / a.n + b.v / b.n)
    / ((a.v / a.n) * (a.v / a.n) / (a.n - 1) + (b.v / b.n) * (b.v / b.n) / (b.n - 1)) AS df FROM a, b),
    area AS (SELECT sum((CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
      * pow(1 + (i * abs(t) / 20000e0) * (i * abs(t) / 20000e0) / df, -(df + 1) / 2) * abs(t) / 60000e0) AS s FROM w, range(20001) r(i))
    SELECT t, df, 1 - 2 * s * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) AS p FROM w, area""",
    "t df p",
)
def _(spark, d):
    return stats.welch_test(marked(spark, d), "heat_demand", "season", "summer", "other")


@query(
    "variance_inflation_st8",
    f"""{HOURLY}, r AS (SELECT corr(rn_day, rn_hr1) AS r FROM clean WHERE rn_day IS NOT NULL AND rn_hr1 IS NOT NULL)
    SELECT 'rn_day' AS feature, 1 / (1 - r * r) AS vif FROM r UNION ALL SELECT 'rn_hr1', 1 / (1 - r * r) FROM r""",
    "vif",
)
def _(spark, d):
    return stats.variance_inflation(frames.clean(spark, d), ["rn_day", "rn_hr1"])


FITS = ["ta", "wd", "ws", "rn_day", "hm", "si", "ta_chi"]


def fit_sql(keys: str = "") -> str:
    lead, group = (f"{keys}, ", f" GROUP BY {keys}") if keys else ("", "")
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS feature, count(*) FILTER ({c} IS NOT NULL AND heat_demand IS NOT NULL) AS n, "
        f"regr_slope(heat_demand, {c}) AS slope, regr_intercept(heat_demand, {c}) AS intercept, "
        f"regr_r2(heat_demand, {c}) AS r2 FROM clean{group}" for c in FITS
    )


@query("linear_fits_st9", HOURLY + fit_sql(), "slope intercept r2")
def _(spark, d):
    return stats.linear_fits(frames.clean(spark, d), "heat_demand", FITS)


@query("linear_fits_by_site_st9", HOURLY + fit_sql("branch_id"), "slope intercept r2")
def _(spark, d):
    return stats.linear_fits(frames.clean(spark, d), "heat_demand", FITS, ["branch_id"])
