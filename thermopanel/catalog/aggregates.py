"""Queries on reports, group statistics, pivots and histograms."""

from pyspark.sql import functions as F

from thermopanel.catalog import CLUSTERS_SQL, HOURLY, SEASON, frames, query
from thermopanel.catalog.features import SEASON_SQL, SECTOR8
from thermopanel.functions import calendar as cal
from thermopanel.functions import weather
from thermopanel.operators import aggregates as agg
from thermopanel.operators import joins
from thermopanel.sources.panels import NUMERIC

DATED = "dated AS (SELECT *, CAST(tm AS DATE) AS date FROM clean)"
DAY_TEXT = "strftime(date, '%Y-%m-%d') AS date"


def dated(spark, d):
    return frames.clean(spark, d).withColumn("date", F.to_date("tm"))


@query(
    "daily_temperature_flags_ag1",
    f"""{HOURLY}, {DATED} SELECT {DAY_TEXT}, CAST(coalesce(max(ta) >= 33, false) AS INT) AS heatwave,
    CAST(coalesce(min(ta) <= -12, false) AS INT) AS coldwave FROM dated GROUP BY dated.date""",
)
def _(spark, d):
    return joins.daily_temperature_flags(dated(spark, d)).withColumn("date", frames.day())


@query(
    "site_temperature_flags_ag1",
    f"""{HOURLY}, {DATED} SELECT branch_id, {DAY_TEXT}, CAST(coalesce(max(ta) >= 33, false) AS INT) AS heatwave,
    CAST(coalesce(min(ta) <= -12, false) AS INT) AS coldwave FROM dated GROUP BY branch_id, dated.date""",
)
def _(spark, d):
    return joins.daily_temperature_flags(dated(spark, d), ["branch_id", "date"]).withColumn("date", frames.day())


@query(
    "night_flags_ag2",
    f"""{HOURLY}, {DATED} SELECT branch_id, {DAY_TEXT}, CAST(coalesce(min(ta) <= -12, false) AS INT) AS cold_wave,
    CAST(coalesce(min(ta) FILTER (hour(tm) >= 18 OR hour(tm) <= 6) >= 25, false) AS INT) AS tropical_night
    FROM dated GROUP BY branch_id, dated.date""",
)
def _(spark, d):
    return joins.daily_night_flags(dated(spark, d), ["branch_id", "date"]).withColumn("date", frames.day())


@query(
    "missing_report_ag3",
    HOURLY + "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count(*) FILTER ({c} IS NULL) AS missing_count, "
        f"100e0 * count(*) FILTER ({c} IS NULL) / count(*) AS missing_percent FROM clean" for c in NUMERIC
    ) + ") WHERE missing_count > 0",
    "missing_percent",
)
def _(spark, d):
    return agg.missing_report(frames.clean(spark, d))


@query("missing_by_site_ag4", f"{HOURLY} SELECT branch_id, count(*) AS missing FROM clean WHERE ta IS NULL GROUP BY 1")
def _(spark, d):
    return agg.missing_by_site(frames.clean(spark, d))


DESCRIBED = "mean std min max p25 p50 p75"


def describe_sql(c: str, keys: str = "", source: str = "clean") -> str:
    lead = f"{keys}, " if keys else ""
    return (
        f"SELECT {lead}'{c}' AS variable, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, "
        f"max({c}) AS max, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
        f"quantile_cont({c}, 0.75) AS p75 FROM {source}" + (f" GROUP BY {keys}" if keys else "")
    )


@query("describe_ag5", HOURLY + " UNION ALL ".join(describe_sql(c) for c in NUMERIC), DESCRIBED)
def _(spark, d):
    return agg.describe(frames.clean(spark, d), NUMERIC)


@query(
    "describe_by_site_ag5",
    HOURLY + " UNION ALL ".join(describe_sql(c, "branch_id") for c in ("heat_demand", "ta", "rn_hr1")), DESCRIBED,
)
def _(spark, d):
    return agg.describe(frames.clean(spark, d), ["heat_demand", "ta", "rn_hr1"], ["branch_id"])


PRICES = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "describe_lineitem_ag5",
    " UNION ALL ".join(describe_sql(c, "l_returnflag", "lineitem") for c in PRICES), DESCRIBED, places=4,
)
def _(spark, d):
    return agg.describe(frames.table(spark, d, "lineitem"), PRICES, ["l_returnflag"])


@query(
    "central_tendency_ag6",
    f"""{HOURLY}, tops AS (SELECT branch_id, heat_demand, count(*) AS n FROM ready GROUP BY 1, 2),
    modes AS (SELECT branch_id, min(heat_demand) AS mode FROM tops t WHERE n = (SELECT max(n) FROM tops u
      WHERE u.branch_id = t.branch_id) GROUP BY 1)
    SELECT branch_id, avg(heat_demand) AS mean, quantile_cont(heat_demand, 0.5) AS median, any_value(mode) AS mode
    FROM ready JOIN modes USING (branch_id) GROUP BY 1""",
    "mean median mode",
)
def _(spark, d):
    return agg.central_tendency(frames.ready(spark, d), "heat_demand")


@query(
    "sample_skewness_ag7",
    f"{HOURLY} SELECT branch_id, skewness(heat_demand) AS skew, skewness(ta) AS skew_ta FROM clean GROUP BY 1", "skew skew_ta",
)
def _(spark, d):
    return frames.clean(spark, d).groupBy("branch_id").agg(
        agg.sample_skewness("heat_demand").alias("skew"), agg.sample_skewness("ta").alias("skew_ta")
    )


@query("value_counts_ag8", f"{HOURLY} SELECT branch_id, count(*) AS count FROM clean GROUP BY 1")
def _(spark, d):
    return agg.value_counts(frames.clean(spark, d), "branch_id")


@query(
    "distinct_counts_ag8",
    HOURLY + " UNION ALL ".join(f'SELECT \'{c}\' AS variable, count(DISTINCT {c}) AS "distinct" FROM clean'
                                for c in ("branch_id", "heat_demand", "wd", "hm")),
)
def _(spark, d):
    return agg.distinct_counts(frames.clean(spark, d), ["branch_id", "heat_demand", "wd", "hm"])


@query(
    "daily_mean_by_cluster_ag9",
    f"""{HOURLY} SELECT cluster_id, branch_id, strftime(tm, '%Y-%m-%d') AS date, avg(heat_demand) AS heat_demand_mean,
    avg(ln(1 + heat_demand)) AS log_mean FROM ready r JOIN {CLUSTERS_SQL} ON r.branch_id = c.site GROUP BY 1, 2, 3""",
    "heat_demand_mean log_mean",
)
def _(spark, d):
    days = joins.with_cluster(frames.ready(spark, d)).withColumns(
        {"date": F.date_format("tm", "yyyy-MM-dd"), "log": F.log1p("heat_demand")}
    )
    return agg.group_means(days, ["cluster_id", "branch_id", "date"], ["heat_demand", "log"])


@query(
    "monthly_means_by_site_ag10",
    f"{SEASON} SELECT branch_id, month(tm) AS month, avg(heat_demand) AS heat_demand_mean, avg(rn_day) AS rn_day_mean, "
    "avg(hm) AS hm_mean FROM ready GROUP BY 1, 2",
    "heat_demand_mean rn_day_mean hm_mean",
)
def _(spark, d):
    months = frames.ready_season(spark, d).withColumn("month", F.month("tm"))
    return agg.group_means(months, ["branch_id", "month"], ["heat_demand", "rn_day", "hm"])


@query(
    "season_hour_curve_ag10",
    f"{SEASON} SELECT {SEASON_SQL} AS season, hour(tm) AS hour, avg(heat_demand) AS heat_demand_mean FROM ready "
    "GROUP BY 1, 2", "heat_demand_mean",
)
def _(spark, d):
    hours = frames.ready_season(spark, d).withColumns({"season": cal.season(F.month("tm")), "hour": F.hour("tm")})
    return agg.group_means(hours, ["season", "hour"], ["heat_demand"])


MONTHS = [f"m{m}" for m in range(1, 13)]


@query(
    "hour_month_pivot_ag11",
    SEASON + "SELECT branch_id, hour(tm) AS hour, " + ", ".join(
        f"avg(heat_demand) FILTER (month(tm) = {m}) AS m{m}" for m in range(1, 13)
    ) + " FROM ready GROUP BY 1, 2",
    MONTHS,
)
def _(spark, d):
    hours = frames.ready_season(spark, d).withColumns({"month": F.month("tm"), "hour": F.hour("tm")})
    return agg.pivot_mean(hours, ["branch_id", "hour"], "month", range(1, 13), "heat_demand", "m")


@query(
    "site_sector_pivot_ag11",
    f"{HOURLY}, s AS (SELECT *, {SECTOR8} AS sector FROM clean) SELECT branch_id, " + ", ".join(
        f"avg(ws) FILTER (sector = '{s}') AS ws_{s}" for s in weather.SECTORS8
    ) + " FROM s GROUP BY 1",
    [f"ws_{s}" for s in weather.SECTORS8],
)
def _(spark, d):
    marked = frames.clean(spark, d).withColumn("sector", weather.wind_sector8())
    return agg.pivot_mean(marked, ["branch_id"], "sector", weather.SECTORS8, "ws", "ws_")


def cell(test: str, name: str) -> str:
    return f"quantile_cont(heat_demand, 0.5) FILTER ({test}) AS {name}"


PATTERN_SQL = ", ".join(
    [cell(f"hour(tm) = {h}", f"hour_{h}") for h in range(24)]
    + [cell(f"hour(tm) // 3 = {b}", f"bucket_{b}") for b in range(8)]
    + [cell(f"month(tm) = {m}", f"month_{m}") for m in range(1, 13)]
    + [cell(f"{SEASON_SQL} = '{s}'", f"season_{s}") for s in cal.SEASON_LABELS]
)


@query(
    "pattern_matrix_ag12", f"{SEASON} SELECT branch_id, {PATTERN_SQL} FROM ready GROUP BY 1", agg.PATTERN_CELLS,
)
def _(spark, d):
    return agg.pattern_matrix(frames.ready_season(spark, d))


@query(
    "site_profile_ag13",
    f"{HOURLY} SELECT branch_id, avg(heat_demand) AS mean, stddev_samp(heat_demand) AS std, max(heat_demand) AS max, "
    "min(heat_demand) AS min FROM ready GROUP BY 1", "mean std max min",
)
def _(spark, d):
    return agg.site_profile(frames.ready(spark, d))


@query(
    "mean_by_sector_ag14",
    f"{HOURLY}, s AS (SELECT *, {SECTOR8} AS sector FROM clean) SELECT sector, avg(heat_demand) AS mean, "
    "list_position(['N','NE','E','SE','S','SW','W','NW'], sector) AS sector_no FROM s WHERE sector <> 'Unknown' GROUP BY 1",
    "mean",
)
def _(spark, d):
    return agg.mean_by_sector(frames.clean(spark, d))


@query(
    "wind_rose_ag15",
    f"""{HOURLY}, h AS (SELECT CAST(floor(wd / 10) AS INT) AS bin, count(*) AS n FROM clean WHERE wd >= 0 AND wd < 360
    GROUP BY 1) SELECT CAST(s.bin AS INT) AS bin, coalesce(n, 0) AS count
    FROM (SELECT unnest(range(36)) AS bin) s LEFT JOIN h ON s.bin = h.bin""",
)
def _(spark, d):
    return agg.wind_rose(frames.clean(spark, d))


@query(
    "wind_rose_by_month_ag15",
    f"""{SEASON}, m AS (SELECT month(tm) AS month, wd FROM clean), h AS (SELECT month, CAST(floor(wd / 10) AS INT) AS bin,
    count(*) AS n FROM m WHERE wd >= 0 AND wd < 360 GROUP BY 1, 2)
    SELECT s.month, CAST(s.bin AS INT) AS bin, coalesce(n, 0) AS count
    FROM (SELECT month, unnest(range(36)) AS bin FROM (SELECT DISTINCT month FROM m)) s
    LEFT JOIN h ON s.bin = h.bin AND s.month = h.month""",
)
def _(spark, d):
    return agg.wind_rose(frames.clean_season(spark, d).withColumn("month", F.month("tm")), by=["month"])


def histogram_sql(column: str, table: str, bins: int) -> str:
    """The last entry of a WITH list and its SELECT."""
    return f"""ends AS (SELECT min({column}) AS lo, (max({column}) - min({column})) / {bins}e0 AS width FROM {table}),
    binned AS (SELECT CAST(least(floor(({column} - lo) / width), {bins - 1}) AS INT) AS bin, count(*) AS n
      FROM {table}, ends WHERE {column} IS NOT NULL GROUP BY 1)
    SELECT CAST(s.bin AS INT) AS bin, coalesce(n, 0) AS count, lo + s.bin * width AS bin_start
    FROM (SELECT unnest(range({bins})) AS bin) s LEFT JOIN binned ON s.bin = binned.bin, ends"""


@query("demand_histogram_ag16", f"{HOURLY}, " + histogram_sql("heat_demand", "ready", 50), "bin_start")
def _(spark, d):
    return agg.histogram(frames.ready(spark, d), "heat_demand", 50)


@query("price_histogram_ag16", "WITH " + histogram_sql("l_extendedprice", "lineitem", 100), "bin_start", places=4)
def _(spark, d):
    return agg.histogram(frames.table(spark, d, "lineitem"), "l_extendedprice", 100)


def box_sql(keys: str, names: str, source: str = "ready", column: str = "heat_demand") -> str:
    return f"""keyed AS (SELECT {keys}, {column} AS v FROM {source} WHERE {column} IS NOT NULL),
    q AS (SELECT {names}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3,
      avg(v) AS mean FROM keyed GROUP BY ALL)
    SELECT {names}, q1, median, q3, mean,
      min(v) FILTER (v BETWEEN q1 - (q3 - q1) * 1.5e0 AND q3 + (q3 - q1) * 1.5e0) AS whisker_low,
      max(v) FILTER (v BETWEEN q1 - (q3 - q1) * 1.5e0 AND q3 + (q3 - q1) * 1.5e0) AS whisker_high,
      CAST(count(*) FILTER (v NOT BETWEEN q1 - (q3 - q1) * 1.5e0 AND q3 + (q3 - q1) * 1.5e0) AS BIGINT) AS outliers
    FROM keyed JOIN q USING ({names}) GROUP BY ALL"""


BOXES = "q1 median q3 mean whisker_low whisker_high"


@query("box_by_month_ag17", f"{SEASON}, {box_sql('month(tm) AS month', 'month')}", BOXES)
def _(spark, d):
    return agg.box_statistics(frames.ready_season(spark, d).withColumn("month", F.month("tm")), "heat_demand", ["month"])


@query(
    "box_by_site_and_season_ag17",
    f"{SEASON}, {box_sql(f'branch_id, {SEASON_SQL} AS season', 'branch_id, season')}", BOXES,
)
def _(spark, d):
    marked = frames.ready_season(spark, d).withColumn("season", cal.season(F.month("tm")))
    return agg.box_statistics(marked, "heat_demand", ["branch_id", "season"])


@query(
    "box_by_weekday_and_bucket_ag17",
    f"{HOURLY}, {box_sql('isodow(tm) - 1 AS day_of_week, hour(tm) // 3 AS hour_group', 'day_of_week, hour_group')}", BOXES,
)
def _(spark, d):
    marked = frames.ready(spark, d).withColumns(
        {"day_of_week": F.weekday("tm"), "hour_group": cal.hour_group(F.hour("tm"))}
    )
    return agg.box_statistics(marked, "heat_demand", ["day_of_week", "hour_group"])


@query(
    "rain_row_match_ag18",
    f"""{HOURLY}, s AS (SELECT id, rn_hr1, coalesce(rn_day - lag(rn_day) OVER (PARTITION BY branch_id ORDER BY tm), 0)
    AS rn_day_diff FROM clean) SELECT id, rn_day_diff,
    CAST(coalesce(round(rn_hr1, 2) = round(rn_day_diff, 2), false) AS INT) AS rn_hr1_diff_match FROM s""",
    "rn_day_diff",
)
def _(spark, d):
    return agg.rain_row_match(frames.clean(spark, d)).select("id", "rn_day_diff", "rn_hr1_diff_match")


@query(
    "rain_day_match_ag18",
    f"""{HOURLY}, {DATED}, m AS (SELECT branch_id, date, rn_day AS rn_day_00h FROM dated WHERE hour(tm) = 0),
    t AS (SELECT branch_id, date, coalesce(sum(rn_hr1), 0) AS rn_hr1_sum FROM dated GROUP BY 1, 2)
    SELECT branch_id, strftime(date, '%Y-%m-%d') AS date, rn_day_00h, rn_hr1_sum,
    CAST(coalesce(round(rn_day_00h, 2) = round(rn_hr1_sum, 2), false) AS INT) AS match FROM m JOIN t USING (branch_id, date)""",
    "rn_day_00h rn_hr1_sum",
)
def _(spark, d):
    return agg.rain_day_match(frames.clean(spark, d)).withColumn("date", frames.day())


CHANGES = [f"ta_{p}_{k}" for p in ("mean", "max", "min") for k in ("diff", "pct_change")]
CHANGE_SQL = f"""{DATED}, days AS (SELECT branch_id, date, avg(ta) AS ta_mean, max(ta) AS ta_max, min(ta) AS ta_min
    FROM dated GROUP BY 1, 2), changed AS (SELECT *, """ + ", ".join(
    f"ta_{p} - lag(ta_{p}) OVER w AS ta_{p}_diff, CASE WHEN lag(ta_{p}) OVER w <> 0 THEN (ta_{p} - lag(ta_{p}) OVER w) "
    f"/ lag(ta_{p}) OVER w END AS ta_{p}_pct_change" for p in ("mean", "max", "min")
) + ", ta_max - ta_min AS ta_range FROM days WINDOW w AS (PARTITION BY branch_id ORDER BY date))"


@query(
    "daily_change_ag19", f"{HOURLY}, {CHANGE_SQL} SELECT * REPLACE ({DAY_TEXT}) FROM changed",
    ["ta_mean", "ta_max", "ta_min", "ta_range", *CHANGES],
)
def _(spark, d):
    return agg.daily_change(frames.clean(spark, d)).withColumn("date", frames.day())


@query(
    "demand_against_change_ag20",
    f"""{HOURLY}, {CHANGE_SQL}, demand AS (SELECT branch_id, CAST(tm AS DATE) AS date, avg(heat_demand) AS
    heat_demand_mean, max(heat_demand) AS heat_demand_max, min(heat_demand) AS heat_demand_min FROM clean GROUP BY 1, 2)
    SELECT branch_id, strftime(date, '%Y-%m-%d') AS date, heat_demand_mean, heat_demand_max, heat_demand_min,
    ta_mean_pct_change, ta_max_pct_change, ta_min_pct_change FROM demand JOIN changed USING (branch_id, date)
    WHERE ta_mean_pct_change IS NOT NULL AND ta_max_pct_change IS NOT NULL AND ta_min_pct_change IS NOT NULL
    AND heat_demand_mean IS NOT NULL""",
    "heat_demand_mean heat_demand_max heat_demand_min ta_mean_pct_change ta_max_pct_change ta_min_pct_change",
)
def _(spark, d):
    return agg.demand_against_change(frames.clean(spark, d)).withColumn("date", frames.day())


@query(
    "hourly_means_over_sites_ag21",
    HOURLY + "SELECT strftime(tm, '%Y-%m-%d %H:%M:%S') AS tm, CAST(month(tm) BETWEEN 6 AND 9 AS INT) AS is_summer, "
    + ", ".join(f"avg({c}) AS {c}_mean" for c in NUMERIC) + " FROM clean GROUP BY ALL",
    [f"{c}_mean" for c in NUMERIC],
)
def _(spark, d):
    marked = frames.clean(spark, d).withColumns(
        {"is_summer": cal.is_long_summer(F.month("tm")).cast("int"), "tm": frames.stamp()}
    )
    return agg.group_means(marked, ["tm", "is_summer"], NUMERIC)
