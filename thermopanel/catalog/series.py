"""Queries on lags, rolling means, gaps, decomposition and cross-correlation."""

from pyspark.sql import functions as F

from thermopanel import rules
from thermopanel.catalog import CLUSTERS_SQL, HOURLY, SEASON, frames, query
from thermopanel.catalog.cleaning import KEYED, keyed_season
from thermopanel.operators import crosscorr, decompose, gaps, lags, stl
from thermopanel.operators.series import SITE_HOURS, Series
from thermopanel.plans.features import GROUP_SITES
from thermopanel.sources import panels
from thermopanel.sources.panels import NUMERIC, WEATHER

SITE = "WINDOW w AS (PARTITION BY branch_id ORDER BY tm)"


def lag_sql(lag_map, name: str = "{c}_lag{n}") -> str:
    return ", ".join(f"lag({c}, {n}) OVER w AS {name.format(c=c, n=n)}" for c, ns in lag_map.items() for n in ns)


def names(lag_map, name: str = "{c}_lag{n}") -> list[str]:
    return [name.format(c=c, n=n) for c, ns in lag_map.items() for n in ns]


LAGS = {c: lags.LAG_HOURS for c in lags.LAG_COLUMNS}
SHORT_LAGS = {c: lags.SHORT_LAG_HOURS for c in lags.SHORT_LAG_COLUMNS}
GRID = {c: range(1, 24) for c in NUMERIC}


@query("lag_set_ts1", f"{SEASON} SELECT id, {lag_sql(LAGS)} FROM ready {SITE}", names(LAGS))
def _(spark, d):
    return lags.lag_set(frames.ready_season(spark, d)).select("id", *names(LAGS))


@query("short_lag_set_ts2", f"{HOURLY} SELECT id, {lag_sql(SHORT_LAGS, '{c}_lag_{n}')} FROM clean {SITE}",
       names(SHORT_LAGS, "{c}_lag_{n}"))
def _(spark, d):
    return lags.short_lag_set(frames.clean(spark, d)).select("id", *names(SHORT_LAGS, "{c}_lag_{n}"))


def rolling_sql(c: str, first: int, last: int, name: str) -> str:
    end = "CURRENT ROW" if last == 0 else f"{-last} PRECEDING"
    over = f"OVER (PARTITION BY branch_id ORDER BY tm ROWS BETWEEN {-first} PRECEDING AND {end})"
    return f"CASE WHEN count({c}) {over} = {last - first + 1} THEN avg({c}) {over} END AS {name}"


ROLLED = [f"{c}_roll{k}" for c in lags.LAG_COLUMNS for k in lags.ROLL_HOURS]
#: one infinite wind reading per site, which makes the means of its windows null and no others
STORM = "id % 1000 < 19 AND id >= 1000"


def storm_sql(c: str, k: int) -> str:
    over = f"OVER (PARTITION BY branch_id ORDER BY tm ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    value = f"CASE WHEN {STORM} THEN NULL ELSE ws END" if c == "ws" else c
    return f"CASE WHEN count({value}) {over} = {k} THEN avg({value}) {over} END AS {c}_roll{k}"


@query(
    "past_rolling_means_ts3",
    f"{SEASON} SELECT id, " + ", ".join(storm_sql(c, k) for c in lags.LAG_COLUMNS for k in lags.ROLL_HOURS) + " FROM ready", ROLLED,
)
def _(spark, d):
    rows = frames.ready_season(spark, d).withColumn("ws", F.when(F.expr(STORM), float("inf")).otherwise(F.col("ws")))
    return lags.past_means(rows).select("id", *ROLLED)


@query(
    "moving_averages_ts4",
    f"{HOURLY} SELECT id, " + ", ".join(rolling_sql(c, -2, 0, f"{c}_ma") for c in lags.AVERAGE_COLUMNS) + " FROM clean",
    [f"{c}_ma" for c in lags.AVERAGE_COLUMNS],
)
def _(spark, d):
    return lags.moving_averages(frames.clean(spark, d)).select("id", *[f"{c}_ma" for c in lags.AVERAGE_COLUMNS])


def heads_sql(columns, longest: int, keys: str) -> str:
    """The first rows of each series as one list per column."""
    lists = ", ".join(f"list({c} ORDER BY i) FILTER (i < {longest}) AS head_{c}" for c in columns)
    return f"heads AS (SELECT {keys}, {lists} FROM placed GROUP BY {keys})"


def padded_value(c: str, n: int, longest: int) -> str:
    """x[i-n], or x[p-n+i] among the first p = min(longest, length) rows."""
    place = f"least({longest}, len) - {n} + i"
    return f"CASE WHEN i >= {n} THEN lag({c}, {n}) OVER w WHEN {place} >= 0 THEN head_{c}[{place} + 1] END"


#: the longest lists of any group, of all readings
PADDED = {c: list(n) for c, n in rules.LAG_LISTS["cluster0"].items() if c in NUMERIC}
PADDED_LONGEST = max(max(ns) for ns in PADDED.values())


@query(
    "padded_lags_ts5",
    f"""{HOURLY}, placed AS (SELECT *, row_number() OVER (PARTITION BY branch_id ORDER BY tm) - 1 AS i,
    count(*) OVER (PARTITION BY branch_id) AS len FROM ready), {heads_sql(PADDED, PADDED_LONGEST, "branch_id")} SELECT id, """
    + ", ".join(f"{padded_value(c, n, PADDED_LONGEST)} AS {c}_plag{n}" for c, ns in PADDED.items() for n in ns)
    + f" FROM placed JOIN heads USING (branch_id) {SITE}",
    names(PADDED, "{c}_plag{n}"),
)
def _(spark, d):
    return lags.padded_lags(frames.ready(spark, d), PADDED).select("id", *names(PADDED, "{c}_plag{n}"))


#: every list of every group, of readings and calendar columns
PARTS_OF_TIME = ("year", "month", "day", "hour")
ROUTED = {
    key: {c: list(ns) for c, ns in lists.items() if c in (*NUMERIC, *PARTS_OF_TIME)} for key, lists in rules.LAG_LISTS.items()
}
ROUTED_COLUMNS = sorted({c for m in ROUTED.values() for c in m})
ROUTED_NAMES = sorted({f"{c}_plag{n}" for m in ROUTED.values() for c, ns in m.items() for n in ns})


def routed_sql(name: str) -> str:
    c, n = name.split("_plag")[0], int(name.split("_plag")[1])
    cases = " ".join(
        f"WHEN '{key}' THEN {padded_value(c, n, lags.longest_lag(m))}" for key, m in ROUTED.items() if n in m.get(c, ())
    )
    return f"CASE cluster_key {cases} END AS {name}"


@query(
    "lags_by_model_group_ts6",
    f"""{SEASON}, {KEYED}, dated AS (SELECT *, {", ".join(f"{c}(tm) AS {c}" for c in PARTS_OF_TIME)} FROM keyed),
    placed AS (SELECT *, row_number() OVER (PARTITION BY cluster_key, branch_id ORDER BY tm) - 1
    AS i, count(*) OVER (PARTITION BY cluster_key, branch_id) AS len FROM dated),
    {heads_sql(ROUTED_COLUMNS, 30, "cluster_key, branch_id")} SELECT id, cluster_key, """
    + ", ".join(routed_sql(c) for c in ROUTED_NAMES)
    + " FROM placed JOIN heads USING (cluster_key, branch_id) WINDOW w AS (PARTITION BY cluster_key, branch_id ORDER BY tm)",
    ROUTED_NAMES,
)
def _(spark, d):
    dated = keyed_season(spark, d).withColumns({c: getattr(F, "dayofmonth" if c == "day" else c)("tm") for c in PARTS_OF_TIME})
    placed = GROUP_SITES.row_index(dated.select("id", "branch_id", "tm", "cluster_key", *ROUTED_COLUMNS))
    out = None
    for key, lag_map in ROUTED.items():
        part = lags.padded_lags(placed.filter(F.col("cluster_key") == key), lag_map, GROUP_SITES)
        part = part.select("id", "cluster_key", *names(lag_map, "{c}_plag{n}"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.select("id", "cluster_key", *[F.col(c).cast("double").alias(c) for c in ROUTED_NAMES])


@query(
    "running_radiation_ts7",
    f"""{SEASON} SELECT id, CASE WHEN si IS NOT NULL THEN sum(si) OVER (PARTITION BY branch_id, CAST(tm AS DATE)
    ORDER BY tm ROWS UNBOUNDED PRECEDING) END AS cumulative_si FROM clean""",
    "cumulative_si",
)
def _(spark, d):
    return lags.running_radiation(frames.clean_season(spark, d)).select("id", "cumulative_si")


SHIFTS = (1, 3, 5, 7, 24)
CHANGED = [f"ta_{k}_{n}h" for n in SHIFTS for k in ("diff", "pct")]


@query(
    "changes_ts8",
    f"{HOURLY} SELECT id, " + ", ".join(
        f"ta - lag(ta, {n}) OVER w AS ta_diff_{n}h, CASE WHEN lag(ta, {n}) OVER w <> 0 THEN "
        f"(ta - lag(ta, {n}) OVER w) / lag(ta, {n}) OVER w END AS ta_pct_{n}h" for n in SHIFTS
    ) + f" FROM clean {SITE}",
    CHANGED,
)
def _(spark, d):
    return lags.changes(frames.clean(spark, d), "ta").select("id", *CHANGED)


@query("lag_grid_ts9", f"{HOURLY} SELECT id, {lag_sql(GRID, '{c}_shift_{n}h')} FROM clean {SITE}",
       names(GRID, "{c}_shift_{n}h"))
def _(spark, d):
    return lags.lag_grid(frames.clean(spark, d), NUMERIC).select("id", *names(GRID, "{c}_shift_{n}h"))


@query(
    "first_differences_ts10",
    f"{SEASON} SELECT id, " + ", ".join(f"{c} - lag({c}) OVER w AS {c}_diff" for c in NUMERIC) + f" FROM clean {SITE}",
    [f"{c}_diff" for c in NUMERIC],
)
def _(spark, d):
    return lags.first_differences(frames.clean_season(spark, d), NUMERIC).select("id", *[f"{c}_diff" for c in NUMERIC])


def runs_sql(column: str, source: str = "clean") -> str:
    return f"""seen AS (SELECT branch_id, tm, {column} AS v, count({column}) OVER (PARTITION BY branch_id ORDER BY tm
      ROWS UNBOUNDED PRECEDING) AS g FROM {source}),
    runs AS (SELECT branch_id, min(tm) AS a, max(tm) AS b, count(*) AS length FROM seen WHERE v IS NULL
      GROUP BY branch_id, g)"""


SPAN = "strftime(a, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(b, '%Y-%m-%d %H:%M:%S') AS end_time"


@query("null_runs_ts11", f"{SEASON}, {runs_sql('ta')} SELECT branch_id, {SPAN}, length FROM runs")
def _(spark, d):
    runs = gaps.null_runs(frames.clean_season(spark, d), "ta")
    return runs.withColumns({c: frames.stamp(c) for c in ("start_time", "end_time")})


@query("null_run_lengths_ts11", f"{HOURLY}, {runs_sql('hm')} SELECT length, count(*) AS count FROM runs GROUP BY 1")
def _(spark, d):
    return gaps.length_counts(gaps.null_runs(frames.clean(spark, d), "hm"))


@query(
    "outage_runs_ts12",
    f"""{HOURLY}, blank AS (SELECT branch_id, tm FROM clean WHERE ta IS NULL),
    flagged AS (SELECT *, CASE WHEN tm - lag(tm) OVER (PARTITION BY branch_id ORDER BY tm) = INTERVAL 1 HOUR
      THEN 0 ELSE 1 END AS f FROM blank),
    grouped AS (SELECT *, sum(f) OVER (PARTITION BY branch_id ORDER BY tm ROWS UNBOUNDED PRECEDING) AS g FROM flagged),
    runs AS (SELECT branch_id, min(tm) AS a, max(tm) AS b, count(*) AS duration FROM grouped GROUP BY branch_id, g)
    SELECT branch_id, {SPAN}, duration FROM runs""",
)
def _(spark, d):
    runs = gaps.outage_runs(frames.clean(spark, d), ["ta"])
    return runs.withColumns({c: frames.stamp(c) for c in ("start_time", "end_time")})


def interpolation_sql(c: str, mode: str) -> str:
    straight = "y0 + (y1 - y0) * (i - x0) / (x1 - x0)"
    fill = straight
    if mode == "quadratic":
        def bend(x2: str, y2: str) -> str:
            chord = f"(y0 + (y1 - y0) * (({x2}) - x0) / (x1 - x0))"
            return f"{straight} + ({y2} - {chord}) / ((({x2}) - x0) * (({x2}) - x1)) * (i - x0) * (i - x1)"

        fill = f"CASE WHEN x1 - x0 - 1 <= 3 THEN {straight} ELSE coalesce({bend('x0 - 1', 'y0o')}, " \
               f"{bend('x1 + 1', 'y1o')}, {straight}) END"
    past = "OVER (PARTITION BY branch_id ORDER BY tm ROWS UNBOUNDED PRECEDING)"
    future = "OVER (PARTITION BY branch_id ORDER BY tm ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""placed AS (SELECT id, branch_id, tm, {c} AS v,
        CAST(row_number() OVER (PARTITION BY branch_id ORDER BY tm) AS DOUBLE) AS i,
        CAST(count(*) OVER (PARTITION BY branch_id) AS DOUBLE) AS n,
        lag({c}) OVER (PARTITION BY branch_id ORDER BY tm) AS vp, lead({c}) OVER (PARTITION BY branch_id ORDER BY tm) AS vn
      FROM clean),
    sides AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN i END) {past} AS x0,
        min(CASE WHEN v IS NOT NULL THEN i END) {future} AS x1 FROM placed),
    anchored AS (SELECT s.*, a.v AS y0, a.vp AS y0o, b.v AS y1, b.vn AS y1o FROM sides s
        LEFT JOIN placed a ON a.branch_id = s.branch_id AND a.i = s.x0
        LEFT JOIN placed b ON b.branch_id = s.branch_id AND b.i = s.x1)
    SELECT id, CASE WHEN v IS NOT NULL THEN v WHEN x0 IS NULL THEN NULL
        WHEN x1 IS NULL THEN CASE WHEN n - x0 <= 24 THEN y0 END
        WHEN x1 - x0 - 1 <= 24 THEN {fill} END AS {c} FROM anchored"""


@query("interpolate_linear_ts13", f"{HOURLY}, {interpolation_sql('ta', 'linear')}", "ta")
def _(spark, d):
    return gaps.interpolate_gaps(frames.clean(spark, d), ["ta"]).select("id", "ta")


@query("interpolate_quadratic_ts13", f"{SEASON}, {interpolation_sql('ta', 'quadratic')}", "ta")
def _(spark, d):
    return gaps.interpolate_gaps(frames.clean_season(spark, d), ["ta"], mode="quadratic").select("id", "ta")


#: orders by nation of the customer: many days have none
SPARSE = "SELECT c_nationkey AS nation, CAST(o_orderdate AS DATE) AS date, o_totalprice AS value FROM orders JOIN customer ON o_custkey = c_custkey"


def nation_orders(spark, d):
    orders = frames.table(spark, d, "orders").select("o_custkey", "o_orderdate", F.col("o_totalprice").alias("value"))
    nations = frames.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    return orders.join(nations, "o_custkey")


@query(
    "daily_resample_ts14",
    f"""WITH sparse AS ({SPARSE}), daily AS (SELECT nation, date, avg(value) AS value FROM sparse GROUP BY 1, 2),
    spine AS (SELECT nation, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
      FROM daily GROUP BY 1)
    SELECT nation, strftime(s.date, '%Y-%m-%d') AS date, value FROM spine s LEFT JOIN daily USING (nation, date)""",
    "value",
)
def _(spark, d):
    return gaps.daily_resample(nation_orders(spark, d), "value", ["nation"], "o_orderdate").withColumn("date", frames.day())


NATION_DAYS = Series(keys=("nation",), order=("date",), axis="date", span=1024)


@query(
    "interpolate_in_time_ts15",
    f"""WITH sparse AS ({SPARSE}), daily AS (SELECT nation, date, avg(value) AS value FROM sparse GROUP BY 1, 2),
    spine AS (SELECT nation, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
      FROM daily GROUP BY 1),
    j AS (SELECT nation, s.date, value FROM spine s LEFT JOIN daily USING (nation, date)),
    e AS (SELECT *, max(CASE WHEN value IS NOT NULL THEN date END) OVER (PARTITION BY nation ORDER BY date ROWS
        UNBOUNDED PRECEDING) AS d0, min(CASE WHEN value IS NOT NULL THEN date END) OVER (PARTITION BY nation
        ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS d1 FROM j)
    SELECT e.nation, strftime(e.date, '%Y-%m-%d') AS date, coalesce(e.value, a.value + (b.value - a.value)
      * (e.date - d0) / nullif(d1 - d0, 0), a.value, b.value) AS value FROM e
    LEFT JOIN j a ON a.nation = e.nation AND a.date = d0
    LEFT JOIN j b ON b.nation = e.nation AND b.date = d1""",
    "value",
)
def _(spark, d):
    daily = gaps.daily_resample(nation_orders(spark, d), "value", ["nation"], "o_orderdate")
    return gaps.interpolate_in_time(daily, "value", NATION_DAYS).withColumn("date", frames.day())


def decomposition_sql(source: str, keys: str, order: str, value: str, period: int) -> str:
    half = period // 2
    part = f"PARTITION BY {keys} " if keys else ""
    frame = f"({part}ORDER BY {order} ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"
    ends = f" - (lag({value}, {half}) OVER ({part}ORDER BY {order}) + lead({value}, {half}) OVER " \
           f"({part}ORDER BY {order})) / 2" if period % 2 == 0 else ""
    lead = f"{keys}, " if keys else ""
    using = f"{lead}phase"
    total = f"PARTITION BY {keys}" if keys else ""
    return f"""smooth AS (SELECT *, (row_number() OVER ({part}ORDER BY {order}) - 1) % {period} AS phase,
        CASE WHEN count({value}) OVER {frame} = {2 * half + 1} THEN (sum({value}) OVER {frame}{ends}) / {period} END AS trend
      FROM {source}),
    raw_phase AS (SELECT {lead}phase, avg({value} - trend) AS p FROM smooth GROUP BY {lead}phase),
    phases AS (SELECT {lead}phase, p - avg(p) OVER ({total}) AS seasonal FROM raw_phase),
    parts AS (SELECT smooth.*, seasonal, {value} - trend - seasonal AS resid FROM smooth LEFT JOIN phases USING ({using}))"""


DAY_TEXT = "strftime(date, '%Y-%m-%d') AS date"


@query(
    "decompose_daily_orders_ts16",
    f"""WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS value FROM orders GROUP BY 1),
    {decomposition_sql('daily', '', 'date', 'value', 30)} SELECT {DAY_TEXT}, value, trend, seasonal, resid FROM parts""",
    "value trend seasonal resid", places=4,
)
def _(spark, d):
    daily = panels.daily_orders(spark, d)
    return decompose.additive_decomposition(daily, "value", 30).withColumn("date", frames.day())


@query(
    "decompose_hours_by_site_ts16",
    f"{HOURLY}, {decomposition_sql('clean', 'branch_id', 'tm', 'ta_chi', 24)} SELECT id, trend, seasonal, resid FROM parts",
    "trend seasonal resid",
)
def _(spark, d):
    rows = frames.clean(spark, d).select("id", "branch_id", "tm", "ta_chi")
    out = decompose.additive_decomposition(rows, "ta_chi", 24, SITE_HOURS)
    return out.select("id", "trend", "seasonal", "resid")


@query("stl_by_site_ts17")
def _(spark, d):
    rows = frames.ready(spark, d).select("id", "branch_id", "tm", "ta_chi")
    return stl.stl(rows, "ta_chi").select("id", "trend", "seasonal", "resid")


@query(
    "stl_parts_add_up_ts17",
    f"""{HOURLY} SELECT branch_id, count(*) AS hours, 0e0 AS largest_gap, count(*) >= {stl.MIN_ROWS} AS has_season FROM ready GROUP BY 1""",
    "largest_gap",
)
def _(spark, d):
    """Trend, season and rest add up to the reading; series that are long enough have a season, the others none."""
    rows = frames.ready(spark, d).select("id", "branch_id", "tm", "ta_chi")
    parts = stl.robust_stl(rows, "ta_chi", rounds=1)
    gap = F.abs(F.col("trend") + F.col("seasonal") + F.col("resid") - F.col("ta_chi"))
    return parts.groupBy("branch_id").agg(
        F.count(F.lit(1)).alias("hours"), F.max(gap).alias("largest_gap"), (F.max(F.abs("seasonal")) > 0).alias("has_season"))


VARIABLES = list(WEATHER)
LAG_LIMIT = 100


def ccf_sql(keys: str) -> str:
    long = " UNION ALL ".join(
        f"SELECT {keys}, '{v}' AS variable, tm, heat_demand AS x, {v} AS y FROM keyed WHERE heat_demand IS NOT NULL "
        f"AND {v} IS NOT NULL" for v in VARIABLES
    )
    return f"""long AS ({long}),
    placed AS (SELECT *, row_number() OVER (PARTITION BY {keys}, variable ORDER BY tm) AS i FROM long),
    m AS (SELECT {keys}, variable, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(y) AS sy, count(*) AS n
      FROM placed GROUP BY {keys}, variable),
    pairs AS (SELECT {", ".join("a." + k for k in keys.split(", "))}, a.variable, k AS lag, a.y, b.x FROM placed a,
      (SELECT unnest(range(1, {LAG_LIMIT + 1})) AS k) JOIN placed b ON {" AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))}
      AND a.variable = b.variable AND b.i = a.i + k),
    found AS (SELECT {keys}, variable, CAST(lag AS INT) AS lag, sum((x - mx) * (y - my)) / any_value(n - lag)
      / (any_value(sx) * any_value(sy)) AS ccf FROM pairs JOIN m USING ({keys}, variable) GROUP BY {keys}, variable, lag),
    every AS (SELECT {keys}, variable, n, CAST(unnest(range(1, {LAG_LIMIT + 1})) AS INT) AS lag FROM m),
    ccf AS (SELECT {keys}, variable, lag, ccf, 1.96e0 / sqrt(n) AS band FROM every LEFT JOIN found USING ({keys}, variable, lag))"""


SEASON_KEYED = "keyed AS (SELECT *, CAST(month(tm) BETWEEN 6 AND 9 AS INT) AS is_summer FROM clean)"


def ccf_season(spark, d):
    rows = frames.clean_season(spark, d).withColumn("is_summer", F.month("tm").between(6, 9).cast("int"))
    lane = Series(keys=("is_summer", "branch_id"))
    return crosscorr.cross_correlation(rows, "heat_demand", VARIABLES, LAG_LIMIT, lane)


@query(
    "cross_correlation_ts18", f"{SEASON}, {SEASON_KEYED}, {ccf_sql('is_summer, branch_id')} SELECT * FROM ccf", "ccf band",
)
def _(spark, d):
    return ccf_season(spark, d)


@query(
    "best_lag_ts19",
    f"""{SEASON}, {SEASON_KEYED}, {ccf_sql('is_summer, branch_id')}, r AS (SELECT *, row_number() OVER (PARTITION BY
    is_summer, branch_id, variable ORDER BY abs(ccf) DESC, lag) AS rn FROM ccf)
    SELECT is_summer, branch_id, variable, lag AS best_lag, ccf AS ccf_value FROM r WHERE rn = 1""",
    "ccf_value",
)
def _(spark, d):
    return crosscorr.best_lag(ccf_season(spark, d), ["is_summer", "branch_id", "variable"])


@query(
    "value_before_nulls_ts20",
    f"""{HOURLY}, p AS (SELECT hm, lag(hm) OVER (PARTITION BY branch_id ORDER BY tm) AS previous FROM clean)
    SELECT previous, count(*) AS count FROM p WHERE hm IS NULL AND previous IS NOT NULL GROUP BY 1""",
    "previous",
)
def _(spark, d):
    return gaps.value_before_nulls(frames.clean(spark, d), "hm")


@query(
    "missing_hours_ts21",
    """WITH present AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS tm FROM events),
    ends AS (SELECT user_id, min(tm) AS a, max(tm) AS b FROM present GROUP BY 1),
    spine AS (SELECT user_id, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS tm FROM ends)
    SELECT s.user_id, strftime(s.tm, '%Y-%m-%d %H:%M:%S') AS tm FROM spine s
    LEFT JOIN present p ON p.user_id = s.user_id AND p.tm = s.tm WHERE p.tm IS NULL""",
)
def _(spark, d):
    present = frames.table(spark, d, "events").select("user_id", F.date_trunc("hour", "ts").alias("tm")).distinct()
    return gaps.missing_hours(present, ["user_id"]).withColumn("tm", frames.stamp())
