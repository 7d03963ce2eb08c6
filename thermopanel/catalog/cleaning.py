"""Queries on missing codes, ranges, fills, filters and audits."""

from pyspark.sql import functions as F

from thermopanel.catalog import CLUSTERS_SQL, HOURLY, NIGHTS_SQL, SEASON, frames, query
from thermopanel.functions import calendar as cal
from thermopanel.models.splits import with_cluster_key
from thermopanel.operators import cleaning, joins
from thermopanel.sources.panels import NUMERIC, WEATHER

ALL = ", ".join(NUMERIC)
FILL = [c for c in WEATHER if c != "ta_chi"]


@query("sentinel_to_null_cl1", f"{HOURLY} SELECT id, {ALL} FROM clean", NUMERIC)
def _(spark, d):
    return frames.clean(spark, d).select("id", *NUMERIC)


@query(
    "sentinel_audit_cl2",
    HOURLY + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count(*) FILTER ({c} = -99) AS rows, "
        f"CAST(count(*) FILTER ({c} = -99) > 0 AS INT) AS has_sentinel FROM obs" for c in NUMERIC
    ),
)
def _(spark, d):
    return cleaning.sentinel_audit(frames.raw(spark, d))


@query(
    "rows_with_sentinel_cl2",
    f"{HOURLY} SELECT count(*) AS rows FROM obs WHERE " + " OR ".join(f"{c} = -99" for c in NUMERIC),
)
def _(spark, d):
    return cleaning.rows_with_sentinel(frames.raw(spark, d))


@query("drop_null_target_cl3", f"{HOURLY} SELECT id, branch_id, heat_demand FROM ready", "heat_demand")
def _(spark, d):
    return frames.ready(spark, d).select("id", "branch_id", "heat_demand")


PARSED = "strftime(tm, '%Y-%m-%d %H:%M:%S') AS tm_text, year(tm) AS y, hour(tm) AS h"


@query("parse_timestamp_cl4", f"{HOURLY} SELECT id, {PARSED}, 1 AS same FROM obs")
def _(spark, d):
    text = frames.raw(spark, d).select(
        "id", frames.stamp().alias("long_text"), F.date_format("tm", "yyyyMMddHH").cast("long").alias("hour_number")
    )
    both = text.select(
        "id", cal.parse_hour("long_text").alias("tm"), cal.parse_hour("hour_number", "yyyyMMddHH").alias("tm2")
    )
    return both.select(
        "id", frames.stamp().alias("tm_text"), F.year("tm").alias("y"), F.hour("tm").alias("h"),
        (F.col("tm") == F.col("tm2")).cast("int").alias("same"),
    )


@query("lenient_month_cl5", f"{HOURLY} SELECT id, CASE WHEN id % 7 = 3 THEN -1 ELSE month(tm) END AS month FROM obs")
def _(spark, d):
    text = F.when(F.col("id") % 7 == 3, "not a stamp").otherwise(F.date_format("tm", "yyyyMMddHH"))
    return frames.raw(spark, d).select("id", cal.month_or_unknown(text).alias("month"))


CLIPPED = "((wd % 360e0) + 360e0) % 360e0 AS wd, " + ", ".join(
    f"CASE WHEN {c} < 0 THEN 0e0 ELSE {c} END AS {c}" for c in ("si", "ws", "rn_day", "rn_hr1")
)


@query(
    "clip_ranges_cl6",
    f"{HOURLY}, shifted AS (SELECT id, wd - 90 AS wd, si - 1 AS si, ws - 1 AS ws, rn_day - 1 AS rn_day, "
    f"rn_hr1 - 1 AS rn_hr1 FROM clean) SELECT id, {CLIPPED} FROM shifted",
    "wd si ws rn_day rn_hr1",
)
def _(spark, d):
    cols = {"wd": 90, "si": 1, "ws": 1, "rn_day": 1, "rn_hr1": 1}
    shifted = frames.clean(spark, d).select("id", *[(F.col(c) - s).alias(c) for c, s in cols.items()])
    return cleaning.clip_ranges(shifted)


NIGHT_TEST = f"""EXISTS (SELECT 1 FROM {NIGHTS_SQL} WHERE n.site = r.branch_id
    AND month(r.tm) * 100 + day(r.tm) BETWEEN n.start_md AND n.end_md
    AND (hour(r.tm) >= n.night_start OR hour(r.tm) <= n.night_end))"""


@query("night_radiation_cl7", f"{SEASON} SELECT id, CASE WHEN {NIGHT_TEST} THEN 0e0 ELSE si END AS si FROM ready r", "si")
def _(spark, d):
    return cleaning.night_hours_dark(frames.ready_season(spark, d)).select("id", "si")


def forward(c: str, over: str) -> str:
    return f"last_value({c} IGNORE NULLS) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def backward(c: str, over: str) -> str:
    return f"first_value({c} IGNORE NULLS) OVER ({over} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def filled_sql(over: str, zero: bool) -> str:
    rest = "0e0" if zero else None
    return ", ".join(
        f"coalesce({forward(c, over)}, {rest or backward(c, over)}) AS {c}" for c in FILL
    )


@query(
    "scoring_fill_by_site_cl8",
    f"{SEASON} SELECT id, {filled_sql('PARTITION BY branch_id ORDER BY tm', True)} FROM ready", FILL,
)
def _(spark, d):
    return cleaning.fill_for_scoring(frames.ready_season(spark, d), FILL).select("id", *FILL)


@query("scoring_fill_by_row_cl8", f"{HOURLY} SELECT id, {filled_sql('ORDER BY id', True)} FROM ready", FILL)
def _(spark, d):
    return cleaning.fill_for_scoring(frames.ready(spark, d), FILL, across_groups=True).select("id", *FILL)


KEYED = f"""keyed AS (SELECT r.*, CASE WHEN cluster_id = 2 THEN
      CASE WHEN month(tm) BETWEEN 6 AND 9 THEN 'cluster2_summer' ELSE 'cluster2_non_summer' END
      ELSE 'cluster' || CAST(cluster_id AS VARCHAR) END AS cluster_key
    FROM ready r JOIN {CLUSTERS_SQL} ON r.branch_id = c.site)"""


def keyed_season(spark, d):
    return with_cluster_key(joins.with_cluster(frames.ready_season(spark, d)))


@query(
    "residual_fill_across_sites_cl9",
    f"{SEASON}, {KEYED} SELECT id, cluster_key, "
    f"{filled_sql('PARTITION BY cluster_key ORDER BY branch_id, tm', False)} FROM keyed WHERE cluster_key IS NOT NULL",
    FILL,
)
def _(spark, d):
    return cleaning.fill_residual(keyed_season(spark, d), FILL, across_groups=True).select("id", "cluster_key", *FILL)


@query(
    "residual_fill_by_site_cl9",
    f"{SEASON}, {KEYED} SELECT id, cluster_key, "
    f"{filled_sql('PARTITION BY cluster_key, branch_id ORDER BY tm', False)} FROM keyed",
    FILL,
)
def _(spark, d):
    return cleaning.fill_residual(keyed_season(spark, d), FILL).select("id", "cluster_key", *FILL)


DIRTY = """dirty AS (SELECT id, CASE WHEN id % 10 = 1 THEN CAST('Infinity' AS DOUBLE) WHEN id % 10 = 2
    THEN CAST('-Infinity' AS DOUBLE) WHEN id % 10 = 3 THEN 1e11 ELSE heat_demand END AS heat_demand, ta FROM clean)"""


def dirty(spark, d):
    inf = float("inf")
    y = (
        F.when(F.col("id") % 10 == 1, F.lit(inf)).when(F.col("id") % 10 == 2, F.lit(-inf))
        .when(F.col("id") % 10 == 3, F.lit(1e11)).otherwise(F.col("heat_demand"))
    )
    return frames.clean(spark, d).select("id", y.alias("heat_demand"), "ta")


@query(
    "valid_target_cl10",
    f"{HOURLY}, {DIRTY} SELECT id, heat_demand FROM dirty WHERE abs(heat_demand) < 'Infinity'::DOUBLE "
    "AND heat_demand <= 1e10",
    "heat_demand",
)
def _(spark, d):
    return cleaning.valid_target(dirty(spark, d)).select("id", "heat_demand")


@query("threshold_rows_cl11", f"{HOURLY} SELECT id, branch_id, heat_demand FROM ready WHERE heat_demand >= 80", "heat_demand")
def _(spark, d):
    return cleaning.above_threshold(frames.ready(spark, d), "heat_demand", 80.0).select("id", "branch_id", "heat_demand")


@query(
    "threshold_rows_of_site_cl11",
    f"{HOURLY} SELECT id, ws FROM ready WHERE ws >= 8 AND branch_id = 'D'", "ws",
)
def _(spark, d):
    return cleaning.above_threshold(frames.ready(spark, d), "ws", 8.0, "D").select("id", "ws")


def iqr_sql(c: str) -> str:
    return f"""SELECT '{c}' AS variable, lo AS lower_bound, hi AS upper_bound,
        count(*) FILTER ({c} < lo OR {c} > hi) AS num_outliers,
        round(100e0 * count(*) FILTER ({c} < lo OR {c} > hi) / count(*), 2) AS percent_outliers
      FROM clean, (SELECT q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM
        (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM clean)) GROUP BY lo, hi"""


@query(
    "iqr_outliers_cl12", HOURLY + " UNION ALL ".join(iqr_sql(c) for c in NUMERIC),
    "lower_bound upper_bound percent_outliers",
)
def _(spark, d):
    return cleaning.iqr_outliers(frames.clean(spark, d), NUMERIC)


@query(
    "log_and_back_cl13",
    f"{HOURLY} SELECT id, ln(1 + heat_demand) AS heat_demand_log, heat_demand AS back FROM ready",
    "heat_demand_log back",
)
def _(spark, d):
    logged = frames.ready(spark, d).withColumn("heat_demand_log", F.log1p("heat_demand"))
    return logged.select("id", "heat_demand_log", F.expm1("heat_demand_log").alias("back"))


@query(
    "drop_service_columns_cl14",
    f"{HOURLY} SELECT id, branch_id, year(tm) AS year, month(tm) AS month, hour(tm) AS hour, ta FROM ready", "ta",
)
def _(spark, d):
    dated = cleaning.with_calendar(frames.ready(spark, d).select("id", "branch_id", "tm", "ta", "wd"))
    return cleaning.drop_service_columns(dated).drop("tm", "day", "is_weekend", "weekofyear", "hour_group")


SLICE = "tm >= TIMESTAMP '2021-01-05 00:00:00' AND tm {} TIMESTAMP '2021-01-12 00:00:00' AND branch_id = 'A'"


@query("date_slice_cl15", f"{HOURLY} SELECT id, ta FROM clean WHERE {SLICE.format('<')}", "ta")
def _(spark, d):
    return cleaning.date_slice(frames.clean(spark, d), "2021-01-05", "2021-01-12", "A").select("id", "ta")


@query("closed_date_slice_cl15", f"{HOURLY} SELECT id, ta FROM clean WHERE {SLICE.format('<=')}", "ta")
def _(spark, d):
    return cleaning.date_slice(frames.clean(spark, d), "2021-01-05", "2021-01-12", "A", closed=True).select("id", "ta")


@query(
    "unique_keys_cl16",
    f"{HOURLY} SELECT id, heat_demand FROM (SELECT *, count(*) OVER (PARTITION BY heat_demand) AS n FROM ready) "
    "WHERE n = 1", "heat_demand",
)
def _(spark, d):
    return cleaning.unique_by(frames.ready(spark, d), ["heat_demand"]).select("id", "heat_demand")


@query(
    "finite_rows_cl17",
    f"{HOURLY}, {DIRTY} SELECT id, heat_demand, ta FROM dirty WHERE abs(heat_demand) < 'Infinity'::DOUBLE "
    "AND ta IS NOT NULL", "heat_demand ta",
)
def _(spark, d):
    return cleaning.finite_rows(dirty(spark, d), ["heat_demand", "ta"])


@query(
    "infinite_counts_cl17",
    f"{HOURLY}, {DIRTY} SELECT 'heat_demand' AS variable, count(*) FILTER (abs(heat_demand) = 'Infinity'::DOUBLE) "
    "AS infinite FROM dirty UNION ALL SELECT 'ta', count(*) FILTER (abs(ta) = 'Infinity'::DOUBLE) FROM dirty",
)
def _(spark, d):
    return cleaning.infinite_counts(dirty(spark, d), ["heat_demand", "ta"])


def audit_sql(c: str) -> str:
    codes = "-99e0, -9.9e0" if c == "wd" else "-99e0"
    return (
        f"SELECT '{c}' AS variable, count(*) FILTER ({c} < 0 AND {c} NOT IN ({codes})) AS negative, "
        f"count(*) FILTER ({c} = 0) AS zero, count(*) FILTER ({c} IS NULL OR {c} IN ({codes})) AS missing FROM obs"
    )


@query("domain_audit_cl18", HOURLY + " UNION ALL ".join(audit_sql(c) for c in NUMERIC))
def _(spark, d):
    return cleaning.domain_audit(frames.raw(spark, d), NUMERIC)


@query("strict_numeric_cl19", f"{HOURLY} SELECT id, rn_day, rn_hr1 FROM clean", "rn_day rn_hr1")
def _(spark, d):
    text = frames.clean(spark, d).select("id", *[F.col(c).cast("string").alias(c) for c in ("rn_day", "rn_hr1")])
    return cleaning.strict_numeric(text, ["rn_day", "rn_hr1"])
