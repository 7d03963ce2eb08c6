"""Queries on per-row features."""

from pyspark.sql import functions as F

from thermopanel import rules
from thermopanel.catalog import BREAKPOINTS_SQL, CLUSTERS_SQL, HOURLY, SEASON, frames, query
from thermopanel.functions import calendar as cal
from thermopanel.functions import weather
from thermopanel.operators import cleaning, joins

SEASON_SQL = """CASE WHEN month(tm) BETWEEN 3 AND 5 THEN 'Spring' WHEN month(tm) BETWEEN 6 AND 8 THEN 'Summer'
    WHEN month(tm) BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END"""
GROUP_SQL = """CASE WHEN month(tm) BETWEEN 6 AND 9 THEN 'summer' WHEN month(tm) IN (3, 11) THEN 'early_winter'
    WHEN month(tm) IN (4, 5, 10) THEN 'mid_season' ELSE 'winter' END"""


@query(
    "calendar_parts_fe1",
    f"""{SEASON} SELECT id, year(tm) AS year, quarter(tm) AS quarter, month(tm) AS month, day(tm) AS day,
    hour(tm) AS hour, strftime(tm, '%Y-%m-%d') AS date, isodow(tm) - 1 AS day_of_week,
    CASE WHEN isodow(tm) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS is_weekend, weekofyear(tm) AS weekofyear,
    hour(tm) // 3 AS hour_group FROM obs""",
)
def _(spark, d):
    dated = cleaning.with_calendar(frames.raw_season(spark, d).select("id", "tm"))
    return dated.withColumn("date", frames.day()).drop("tm")


@query("hour_group_fe2", f"{HOURLY} SELECT hour(tm) // 3 AS hour_group, count(*) AS rows, avg(heat_demand) AS demand "
       "FROM ready GROUP BY 1", "demand")
def _(spark, d):
    bucket = cal.hour_group(F.hour("tm")).alias("hour_group")
    return frames.ready(spark, d).groupBy(bucket).agg(
        F.count(F.lit(1)).alias("rows"), F.avg("heat_demand").alias("demand")
    )


@query("season_fe3", f"{SEASON} SELECT id, {SEASON_SQL} AS season FROM obs")
def _(spark, d):
    return frames.raw_season(spark, d).select("id", cal.season(F.month("tm")).alias("season"))


@query("season_group_fe4", f"{SEASON} SELECT id, {GROUP_SQL} AS season_group FROM obs")
def _(spark, d):
    return frames.raw_season(spark, d).select("id", cal.season_group(F.month("tm")).alias("season_group"))


@query("summer_split_fe5", f"{SEASON} SELECT CASE WHEN month(tm) BETWEEN 6 AND 9 THEN 1 ELSE 0 END AS is_summer, "
       "count(*) AS rows, avg(heat_demand) AS demand FROM ready GROUP BY 1", "demand")
def _(spark, d):
    summer = cal.is_long_summer(F.month("tm")).cast("int").alias("is_summer")
    return frames.ready_season(spark, d).groupBy(summer).agg(
        F.count(F.lit(1)).alias("rows"), F.avg("heat_demand").alias("demand")
    )


def cycle_sql(name: str, value: str, period: int) -> str:
    return f"sin(2 * pi() * ({value}) / {period}) AS {name}_sin, cos(2 * pi() * ({value}) / {period}) AS {name}_cos"


WEEK_HOUR = "(isodow(tm) - 1) * 24 + hour(tm)"
CYCLES = ("hour", "month", "weekhour", "monthday")


@query(
    "cyclical_parts_fe6",
    f"{SEASON} SELECT id, {WEEK_HOUR} AS hour_of_week, day(tm) AS day_of_month, {cycle_sql('hour', 'hour(tm)', 24)}, "
    f"{cycle_sql('month', 'month(tm)', 12)}, {cycle_sql('weekhour', WEEK_HOUR, 168)}, "
    f"{cycle_sql('monthday', 'day(tm)', 30)} FROM obs",
    [f"{c}_{f}" for c in CYCLES for f in ("sin", "cos")],
)
def _(spark, d):
    return frames.raw_season(spark, d).select("id", "tm").withColumns(cal.cyclical_parts()).drop("tm")


@query(
    "wind_vector_fe7",
    f"{HOURLY} SELECT id, radians(wd) AS wd_rad, sin(radians(wd)) AS wd_sin, cos(radians(wd)) AS wd_cos FROM clean",
    "wd_rad wd_sin wd_cos",
)
def _(spark, d):
    return frames.clean(spark, d).select("id", "wd").withColumns(weather.wind_vector()).drop("wd")


SECTOR4 = "CASE WHEN wd IS NULL THEN '{}' WHEN wd >= 45 AND wd < 135 THEN 'E' WHEN wd >= 135 AND wd < 225 THEN 'S' " \
    "WHEN wd >= 225 AND wd < 315 THEN 'W' ELSE 'N' END"


@query(
    "wind_sector4_fe8",
    f"{HOURLY} SELECT id, {SECTOR4.format('Unknown')} AS wd_group, {SECTOR4.format('N')} AS wd_group_north FROM clean",
)
def _(spark, d):
    return frames.clean(spark, d).select(
        "id", weather.wind_sector4().alias("wd_group"), weather.wind_sector4(null_label="N").alias("wd_group_north")
    )


SECTOR8 = "coalesce(CASE CAST(floor((((wd % 360) + 360) % 360) / 45) AS INT) " + " ".join(
    f"WHEN {i} THEN '{s}'" for i, s in enumerate(weather.SECTORS8)
) + " END, 'Unknown')"


@query("wind_sector8_fe9", f"{HOURLY} SELECT id, {SECTOR8} AS sector FROM clean")
def _(spark, d):
    return frames.clean(spark, d).select("id", weather.wind_sector8().alias("sector"))


CALM, WEAK, MEDIUM, STRONG = weather.WIND_CLASSES


@query(
    "wind_speed_class_fe10",
    f"""{HOURLY} SELECT id, CASE WHEN ws IS NULL THEN 'Unknown' WHEN ws < 1 THEN '{CALM}' WHEN ws < 4 THEN '{WEAK}'
    WHEN ws < 9 THEN '{MEDIUM}' ELSE '{STRONG}' END AS ws_group, CASE WHEN ws < 1 THEN 'calm' WHEN ws < 4 THEN 'weak'
    WHEN ws < 9 THEN 'medium' ELSE 'strong' END AS ws_group_plain FROM clean""",
)
def _(spark, d):
    plain = weather.wind_speed_class(labels=("calm", "weak", "medium", "strong"), null_label="strong")
    return frames.clean(spark, d).select(
        "id", weather.wind_speed_class().alias("ws_group"), plain.alias("ws_group_plain")
    )


@query(
    "rain_intensity_fe11",
    f"""{HOURLY} SELECT id, CASE WHEN rn_hr1 < 3 THEN 'weak' WHEN rn_hr1 < 15 THEN 'normal' WHEN rn_hr1 < 30
    THEN 'strong' WHEN rn_hr1 >= 30 THEN 'very strong' ELSE 'unknown' END AS rain_intensity FROM clean""",
)
def _(spark, d):
    return frames.clean(spark, d).select("id", weather.rain_intensity().alias("rain_intensity"))


@query(
    "temperature_features_fe12",
    f"""{HOURLY} SELECT id, ta_chi - ta AS ta_diff_chi, CASE WHEN 18 - ta < 0 THEN 0 ELSE 18 - ta END AS heating_degree,
    CASE WHEN ta - 24 < 0 THEN 0 ELSE ta - 24 END AS cooling_degree FROM clean""",
    "ta_diff_chi heating_degree cooling_degree",
)
def _(spark, d):
    return frames.clean(spark, d).select("id", "ta", "ta_chi").withColumns(weather.temperature_features()).drop("ta", "ta_chi")


ALPHA = "((17.27e0 * ta) / (237.7e0 + ta) + ln(CASE WHEN hm > 0 THEN hm END / 100e0))"


@query("dew_point_fe13", f"{HOURLY} SELECT id, (237.7e0 * {ALPHA}) / (17.27e0 - {ALPHA}) AS dew_point FROM clean", "dew_point")
def _(spark, d):
    return frames.clean(spark, d).select("id", weather.dew_point().alias("dew_point"))


@query(
    "discomfort_interaction_fe14",
    f"""{SEASON} SELECT id, (0.81e0 * ta + 0.01e0 * hm * (0.99e0 * ta - 14.3e0) + 46.3e0)
    * (CASE WHEN branch_id IN ('K','E','J','C','D','P','R','S') THEN 1 ELSE 0 END)
    * (CASE WHEN month(tm) BETWEEN 6 AND 9 THEN 1 ELSE 0 END) AS di_interaction FROM clean""",
    "di_interaction",
)
def _(spark, d):
    grouped = frames.clean_season(spark, d).withColumn("season_group", cal.season_group(F.month("tm")))
    return grouped.select("id", weather.discomfort_interaction().alias("di_interaction"))


UNKNOWN_SITE = "CASE WHEN id % 50 = 0 THEN 'Z' ELSE branch_id END"


@query(
    "temperature_zone_fe15",
    f"""{HOURLY}, moved AS (SELECT id, {UNKNOWN_SITE} AS branch_id, ta FROM clean)
    SELECT id, m.branch_id, CASE WHEN x0 IS NULL THEN 'unknown' WHEN ta < x0 THEN 'low' WHEN ta < x1 THEN 'mid'
    ELSE 'high' END AS ta_zone FROM moved m LEFT JOIN {BREAKPOINTS_SQL} ON m.branch_id = b.site""",
)
def _(spark, d):
    moved = frames.clean(spark, d).select("id", F.expr(UNKNOWN_SITE).alias("branch_id"), "ta")
    return joins.with_temperature_zone(moved).select("id", "branch_id", "ta_zone")


@query("day_flag_fe16", f"{HOURLY} SELECT id, CASE WHEN hour(tm) BETWEEN 12 AND 18 THEN 1 ELSE 0 END AS day_flag FROM obs")
def _(spark, d):
    return frames.raw(spark, d).select("id", cal.day_flag(F.hour("tm")).alias("day_flag"))


MOVED = f"moved AS (SELECT id, {UNKNOWN_SITE} AS branch_id FROM clean)"


@query(
    "site_cluster_fe17",
    f"{HOURLY}, {MOVED} SELECT id, branch_id, cluster_id FROM moved m LEFT JOIN {CLUSTERS_SQL} ON m.branch_id = c.site",
)
def _(spark, d):
    moved = frames.clean(spark, d).select("id", F.expr(UNKNOWN_SITE).alias("branch_id"))
    return joins.with_cluster(moved).select("id", "branch_id", "cluster_id")


@query(
    "unmapped_sites_fe17",
    f"{HOURLY}, {MOVED} SELECT branch_id, count(*) AS rows FROM moved WHERE branch_id NOT IN "
    f"(SELECT site FROM {CLUSTERS_SQL}) GROUP BY 1",
)
def _(spark, d):
    moved = frames.clean(spark, d).select("id", F.expr(UNKNOWN_SITE).alias("branch_id"))
    return joins.unmapped_sites(joins.with_cluster(moved))


@query(
    "member_label_fe18",
    f"{HOURLY} SELECT CASE WHEN branch_id IN ('B','C','G') THEN 'Cluster 1' ELSE 'Other' END AS cluster, "
    "count(*) AS rows, avg(heat_demand) AS demand FROM ready GROUP BY 1", "demand",
)
def _(spark, d):
    label = weather.member_label("branch_id", rules.cluster_members(1), "Cluster 1").alias("cluster")
    return frames.ready(spark, d).groupBy(label).agg(
        F.count(F.lit(1)).alias("rows"), F.avg("heat_demand").alias("demand")
    )


@query(
    "extreme_hours_fe19",
    f"{HOURLY} SELECT branch_id, count(*) FILTER (ta <= -12) AS cold_hours, count(*) FILTER (ta >= 33) AS hot_hours "
    "FROM clean GROUP BY 1",
)
def _(spark, d):
    flags = weather.extreme_flags()
    return frames.clean(spark, d).groupBy("branch_id").agg(
        F.count_if(flags["is_cold"]).alias("cold_hours"), F.count_if(flags["is_hot"]).alias("hot_hours")
    )


@query("day_mod7_fe20", f"{SEASON} SELECT id, day(tm) % 7 AS day_mod7 FROM obs")
def _(spark, d):
    return frames.raw_season(spark, d).select("id", cal.day_mod7(F.dayofmonth("tm")).alias("day_mod7"))


@query("night_flag_fe21", f"{HOURLY} SELECT id, CAST(hour(tm) >= 18 OR hour(tm) <= 6 AS INT) AS is_night FROM obs")
def _(spark, d):
    return frames.raw(spark, d).select("id", cal.night_flag(F.hour("tm")).cast("int").alias("is_night"))
