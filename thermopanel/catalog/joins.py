"""Queries on joins and lookups."""

from pyspark.sql import functions as F

from thermopanel import rules
from thermopanel.catalog import BREAKPOINTS_SQL, CLUSTERS_SQL, HOURLY, NIGHTS_SQL, SEASON, frames, query
from thermopanel.functions import calendar as cal
from thermopanel.operators import aggregates, cleaning, gaps, joins, stats

DATED = "dated AS (SELECT *, CAST(tm AS DATE) AS date FROM clean)"
FLAGS = """flags AS (SELECT date, CAST(coalesce(max(ta) >= 33, false) AS INT) AS heatwave,
    CAST(coalesce(min(ta) <= -12, false) AS INT) AS coldwave FROM dated GROUP BY date)"""


def dated(spark, d):
    return frames.clean(spark, d).withColumn("date", F.to_date("tm"))


@query(
    "daily_flags_joined_jn1",
    f"{HOURLY}, {DATED}, {FLAGS} SELECT id, heatwave, coldwave FROM dated LEFT JOIN flags USING (date)",
)
def _(spark, d):
    return joins.with_temperature_flags(dated(spark, d)).select("id", "heatwave", "coldwave")


@query(
    "two_daily_tables_jn2",
    f"""{HOURLY}, {DATED}, low AS (SELECT date, min(ta) AS ta_min FROM dated GROUP BY 1),
    rain AS (SELECT date, sum(rn_hr1) AS rain FROM dated WHERE rn_hr1 > 30 GROUP BY 1)
    SELECT strftime(low.date, '%Y-%m-%d') AS date, ta_min, rain FROM low LEFT JOIN rain USING (date)""",
    "ta_min rain",
)
def _(spark, d):
    days = dated(spark, d)
    low = days.groupBy("date").agg(F.min("ta").alias("ta_min"))
    rain = days.filter("rn_hr1 > 30").groupBy("date").agg(F.sum("rn_hr1").alias("rain"))
    return low.join(rain, "date", "left").withColumn("date", frames.day())


PARTS = [
    ("bucket", range(8), "hour(tm) // 3"), ("month", range(1, 13), "month(tm)"),
    ("season", cal.SEASON_LABELS, """CASE WHEN month(tm) BETWEEN 3 AND 5 THEN 'Spring' WHEN month(tm) BETWEEN 6 AND 8
      THEN 'Summer' WHEN month(tm) BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END"""),
    ("weekend", (0, 1), "CASE WHEN isodow(tm) >= 6 THEN 1 ELSE 0 END"),
]


def part_sql(name, labels, expr) -> str:
    cells = ", ".join(
        f"avg(heat_demand) FILTER (({expr}) = {repr(v) if isinstance(v, str) else v}) AS {name}_{v}" for v in labels
    )
    return f"(SELECT branch_id, {cells} FROM ready GROUP BY 1) AS t_{name}"


@query(
    "pattern_tables_joined_jn3",
    f"{SEASON} SELECT * FROM {part_sql(*PARTS[0])} " + " ".join(f"JOIN {part_sql(*p)} USING (branch_id)" for p in PARTS[1:]),
    [f"{n}_{v}" for n, labels, _ in PARTS for v in labels],
)
def _(spark, d):
    return aggregates.pattern_means_joined(frames.ready_season(spark, d))


@query(
    "submission_join_jn4",
    f"{HOURLY} SELECT o.id, p.heat_demand FROM obs o LEFT JOIN "
    "(SELECT id, heat_demand / 2 + 1 AS heat_demand FROM ready) p ON o.id = p.id",
    "heat_demand",
)
def _(spark, d):
    scored = frames.ready(spark, d).select("id", (F.col("heat_demand") / 2 + 1).alias("heat_demand"))
    return joins.fill_submission(frames.raw(spark, d).select("id", "heat_demand"), scored)


@query(
    "night_rule_range_join_jn5",
    f"""{SEASON} SELECT branch_id, count(*) AS rows, count(*) FILTER (EXISTS (SELECT 1 FROM {NIGHTS_SQL}
      WHERE n.site = r.branch_id AND month(r.tm) * 100 + day(r.tm) BETWEEN n.start_md AND n.end_md
      AND (hour(r.tm) >= n.night_start OR hour(r.tm) <= n.night_end))) AS night_rows FROM ready r GROUP BY 1""",
)
def _(spark, d):
    marked = cleaning.night_hours_dark(frames.ready_season(spark, d).withColumn("si", F.lit(1.0)))
    return marked.groupBy("branch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("si") == 0).alias("night_rows")
    )


#: hours that have a temperature reading
HOLES = "holes AS (SELECT branch_id, tm FROM clean WHERE ta IS NOT NULL)"


@query(
    "absent_hours_jn6",
    f"""{HOURLY}, {HOLES}, ends AS (SELECT branch_id, min(tm) AS a, max(tm) AS b FROM holes GROUP BY 1),
    spine AS (SELECT branch_id, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS tm FROM ends)
    SELECT branch_id, strftime(tm, '%Y-%m-%d %H:%M:%S') AS tm FROM spine s
    WHERE NOT EXISTS (SELECT 1 FROM holes h WHERE h.branch_id = s.branch_id AND h.tm = s.tm)""",
)
def _(spark, d):
    holes = frames.clean(spark, d).filter("ta IS NOT NULL").select("branch_id", "tm")
    return gaps.missing_hours(holes).withColumn("tm", frames.stamp())


@query(
    "static_lookups_jn7",
    f"""{HOURLY} SELECT cluster_id, CASE WHEN ta < x0 THEN 'low' WHEN ta < x1 THEN 'mid' ELSE 'high' END AS ta_zone,
    count(*) AS rows, avg(heat_demand) AS demand FROM ready r LEFT JOIN {BREAKPOINTS_SQL} ON r.branch_id = b.site
    LEFT JOIN {CLUSTERS_SQL} ON r.branch_id = c.site GROUP BY 1, 2""",
    "demand",
)
def _(spark, d):
    looked = joins.with_cluster(joins.with_temperature_zone(frames.ready(spark, d)))
    return looked.groupBy("cluster_id", "ta_zone").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("heat_demand").alias("demand")
    )


@query(
    "bind_columns_by_key_jn8",
    f"{HOURLY} SELECT branch_id, strftime(tm, '%Y-%m-%d %H:%M:%S') AS tm, ta, ws, heat_demand / 2 AS half FROM ready",
    "ta ws half",
)
def _(spark, d):
    rows = frames.ready(spark, d)
    left = rows.select("branch_id", "tm", "ta", "ws")
    right = rows.select("branch_id", "tm", (F.col("heat_demand") / 2).alias("half"))
    return joins.bind_columns(left, right, ["branch_id", "tm"]).withColumn("tm", frames.stamp())


FEATURES = ["ta", "ws", "hm", "si", "ta_chi"]


@query(
    "correlations_side_by_side_jn9",
    HOURLY + "SELECT feature, " + ", ".join(f"max(corr) FILTER (branch_id = '{s}') AS {s}" for s in rules.SITES)
    + " FROM (" + " UNION ALL ".join(
        f"SELECT branch_id, '{f}' AS feature, corr({f}, heat_demand) AS corr FROM ready GROUP BY 1" for f in FEATURES
    ) + ") GROUP BY 1",
    list(rules.SITES),
)
def _(spark, d):
    long = stats.correlation_with(frames.ready(spark, d), "heat_demand", FEATURES, ["branch_id"])
    return joins.side_by_side(long, "feature", "branch_id", list(rules.SITES), "corr")
