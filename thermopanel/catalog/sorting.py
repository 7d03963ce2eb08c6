"""Queries on sorting, top rows, set operations and reshaping."""

from pyspark.sql import functions as F

from thermopanel import rules
from thermopanel.catalog import HOURLY, frames, query
from thermopanel.catalog.features import SECTOR8
from thermopanel.functions import weather
from thermopanel.functions.numeric import unpivot
from thermopanel.models.splits import PANEL_ORDER
from thermopanel.operators import joins, ordering

STAMP = "strftime(tm, '%Y-%m-%d %H:%M:%S') AS tm"


@query("multi_key_sort_so1", f"{HOURLY} SELECT branch_id, {STAMP}, id FROM obs ORDER BY branch_id, obs.tm")
def _(spark, d):
    rows = frames.raw(spark, d).select("branch_id", "tm", "id")
    return ordering.sort_by(rows, ["branch_id", "tm"]).withColumn("tm", frames.stamp())


@query("top_rows_so2", f"{HOURLY} SELECT id, heat_demand FROM ready ORDER BY heat_demand DESC, id LIMIT 30", "heat_demand")
def _(spark, d):
    return ordering.top_rows(frames.ready(spark, d).select("id", "heat_demand"), "heat_demand", 30, ["id"])


@query("order_by_list_so3", f"{HOURLY}, s AS (SELECT {SECTOR8} AS sector FROM clean) SELECT sector, count(*) AS rows FROM s GROUP BY 1")
def _(spark, d):
    counts = frames.clean(spark, d).groupBy(weather.wind_sector8().alias("sector")).agg(F.count(F.lit(1)).alias("rows"))
    return ordering.order_by_list(counts, "sector", weather.SECTORS8)


PLACED = "placed AS (SELECT *, row_number() OVER (ORDER BY tm, branch_id) - 1 AS i, count(*) OVER () AS n FROM obs)"


@query("position_slice_so4", f"{HOURLY}, {PLACED} SELECT id FROM placed WHERE i >= 100 AND i < 130")
def _(spark, d):
    return ordering.position_slice(frames.raw(spark, d), PANEL_ORDER, 100, 130).select("id")


@query("tail_rows_so4", f"{HOURLY}, {PLACED} SELECT id FROM placed WHERE i >= n - 10")
def _(spark, d):
    return ordering.position_slice(frames.raw(spark, d), PANEL_ORDER, -10, 0).select("id")


@query(
    "union_of_groups_se1",
    f"{HOURLY} SELECT id, 'north' AS part, ta, NULL::DOUBLE AS ws FROM clean WHERE branch_id < 'J' UNION ALL "
    "SELECT id, 'south', NULL, ws FROM clean WHERE branch_id >= 'J'", "ta ws",
)
def _(spark, d):
    rows = frames.clean(spark, d)
    north = rows.filter("branch_id < 'J'").select("id", F.lit("north").alias("part"), "ta")
    south = rows.filter("branch_id >= 'J'").select("id", F.lit("south").alias("part"), "ws")
    return ordering.union_all([north, south])


@query(
    "common_keys_se2",
    f"{HOURLY} SELECT hm FROM clean WHERE branch_id = 'A' INTERSECT SELECT hm FROM clean WHERE branch_id = 'B'", "hm",
)
def _(spark, d):
    rows = frames.clean(spark, d)
    return joins.common_keys([rows.filter("branch_id = 'A'"), rows.filter("branch_id = 'B'")], ["hm"])


@query(
    "key_difference_se3",
    f"{HOURLY} SELECT heat_demand FROM ready WHERE branch_id = 'A' EXCEPT SELECT heat_demand FROM ready WHERE branch_id <> 'A'",
    "heat_demand",
)
def _(spark, d):
    rows = frames.ready(spark, d)
    return joins.keys_only_in(rows.filter("branch_id = 'A'"), rows.filter("branch_id <> 'A'"), ["heat_demand"])


@query(
    "wide_to_long_se4",
    HOURLY + " UNION ALL ".join(f"SELECT id, '{c}' AS variable, {c} AS value FROM clean" for c in ("ta", "ws", "hm")), "value",
)
def _(spark, d):
    return unpivot(frames.clean(spark, d), ["id"], ["ta", "ws", "hm"])


@query(
    "long_to_wide_se4",
    HOURLY + f"SELECT {STAMP}, " + ", ".join(f"max(ta_chi) FILTER (branch_id = '{s}') AS {s}" for s in rules.SITES)
    + " FROM clean GROUP BY clean.tm", list(rules.SITES),
)
def _(spark, d):
    rows = frames.clean(spark, d).withColumn("tm", frames.stamp())
    return joins.side_by_side(rows, "tm", "branch_id", list(rules.SITES), "ta_chi")
