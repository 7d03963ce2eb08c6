"""Hourly site panels: derived from the ``events`` table, or read from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NUMERIC = ("ta", "wd", "ws", "rn_day", "rn_hr1", "hm", "si", "ta_chi", "heat_demand")
WEATHER = ("ta", "wd", "ws", "rn_day", "rn_hr1", "hm", "si", "ta_chi")

#: column -> expression over ``events``; plain arithmetic, the same text in any SQL engine
PANEL_COLUMNS = {
    "id": "event_id",
    "branch_id": "substr('ABCDEFGHIJKLMNOPQRS', CAST(event_id % 19 AS INT) + 1, 1)",
    "ta": """CASE WHEN event_id % 38 = 5
          OR (event_id % 19 = 4 AND event_id BETWEEN 190 AND 760)
          OR (event_id % 19 = 7 AND floor(event_id / 19e0) % 50 BETWEEN 10 AND 15)
          OR (event_id % 19 = 12 AND floor(event_id / 19e0) % 20 BETWEEN 3 AND 4)
          OR event_id = 17
        THEN -99e0 ELSE value / 2e0 - 20e0 END""",
    "wd": """CASE WHEN event_id % 25 = 0 THEN -9.9e0 WHEN event_id % 41 = 0 THEN -99e0
        ELSE CAST((event_id * 53) % 361 AS DOUBLE) END""",
    "ws": "CASE WHEN event_id % 43 = 0 THEN -99e0 ELSE ((event_id * 7) % 120) / 10e0 END",
    "rn_day": "CASE WHEN event_id % 45 = 0 THEN -99e0 ELSE ((event_id * 3) % 500) / 10e0 END",
    "rn_hr1": """CASE WHEN event_id % 47 = 0 THEN -99e0 WHEN event_id % 11 = 0 THEN (event_id % 400) / 10e0
        ELSE 0e0 END""",
    "hm": "CASE WHEN event_id % 29 = 0 THEN -99e0 ELSE ((event_id * 37) % 98) + 2.5e0 END",
    "si": "CASE WHEN event_id % 2 = 0 THEN -99e0 ELSE ((event_id * 13) % 393) / 100e0 END",
    "ta_chi": "value / 2e0 - 20e0 - ((event_id * 5) % 7) / 2e0",
    "heat_demand": "CASE WHEN event_id % 1000 = 7 THEN -99e0 ELSE value + 0e0 END",
}
HOURLY_STEP, SEASON_STEP = 1, 17


def events_panel(spark: SparkSession, sf_dir: str, step_hours: int = HOURLY_STEP) -> DataFrame:
    """19 sites with one row every ``step_hours``, missing readings coded -99 / -9.9."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value")
    tm = (
        "timestamp'2021-01-01 00:00:00' + "
        f"make_dt_interval(0, CAST(floor(event_id / 19e0) AS INT) * {step_hours})"
    )
    cols = dict(PANEL_COLUMNS)
    names = ["id", "branch_id", "tm", *NUMERIC]
    cols["tm"] = tm
    return events.select(*[F.expr(cols[n]).alias(n) for n in names])


def obs_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_panel(spark, sf_dir, HOURLY_STEP)


def obs_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_panel(spark, sf_dir, SEASON_STEP)


def panel_sql(step_hours: int = HOURLY_STEP) -> str:
    """The same panel as SQL text for the check engine."""
    tm = f"TIMESTAMP '2021-01-01 00:00:00' + to_hours(CAST(floor(event_id / 19e0) AS BIGINT) * {step_hours})"
    cols = {**PANEL_COLUMNS, "tm": tm}
    names = ["id", "branch_id", "tm", *NUMERIC]
    return "SELECT " + ", ".join(f"{cols[n]} AS {n}" for n in names) + " FROM events"


def daily_orders(spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean order value per day (and per status or priority, if asked)."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.groupBy(*keys, F.to_date("o_orderdate").alias("date")).agg(F.avg("o_totalprice").alias("value"))
