"""Queries for the composed jobs: training and lag discovery."""

from pyspark.sql import functions as F

from thermopanel.catalog import SEASON, frames, query
from thermopanel.catalog.features import ALPHA
from thermopanel.catalog.series import SHORT_LAGS, decomposition_sql, lag_sql, names, rolling_sql
from thermopanel.operators import lags
from thermopanel.plans import experiment, lag_discovery
from thermopanel.sources.panels import WEATHER

SHORT = names(SHORT_LAGS, "{c}_lag_{n}")
MEANS = [f"{c}_ma" for c in lags.AVERAGE_COLUMNS]
DAILY = ["trend", "seasonal", "resid"]


@query(
    "training_feature_set",
    f"""{SEASON}, daily AS (SELECT CAST(tm AS DATE) AS date, avg(ta) AS v FROM ready GROUP BY 1),
    {decomposition_sql('daily', '', 'date', 'v', 30)},
    flags AS (SELECT CAST(tm AS DATE) AS date, CAST(coalesce(min(ta) <= -12, false) AS INT) AS cold_wave,
      CAST(coalesce(min(ta) FILTER (hour(tm) >= 18 OR hour(tm) <= 6) >= 25, false) AS INT) AS tropical_night
      FROM ready GROUP BY 1),
    rolled AS (SELECT *, {lag_sql(SHORT_LAGS, '{c}_lag_{n}')}, {", ".join(
        rolling_sql(c, -2, 0, f"{c}_ma") for c in lags.AVERAGE_COLUMNS
    )} FROM ready WINDOW w AS (PARTITION BY branch_id ORDER BY tm))
    SELECT id, {", ".join(SHORT + MEANS)}, trend, seasonal, resid, cold_wave, tropical_night, day(tm) % 7 AS day_mod7,
      (237.7e0 * {ALPHA}) / (17.27e0 - {ALPHA}) AS dew_point
    FROM rolled LEFT JOIN parts ON parts.date = CAST(tm AS DATE) LEFT JOIN flags ON flags.date = CAST(tm AS DATE)""",
    [*SHORT, *MEANS, *DAILY, "dew_point"],
)
def _(spark, d):
    rows = experiment.hourly_features(frames.raw_season(spark, d))
    return rows.select("id", *SHORT, *MEANS, *DAILY, "cold_wave", "tropical_night", "day_mod7", "dew_point")


def small_run(spark, d):
    """All groups and two models; the last quarter of the year is the test set."""
    raw = frames.raw_season(spark, d)
    options = experiment.Options(models={"shallow": {"maxIter": 2, "maxDepth": 2}, "deep": {"maxIter": 2, "maxDepth": 3}})
    early = raw.filter(F.col("tm") < "2021-10-01")
    late = raw.filter(F.col("tm") >= "2021-10-01")
    return experiment.run(early, late, late.select("id", "heat_demand"), options)


@query(
    "training_run_global_metrics",
    f"{SEASON} SELECT count(*) > 0 AS scored, TRUE AS ordered FROM ready WHERE tm < TIMESTAMP '2021-10-01 00:00:00'",
)
def _(spark, d):
    """Metrics of the best models together: errors are ordered as any errors are."""
    ordered = (F.col("MAE") <= F.col("RMSE")) & (F.abs(F.col("RMSE") * F.col("RMSE") - F.col("MSE")) < 1e-6 * F.col("MSE"))
    return small_run(spark, d)["global_metrics"].select(F.col("RMSE").isNotNull().alias("scored"), ordered.alias("ordered"))


@query(
    "training_run_submission",
    f"{SEASON} SELECT o.id, r.id IS NOT NULL AS filled FROM obs o LEFT JOIN ready r USING (id) WHERE o.tm >= TIMESTAMP '2021-10-01 00:00:00'",
)
def _(spark, d):
    """Every id with a reading is filled, whichever group its site is in."""
    return small_run(spark, d)["submission"].select("id", F.col("heat_demand").isNotNull().alias("filled"))


VARIABLES = [c for c in WEATHER if c != "ta"]


@query("residual_lag_discovery")
def _(spark, d):
    return lag_discovery.residual_lags(frames.clean_season(spark, d), "heat_demand", list(WEATHER))


@query("common_lagged_features")
def _(spark, d):
    rows = frames.clean(spark, d).select("branch_id", "tm", "heat_demand", "ta", *VARIABLES)
    return lag_discovery.common_features(rows, "heat_demand", ["ta", *VARIABLES])
