"""Queries on encodings, splits, training and scores, and the composed feature job."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from thermopanel import rules
from thermopanel.catalog import BREAKPOINTS_SQL, HOURLY, NIGHTS_SQL, SEASON, frames, query
from thermopanel.catalog.aggregates import histogram_sql
from thermopanel.catalog.cleaning import KEYED, keyed_season
from thermopanel.catalog.features import ALPHA, SECTOR4
from thermopanel.catalog.series import heads_sql, padded_value
from thermopanel.functions.weather import wind_sector4
from thermopanel.models import encode, metrics, splits, train
from thermopanel.operators import ordering
from thermopanel.plans import features
from thermopanel.session import materialise

# ---- encodings ------------------------------------------------------------
SEEN = "p_brand NOT LIKE '%3'"


@query(
    "label_codes_ml1",
    f"""WITH codes AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INT) AS code
    FROM (SELECT DISTINCT p_brand FROM part WHERE {SEEN}))
    SELECT p_partkey, part.p_brand, coalesce(code, -1) AS p_brand_code FROM part LEFT JOIN codes ON part.p_brand = codes.p_brand""",
)
def _(spark, d):
    part = frames.table(spark, d, "part").select("p_partkey", "p_brand")
    return encode.label_encode(encode.label_encoder(part.filter(SEEN), ["p_brand"]), part)


@query(
    "one_hot_codes_ml2",
    f"""WITH codes AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS pos FROM (SELECT DISTINCT p_brand FROM part
    WHERE {SEEN})) SELECT p_partkey, coalesce(pos, 0) AS hot, CASE WHEN pos IS NULL THEN 0e0 ELSE 1e0 END AS total,
    (SELECT count(*) FROM codes) AS slots FROM part LEFT JOIN codes ON part.p_brand = codes.p_brand""",
    "total",
)
def _(spark, d):
    part = frames.table(spark, d, "part").select("p_partkey", "p_brand")
    coded = encode.one_hot_encoder(part.filter(SEEN), ["p_brand"]).transform(part)
    slots = vector_to_array("p_brand_onehot")
    return coded.select(
        "p_partkey", F.array_position(slots, 1.0).alias("hot"),
        F.aggregate(slots, F.lit(0.0), lambda a, x: a + x).alias("total"), F.size(slots).alias("slots"),
    )


@query(
    "feature_vectors_ml3",
    f"{HOURLY} SELECT id, coalesce(ta, -99) AS f0, coalesce(ws, -99) AS f1, "
    "CASE WHEN wd >= 45 AND wd < 135 THEN 1e0 ELSE 0e0 END AS f2, CASE WHEN wd IS NOT NULL AND (wd < 45 OR wd >= 315) "
    "THEN 1e0 ELSE 0e0 END AS f3 FROM ready",
    "f0 f1 f2 f3",
)
def _(spark, d):
    rows = frames.ready(spark, d).select("id", "ta", "ws", wind_sector4().alias("wd_group"), "heat_demand")
    rows = rows.withColumn("heat_demand_log", F.log1p("heat_demand"))
    model, numeric = encode.fit_features(rows)
    vectors = vector_to_array(F.col("features"))
    return encode.to_features(model, numeric, rows).select("id", *[vectors[i].alias(f"f{i}") for i in range(4)])


# ---- splits ---------------------------------------------------------------
@query(
    "hash_holdout_ml4",
    f"{HOURLY} SELECT id, CAST(('0x' || substr(md5('42|' || CAST(id AS VARCHAR)), 1, 8))::BIGINT % 10000 < 2000 AS INT) "
    "AS is_valid FROM ready",
)
def _(spark, d):
    return splits.hash_holdout(frames.ready(spark, d)).select("id", F.col("is_valid").cast("int").alias("is_valid"))


@query(
    "time_holdout_ml5",
    f"{SEASON} SELECT id, CAST(tm >= TIMESTAMP '2021-07-01 01:00:00' AND tm <= TIMESTAMP '2021-12-31 23:00:00' AS INT) "
    "AS is_valid FROM ready",
)
def _(spark, d):
    marked = splits.time_holdout(frames.ready_season(spark, d), "2021-07-01 01:00:00", "2021-12-31 23:00:00")
    return marked.select("id", F.col("is_valid").cast("int").alias("is_valid"))


FOLDS = """placed AS (SELECT id, row_number() OVER (ORDER BY tm, branch_id) - 1 AS i, count(*) OVER () AS n FROM ready),
    sized AS (SELECT *, n // 4 AS t FROM placed),
    folds AS (SELECT id, CASE WHEN i >= n - t THEN 2 WHEN i >= n - 2 * t THEN 1 WHEN i >= n - 3 * t THEN 0 ELSE -1 END
      AS fold FROM sized)"""


@query("expanding_folds_ml6", f"{HOURLY}, {FOLDS} SELECT id, fold FROM folds")
def _(spark, d):
    return splits.expanding_folds(frames.ready(spark, d)).select("id", "fold")


@query(
    "model_groups_ml9",
    f"{SEASON}, {KEYED} SELECT cluster_key, count(*) AS rows, avg(heat_demand) AS demand FROM keyed GROUP BY 1", "demand",
)
def _(spark, d):
    return keyed_season(spark, d).groupBy("cluster_key").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("heat_demand").alias("demand")
    )


# ---- training ---------------------------------------------------------------
# Predictions differ between engines; the twins hold what does not: which rows of which group are predicted, and what must
# be true of any right model.
ROUNDS = 6
SMALL = {"maxIter": ROUNDS, "maxDepth": 3, "stepSize": 0.3}
SMALL_FEATURES = ["id", "tm", "branch_id", "cluster_key", "ta_chi", "ws", "hm", "hour", "month", "wd_group", "heat_demand"]
VALID_SQL = "('0x' || substr(md5('42|' || CAST(id AS VARCHAR)), 1, 8))::BIGINT % 10000 < 2000"
#: groups that have rows to learn from
LEARNT = f"learnt AS (SELECT cluster_key FROM keyed GROUP BY 1 HAVING count(*) FILTER (NOT ({VALID_SQL})) > 0)"


def model_rows(spark, d):
    rows = keyed_season(spark, d)
    rows = rows.withColumns({"hour": F.hour("tm"), "month": F.month("tm"), "wd_group": wind_sector4()})
    rows = rows.select(*SMALL_FEATURES, F.log1p("heat_demand").alias("heat_demand_log"))
    return splits.hash_holdout(rows)


def group_rows(spark, d):
    """The rows of all groups, written once for all models."""
    rows = materialise(model_rows(spark, d))
    return {k: rows.filter(F.col("cluster_key") == k) for k in rules.CLUSTER_KEYS}


def held_predictions(spark, d, **options):
    parts = group_rows(spark, d)
    models = train.fit_groups(parts, early_stop=True, **options)
    valid = {k: p.filter("is_valid").drop("is_valid") for k, p in parts.items()}
    return models, train.predict_groups(models, valid)


@query(
    "boosted_trees_by_group_ml7",
    f"""{SEASON}, {KEYED}, {LEARNT} SELECT cluster_key, count(*) AS predicted, TRUE AS beats_a_constant
    FROM keyed JOIN learnt USING (cluster_key) WHERE {VALID_SQL} GROUP BY 1""",
)
def _(spark, d):
    _, scored = held_predictions(spark, d, params=SMALL)
    # a constant far from the mean, so that any learning at all beats it
    error, zero = F.col("y") - F.col("prediction"), F.col("y")
    return scored.groupBy("cluster_key").agg(
        F.count("prediction").alias("predicted"), (F.avg(error * error) < F.avg(zero * zero)).alias("beats_a_constant"))


@query(
    "early_stopping_ml7",
    f"""{SEASON}, {KEYED}, {LEARNT} SELECT cluster_key, 25 AS rounds_tried, TRUE AS cut, TRUE AS at_the_least_error
    FROM learnt WHERE cluster_key IN (SELECT cluster_key FROM keyed WHERE {VALID_SQL})""",
)
def _(spark, d):
    """Every group overfits within 25 large steps, so every model is cut before its last round."""
    models, _ = held_predictions(spark, d, params={"maxIter": 25, "maxDepth": 5, "stepSize": 0.5}, patience=5)
    rows = [
        (k, len(m.errors), m.rounds < len(m.errors), m.errors[m.rounds - 1] <= min(m.errors[:m.rounds + 5])) for k, m in models.items()
    ]
    return spark.createDataFrame(rows, "cluster_key string, rounds_tried int, cut boolean, at_the_least_error boolean")


@query(
    "random_search_ml8",
    f"""{SEASON}, {KEYED}, sized AS (SELECT cluster_key, count(*) AS n FROM keyed GROUP BY 1)
    SELECT cluster_key, 4 AS trials, 2 AS finished, TRUE AS no_worse_than_default FROM sized WHERE n >= 3""",
)
def _(spark, d):
    """All ranges for all groups, within a budget of rounds; half of the trials end after the first of two folds."""
    default = {"maxIter": ROUNDS}
    folded = {
        k: splits.expanding_folds(p.drop("is_valid"), 2) for k, p in group_rows(spark, d).items() if not p.isEmpty()
    }
    found = train.tune_groups(folded, trials=3, ranges=train.CV_SEARCH_RANGES, limits={"maxIter": ROUNDS}, first=[default])
    rows = []
    for key, search in found.items():
        folds = max(n for _, _, n, _ in search.trials)
        finished = [rmse for _, _, n, rmse in search.trials if n == folds]
        first = search.trials[0]
        no_worse = search.rmse <= first[3] if first[2] == folds else search.rmse <= min(finished)
        rows.append((key, len(search.trials), len(finished), no_worse))
    return spark.createDataFrame(rows, "cluster_key string, trials int, finished int, no_worse_than_default boolean")


@query(
    "predictions_on_demand_scale_ml10",
    f"""{SEASON}, {KEYED}, {LEARNT} SELECT id, cluster_key, round(heat_demand, 6) AS y, TRUE AS above_minus_one
    FROM keyed JOIN learnt USING (cluster_key) WHERE {VALID_SQL}""", "y",
)
def _(spark, d):
    """expm1 of a log1p prediction lies above -1 and gives the reading back from its own logarithm."""
    _, scored = held_predictions(spark, d, params=SMALL)
    return scored.select("id", "cluster_key", "y", (F.col("prediction") > -1).alias("above_minus_one"))


@query(
    "feature_importance_ml15",
    f"""{SEASON}, {KEYED}, {LEARNT} SELECT cluster_key, least(20, 5 + count(DISTINCT branch_id) + count(DISTINCT
    {SECTOR4.format('Unknown')})) AS features, 1e0 AS total FROM keyed JOIN learnt USING (cluster_key) WHERE NOT ({VALID_SQL}) GROUP BY 1""", "total",
)
def _(spark, d):
    """Numbers count once, labels once each; the shares of a group add up to 1."""
    parts = {k: p.filter("NOT is_valid").drop("is_valid") for k, p in group_rows(spark, d).items()}
    tables = [
        model.importance(parts[k]).select(F.lit(k).alias("cluster_key"), "importance")
        for k, model in train.fit_groups(parts, params=SMALL).items()
    ]
    return ordering.union_all(tables).groupBy("cluster_key").agg(
        F.count("importance").alias("features"), F.sum("importance").alias("total"))


# ---- scores ---------------------------------------------------------------
PREDICTED = """predicted AS (SELECT l_orderkey, l_linenumber, l_returnflag AS cluster_key, 'flat' AS model,
      l_extendedprice / 1000 AS y, l_quantity * 1.5e0 AS prediction FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag, 'offset', l_extendedprice / 1000,
      l_quantity * 1.45e0 + l_discount * 20 FROM lineitem)"""
SCORES = "MAE MSE RMSE R2 EVS MAPE"
SCORE_SQL = """avg(abs(y - prediction)) AS "MAE", avg((y - prediction) * (y - prediction)) AS "MSE",
    sqrt(avg((y - prediction) * (y - prediction))) AS "RMSE",
    1 - avg((y - prediction) * (y - prediction)) / var_pop(y) AS "R2",
    1 - var_pop(y - prediction) / var_pop(y) AS "EVS",
    CASE WHEN min(y) > 0 THEN avg(abs((y - prediction) / y)) END AS "MAPE" """
WITH_PREDICTED = f"WITH {PREDICTED}"


def predicted(spark, d):
    line = frames.table(spark, d, "lineitem")
    key = ["l_orderkey", "l_linenumber", F.col("l_returnflag").alias("cluster_key")]
    y = (F.col("l_extendedprice") / 1000).alias("y")
    flat = (F.col("l_quantity") * 1.5).alias("prediction")
    offset = (F.col("l_quantity") * 1.45 + F.col("l_discount") * 20).alias("prediction")
    return line.select(*key, F.lit("flat").alias("model"), y, flat).unionByName(
        line.select(*key, F.lit("offset").alias("model"), y, offset)
    )


@query("regression_metrics_ml11", f"{WITH_PREDICTED} SELECT cluster_key, model, {SCORE_SQL} FROM predicted GROUP BY 1, 2", SCORES)
def _(spark, d):
    return metrics.regression_metrics(predicted(spark, d), ["cluster_key", "model"])


@query(
    "metrics_with_zero_target_ml11",
    f"WITH predicted AS (SELECT l_linenumber, l_discount AS y, l_tax AS prediction FROM lineitem) "
    f"SELECT l_linenumber, {SCORE_SQL.replace('/ y)', '/ nullif(y, 0))')} FROM predicted GROUP BY 1", SCORES,
)
def _(spark, d):
    rows = frames.table(spark, d, "lineitem").select(
        "l_linenumber", F.col("l_discount").alias("y"), F.col("l_tax").alias("prediction")
    )
    return metrics.regression_metrics(rows, ["l_linenumber"])


BEST = f"""scored AS (SELECT cluster_key, model, sqrt(avg((y - prediction) * (y - prediction))) AS r FROM predicted
    GROUP BY 1, 2), best AS (SELECT cluster_key, arg_min(model, r) AS model FROM scored GROUP BY 1)"""


@query(
    "best_model_by_group_ml12", f"{WITH_PREDICTED}, {BEST} SELECT cluster_key, model FROM best",
)
def _(spark, d):
    return metrics.best_models(metrics.regression_metrics(predicted(spark, d), ["cluster_key", "model"]))


@query(
    "pooled_best_metrics_ml12",
    f"{WITH_PREDICTED}, {BEST} SELECT {SCORE_SQL} FROM predicted JOIN best USING (cluster_key, model)", SCORES,
)
def _(spark, d):
    return metrics.pooled_best_metrics(predicted(spark, d))


@query(
    "overall_best_ml13",
    f"{WITH_PREDICTED} SELECT cluster_key, model, {SCORE_SQL} FROM predicted GROUP BY 1, 2 ORDER BY \"RMSE\" LIMIT 1", SCORES,
)
def _(spark, d):
    return metrics.overall_best(metrics.regression_metrics(predicted(spark, d), ["cluster_key", "model"]))


@query(
    "ensemble_mean_ml14",
    f"{WITH_PREDICTED} SELECT l_orderkey, l_linenumber, avg(prediction) AS prediction, count(*) AS models FROM predicted "
    "GROUP BY 1, 2", "prediction",
)
def _(spark, d):
    return metrics.ensemble_mean(predicted(spark, d), ["l_orderkey", "l_linenumber"])


@query(
    "residual_histogram_ml16",
    f"{WITH_PREDICTED}, res AS (SELECT y - prediction AS residual FROM predicted WHERE model = 'flat'), "
    + histogram_sql("residual", "res", 50), "bin_start",
)
def _(spark, d):
    return metrics.residual_histogram(predicted(spark, d).filter("model = 'flat'"))


@query(
    "residuals_ml16",
    f"{WITH_PREDICTED} SELECT cluster_key, avg(y - prediction) AS mean, min(y - prediction) AS lowest, "
    "max(y - prediction) AS highest FROM predicted WHERE model = 'flat' GROUP BY 1", "mean lowest highest",
)
def _(spark, d):
    return metrics.residuals(predicted(spark, d).filter("model = 'flat'")).groupBy("cluster_key").agg(
        F.avg("residual").alias("mean"), F.min("residual").alias("lowest"), F.max("residual").alias("highest")
    )


FOLD_SCORES = f"""{HOURLY}, {FOLDS}, scored AS (SELECT fold, ln(1 + heat_demand) AS y, ln(1 + heat_demand * 0.9e0) AS p
    FROM ready JOIN folds USING (id) WHERE fold >= 0), per AS (SELECT fold,
    sqrt(avg((exp(y) - exp(p)) * (exp(y) - exp(p)))) AS rmse FROM scored GROUP BY 1)"""


def fold_scores(spark, d):
    folded = splits.expanding_folds(frames.ready(spark, d)).filter("fold >= 0")
    scored = folded.select(
        "fold", F.log1p("heat_demand").alias("y"), F.log1p(F.col("heat_demand") * 0.9).alias("prediction")
    )
    return metrics.fold_scores(scored)


@query("fold_scores_ml17", f"{FOLD_SCORES} SELECT fold, rmse FROM per", "rmse")
def _(spark, d):
    return fold_scores(spark, d)


@query("mean_fold_score_ml17", f"{FOLD_SCORES} SELECT avg(rmse) AS mean_rmse, count(*) AS folds FROM per", "mean_rmse")
def _(spark, d):
    return metrics.mean_fold_score(fold_scores(spark, d))


# ---- composed feature job ---------------------------------------------------
@query(
    "daily_demand_and_past_temperature",
    f"""{HOURLY}, rolled AS (SELECT *, CASE WHEN count(ta) OVER w = 24 THEN avg(ta) OVER w END AS ta_roll24 FROM ready
    WINDOW w AS (PARTITION BY branch_id ORDER BY tm ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
    SELECT branch_id, strftime(tm, '%Y-%m-%d') AS date, avg(heat_demand) AS demand_mean, avg(ta_roll24) AS ta_roll24_mean,
    count(*) AS hours FROM rolled GROUP BY 1, 2""",
    "demand_mean ta_roll24_mean",
)
def _(spark, d):
    return features.smoothed_daily(frames.raw(spark, d)).withColumn("date", frames.day())


KEPT = ["ta", "ws", "hm", "ta_chi", "rn_day", "rn_hr1"]
SITE = "PARTITION BY branch_id ORDER BY tm"


def fill_all(c: str) -> str:
    order = "ORDER BY branch_id, tm ROWS BETWEEN"
    return (
        f"coalesce(last_value({c} IGNORE NULLS) OVER ({order} UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({c} IGNORE NULLS) OVER ({order} CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
    )


def group_lags(key: str) -> dict[str, list[int]]:
    """The group's lag lists of the readings that its twin computes."""
    return {c: list(ns) for c, ns in rules.LAG_LISTS[key].items() if c in KEPT}


def group_names(key: str) -> list[str]:
    return [*KEPT, *[f"{c}_plag{n}" for c, ns in group_lags(key).items() for n in ns]]


FEATURE_DOUBLES = ["si", "ta_lag24", "ta_roll24", "hm_roll3", "cumulative_si", "dew_point", "heating_degree", "hour_sin", "heat_demand_log"]


def group_sql(key: str) -> str:
    """Readings, lag lists, fills over the group, rolling means, daily flags and scalar features of one group."""
    listed, filled = group_lags(key), group_names(key)
    # padding is as long as the longest of all the group's lists
    longest = max(max(ns) for ns in rules.LAG_LISTS[key].values())
    return f"""{SEASON}, {KEYED}, own AS (SELECT r.*, CASE WHEN EXISTS (SELECT 1 FROM {NIGHTS_SQL} WHERE n.site = r.branch_id
        AND month(r.tm) * 100 + day(r.tm) BETWEEN n.start_md AND n.end_md
        AND (hour(r.tm) >= n.night_start OR hour(r.tm) <= n.night_end)) THEN 0e0 ELSE si END AS si2
      FROM keyed r WHERE cluster_key = '{key}'),
    placed AS (SELECT *, row_number() OVER ({SITE}) - 1 AS i, count(*) OVER (PARTITION BY branch_id) AS len FROM own),
    {heads_sql(listed, longest, "branch_id")},
    lagged AS (SELECT *, {", ".join(f"{padded_value(c, n, longest)} AS {c}_plag{n}" for c, ns in listed.items() for n in ns)}
      FROM placed JOIN heads USING (branch_id) WINDOW w AS ({SITE})),
    filled AS (SELECT id, branch_id, tm, heat_demand, {", ".join(fill_all(c) for c in [*filled, 'si2'])} FROM lagged),
    rolled AS (SELECT *, lag(ta, 24) OVER ({SITE}) AS ta_lag24,
      CASE WHEN count(ta) OVER r24 = 24 THEN avg(ta) OVER r24 END AS ta_roll24,
      CASE WHEN count(hm) OVER r3 = 3 THEN avg(hm) OVER r3 END AS hm_roll3,
      sum(si2) OVER (PARTITION BY branch_id, CAST(tm AS DATE) ORDER BY tm ROWS UNBOUNDED PRECEDING) AS cumulative_si
      FROM filled WINDOW r24 AS ({SITE} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING),
      r3 AS ({SITE} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
    flags AS (SELECT CAST(tm AS DATE) AS date, CAST(max(ta) >= 33 AS INT) AS heatwave, CAST(min(ta) <= -12 AS INT) AS coldwave
      FROM filled GROUP BY 1)
    SELECT id, {", ".join(filled)}, si2 AS si, ta_lag24, ta_roll24, hm_roll3, cumulative_si, heatwave, coldwave,
      (237.7e0 * {ALPHA}) / (17.27e0 - {ALPHA}) AS dew_point, greatest(18 - ta, 0) AS heating_degree,
      sin(2 * pi() * hour(tm) / 24) AS hour_sin, ln(1 + heat_demand) AS heat_demand_log,
      CASE WHEN ta < x0 THEN 'low' WHEN ta < x1 THEN 'mid' ELSE 'high' END AS ta_zone
    FROM rolled JOIN flags ON flags.date = CAST(tm AS DATE) LEFT JOIN {BREAKPOINTS_SQL} ON b.site = rolled.branch_id"""


def register_group(key: str, name: str) -> None:
    doubles = [*group_names(key), *FEATURE_DOUBLES]

    @query(name, group_sql(key), doubles)
    def _(spark, d):
        frame = features.group_frame(frames.raw_season(spark, d), key, decompose=False, fill="group")
        return frame.select("id", *doubles, "heatwave", "coldwave", "ta_zone")


register_group("cluster1", "features_of_cluster1")
for _key in ("cluster0", "cluster2_summer", "cluster2_non_summer", "cluster3"):
    register_group(_key, f"filled_features_of_{_key}")


@query("features_of_cluster0")
def _(spark, d):
    return features.group_frame(frames.raw_season(spark, d), "cluster0")


@query("features_of_cluster2_summer")
def _(spark, d):
    return features.group_frame(frames.raw_season(spark, d), "cluster2_summer")


@query("features_of_all_groups", f"{SEASON}, {KEYED} SELECT cluster_key, count(*) AS rows, count(*) FILTER (month(tm) BETWEEN 6 AND 9) AS summer FROM keyed GROUP BY 1")
def _(spark, d):
    """Complete frames of all groups, decomposition included, from one pass over the panel."""
    frame = features.all_groups(frames.raw_season(spark, d))
    return frame.groupBy("cluster_key").agg(
        F.count("trend").alias("rows"), F.count_if(F.col("month").between(6, 9) & F.col("seasonal").isNotNull()).alias("summer"))
