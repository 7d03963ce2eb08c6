"""Queries that write files and read them back."""

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import functions as F

from thermopanel.catalog import HOURLY, SEASON, frames, query
from thermopanel.catalog.cleaning import KEYED
from thermopanel.catalog.modelling import LEARNT, SCORE_SQL, SCORES, SMALL, WITH_PREDICTED, group_rows, predicted
from thermopanel.models import encode, metrics, train
from thermopanel.operators import joins, ordering
from thermopanel.session import scratch_path
from thermopanel.sources import files
from thermopanel.sources.panels import NUMERIC

STAMP = "strftime(tm, '%Y-%m-%d %H:%M:%S') AS tm"


@query("panel_csv_round_trip_io1", f"{HOURLY} SELECT branch_id, {STAMP}, {', '.join(NUMERIC)} FROM obs", NUMERIC)
def _(spark, d):
    path, prefix = scratch_path(spark, "panel"), "train_heat."
    raw = frames.raw(spark, d)
    out = raw.select(frames.stamp().alias("tm"), "branch_id", *NUMERIC)
    out = out.toDF(*[f"{prefix}{c}" for c in out.columns])
    indexed = out.select(F.monotonically_increasing_id().alias(files.INDEX_COLUMN), *[F.col(f"`{c}`") for c in out.columns])
    files.write_panel_csv(indexed, path)
    return files.read_panel_csv(spark, path, prefix=prefix)


@query(
    "panel_parquet_scan_io2",
    f"{HOURLY} SELECT branch_id, count(*) AS rows, avg(ta_chi) AS ta_chi FROM obs GROUP BY 1", "ta_chi",
)
def _(spark, d):
    return frames.raw(spark, d).groupBy("branch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("ta_chi").alias("ta_chi")
    )


@query("strip_prefix_io3", f"{HOURLY} SELECT id, ta, heat_demand FROM obs", "ta heat_demand")
def _(spark, d):
    raw = frames.raw(spark, d).select("id", "ta", "heat_demand")
    return files.strip_prefix(raw.toDF(*[f"train_heat.{c}" for c in raw.columns]), "train_heat.")


@query(
    "write_predictions_io4",
    f"{WITH_PREDICTED} SELECT cluster_key, model, count(*) AS rows, avg(prediction) AS mean FROM predicted GROUP BY 1, 2", "mean",
)
def _(spark, d):
    path = scratch_path(spark, "predictions")
    files.write_predictions(predicted(spark, d), path)
    back = spark.read.parquet(path)
    return back.groupBy("cluster_key", "model").agg(F.count(F.lit(1)).alias("rows"), F.avg("prediction").alias("mean"))


@query("write_metrics_io5", f"{WITH_PREDICTED} SELECT cluster_key, model, {SCORE_SQL} FROM predicted GROUP BY 1, 2", SCORES)
def _(spark, d):
    path = scratch_path(spark, "metrics")
    scores = metrics.regression_metrics(predicted(spark, d), ["cluster_key", "model"])
    files.write_metrics(scores, path)
    return spark.read.schema(scores.schema).json(f"{path}/json")


@query("read_metrics_back_io5", f"{WITH_PREDICTED} SELECT cluster_key, model, {SCORE_SQL} FROM predicted GROUP BY 1, 2", SCORES)
def _(spark, d):
    path = scratch_path(spark, "metrics")
    files.write_metrics(metrics.regression_metrics(predicted(spark, d), ["cluster_key", "model"]), path)
    return files.read_metrics(spark, path)


@query(
    "write_submission_io6",
    f"{HOURLY} SELECT o.id, p.heat_demand FROM obs o LEFT JOIN (SELECT id, heat_demand * 2 AS heat_demand FROM ready) p "
    "ON o.id = p.id", "heat_demand",
)
def _(spark, d):
    path = scratch_path(spark, "submission")
    scored = frames.ready(spark, d).select("id", (F.col("heat_demand") * 2).alias("heat_demand"))
    filled = joins.fill_submission(frames.raw(spark, d).select("id"), scored)
    files.write_submission(filled, path)
    return spark.read.schema("id long, heat_demand double").csv(path, header=True)


@query("save_and_load_encoder_io7", "SELECT p_partkey, p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand_code FROM part")
def _(spark, d):
    path = scratch_path(spark, "model")
    part = frames.table(spark, d, "part").select("p_partkey", "p_brand")
    files.save_model(encode.label_encoder(part, ["p_brand"]), path)
    return encode.label_encode(StringIndexerModel.load(path), part)


@query(
    "save_and_load_model_io7",
    f"""{SEASON}, {KEYED}, {LEARNT} SELECT cluster_key, count(*) AS rows, 0e0 AS largest_gap, TRUE AS same_columns
    FROM keyed JOIN learnt USING (cluster_key) GROUP BY 1""", "largest_gap",
)
def _(spark, d):
    """Regressors of all groups predict the same after they were saved and loaded."""
    parts, tables = group_rows(spark, d), []
    for key, model in train.fit_groups(parts, params=SMALL, early_stop=True).items():
        path = scratch_path(spark, f"model-{key}")
        model.save(path)
        loaded = train.GroupModel.load(spark, path)
        both = loaded.predict(model.predict(parts[key].drop("is_valid")).withColumnRenamed("prediction", "before"))
        tables.append(both.agg(
            F.lit(key).alias("cluster_key"), F.count("prediction").alias("rows"),
            F.max(F.abs(F.col("prediction") - F.col("before"))).alias("largest_gap"),
            F.lit(loaded.numeric == model.numeric and loaded.errors == model.errors and loaded.rounds == model.rounds).alias("same_columns"),
        ))
    return ordering.union_all(tables)
