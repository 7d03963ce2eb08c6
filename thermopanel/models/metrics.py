"""Scores of predictions, best models and ensembles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermopanel.operators.aggregates import histogram


def metric_columns(y: str | Column = "y", prediction: str | Column = "prediction") -> list[Column]:
    y = F.col(y) if isinstance(y, str) else y
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    error = y - prediction
    mse = F.avg(error * error)
    share = F.abs(F.try_divide(error, y))
    return [
        F.avg(F.abs(error)).alias("MAE"),
        mse.alias("MSE"),
        F.sqrt(mse).alias("RMSE"),
        (1 - F.try_divide(mse, F.var_pop(y))).alias("R2"),
        (1 - F.try_divide(F.var_pop(error), F.var_pop(y))).alias("EVS"),
        F.when(F.min(y) > 0, F.avg(share)).alias("MAPE"),
    ]


def regression_metrics(df: DataFrame, keys: Sequence[str] = (), y: str = "y", prediction: str = "prediction"):
    """MAE, MSE, RMSE, R2, explained variance, and MAPE where every target is positive."""
    return df.groupBy(*keys).agg(*metric_columns(y, prediction))


def best_models(metrics: DataFrame, group: str = "cluster_key") -> DataFrame:
    """The model with the smallest RMSE per group."""
    best = F.min_by("model", F.struct("RMSE", "model"))
    return metrics.filter(F.col("RMSE").isNotNull()).groupBy(group).agg(best.alias("model"))


def pooled_best_metrics(predictions: DataFrame, group: str = "cluster_key") -> DataFrame:
    """Scores over the validation rows of each group's best model together.

    One pass reduces every (group, model) to its size, means and spreads; the best
    ones are then pooled from those, without going back to the predictions.
    """
    y, error = F.col("y"), F.col("y") - F.col("prediction")
    parts = predictions.groupBy(group, "model").agg(
        F.count(error).alias("n"), F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"),
        F.avg(y).alias("my"), F.var_pop(y).alias("vy"), F.avg(error).alias("me"), F.var_pop(error).alias("ve"),
        F.min(y).alias("low"), F.avg(F.abs(F.try_divide(error, y))).alias("share"),
    )
    columns = [c for c in parts.columns if c not in (group, "model")]
    chosen = parts.groupBy(group).agg(F.min_by(F.struct(*columns), F.struct("mse", "model")).alias("p")).select("p.*")
    whole = F.sum("n")

    def pooled(c: str) -> Column:
        return F.sum(F.col("n") * F.col(c)) / whole

    def pooled_variance(mean: str, variance: str) -> Column:
        return pooled(variance) + F.sum(F.col("n") * F.col(mean) * F.col(mean)) / whole - pooled(mean) * pooled(mean)

    return chosen.agg(
        pooled("mae").alias("MAE"),
        pooled("mse").alias("MSE"),
        F.sqrt(pooled("mse")).alias("RMSE"),
        (1 - F.try_divide(pooled("mse"), pooled_variance("my", "vy"))).alias("R2"),
        (1 - F.try_divide(pooled_variance("me", "ve"), pooled_variance("my", "vy"))).alias("EVS"),
        F.when(F.min("low") > 0, pooled("share")).alias("MAPE"),
    )


def overall_best(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("RMSE", "cluster_key", "model").limit(1)


def ensemble_mean(
    predictions: DataFrame, keys: Sequence[str] = ("cluster_key", "branch_id", "tm"), prediction: str = "prediction"
) -> DataFrame:
    """Average of the models' predictions per row key."""
    return predictions.groupBy(*keys).agg(
        F.avg(prediction).alias(prediction), F.count(F.lit(1)).alias("models")
    )


def residuals(df: DataFrame, y: str = "y", prediction: str = "prediction") -> DataFrame:
    return df.withColumn("residual", F.col(y) - F.col(prediction))


def residual_histogram(df: DataFrame, bins: int = 50, y: str = "y", prediction: str = "prediction") -> DataFrame:
    return histogram(residuals(df, y, prediction), "residual", bins)


def fold_scores(df: DataFrame, y_log: str = "y", prediction_log: str = "prediction") -> DataFrame:
    """RMSE per fold after undoing log1p, and their mean in every row."""
    error = F.expm1(y_log) - F.expm1(prediction_log)
    return df.groupBy("fold").agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def mean_fold_score(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("rmse").alias("mean_rmse"), F.count(F.lit(1)).alias("folds"))
