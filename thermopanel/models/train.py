"""One boosted-tree regressor per model group, search and scoring."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermopanel.models import encode
from thermopanel.session import materialise

# ---- fixed values: default boosting and search ranges ---------------------
BOOSTING = {"maxIter": 1000, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
SEED = 42
# name: (low, high, kind)
SEARCH_RANGES = {
    "maxIter": (100, 2000, "int"),
    "stepSize": (0.01, 0.3, "float"),
    "maxDepth": (3, 15, "int"),
    "minInstancesPerNode": (1, 10, "int"),
    "subsamplingRate": (0.5, 1.0, "float"),
    "featureSubsetStrategy": (0.5, 1.0, "share"),
}
CV_SEARCH_RANGES = {
    "maxIter": (100, 1000, "int"),
    "stepSize": (0.001, 0.3, "log"),
    "maxDepth": (3, 10, "int"),
    "subsamplingRate": (0.5, 1.0, "float"),
    "featureSubsetStrategy": (0.5, 1.0, "share"),
}
# ---- end of fixed values --------------------------------------------------


#: jobs submitted side by side
THREADS = 8
#: rounds without a better held-out error after which boosting counts as finished
PATIENCE = 50


def booster(params: Mapping | None = None, label: str = "label") -> GBTRegressor:
    options = {**BOOSTING, **(params or {})}
    return GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", seed=SEED, **options)


def best_round(errors: Sequence[float], patience: int = PATIENCE) -> int:
    """Rounds to keep: the best one before ``patience`` rounds in a row brought nothing better."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def cut_rounds(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model of the first ``rounds`` rounds."""
    if rounds >= model.getNumTrees:
        return model
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    regression = gateway.jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    whole, shares = java.trees(), java.treeWeights()
    for i in range(rounds):
        trees[i], weights[i] = whole[i], shares[i]
    shorter = regression.GBTRegressionModel(java.uid(), trees, weights, java.numFeatures())
    out = GBTRegressionModel(java.copyValues(shorter, java.extractParamMap()))
    out._resetUid(model.uid)
    return out


@dataclass(frozen=True)
class Prepared:
    """Feature rows of one group: boosting passes over them once per tree level, so they are written to the shared folder once
    and serve every model fitted on them."""

    features: PipelineModel
    numeric: list[str]
    train: DataFrame
    valid: DataFrame | None = None


def prepare(train: DataFrame, target: str = "heat_demand_log", valid: DataFrame | None = None) -> Prepared:
    """Encoders learnt on the training rows, and the vectors of both sets."""
    rows = train.filter(F.col(target).isNotNull())
    features, numeric = encode.fit_features(rows, target)

    def vectors(df: DataFrame) -> DataFrame:
        known = df.filter(F.col(target).isNotNull())
        return materialise(encode.to_features(features, numeric, known).select("features", F.col(target).alias("label")))

    return Prepared(features, numeric, vectors(rows), None if valid is None else vectors(valid))


class GroupModel:
    """Encoders, column list and booster of one model group; ``errors`` are held-out errors per round, where known."""

    def __init__(self, features, numeric: Sequence[str], model: GBTRegressionModel, errors: Sequence[float] = ()):
        self.features, self.numeric, self.model, self.errors = features, list(numeric), model, list(errors)

    @property
    def rounds(self) -> int:
        return self.model.getNumTrees

    def predict(self, df: DataFrame) -> DataFrame:
        vectors = encode.to_features(self.features, self.numeric, df)
        return self.model.transform(vectors).select(*df.columns, "prediction")

    def predictor(self, column: str) -> GBTRegressionModel:
        """The booster with its predictions in the column."""
        return self.model.copy().setPredictionCol(column)

    def save(self, path: str) -> None:
        self.features.write().overwrite().save(f"{path}/features")
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.builder.getOrCreate()
        about = [(self.numeric, [float(e) for e in self.errors])]
        spark.createDataFrame(about, "numeric array<string>, errors array<double>").write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GroupModel:
        """What :meth:`save` wrote; predicts as the saved model does."""
        about = spark.read.parquet(f"{path}/about").first()
        features, model = PipelineModel.load(f"{path}/features"), GBTRegressionModel.load(f"{path}/model")
        return cls(features, about["numeric"], model, about["errors"])

    def importance(self, df: DataFrame, top: int = 20) -> DataFrame:
        """Strongest features; a one-hot vector counts as one feature per label."""
        slots = self.features.transform(df.limit(0).na.fill(0.0)).schema["features"].metadata["ml_attr"]["attrs"]
        names = {a["idx"]: a["name"] for group in slots.values() for a in group}
        weights = self.model.featureImportances.toArray()
        rows = [(names.get(i, str(i)), float(w)) for i, w in enumerate(weights)]
        table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
        return table.orderBy(F.desc("importance"), "feature").limit(top)


def fit_prepared(prepared: Prepared, params: Mapping | None = None, patience: int | None = PATIENCE) -> GroupModel:
    """Fit; with held-out rows (and a patience) the model is cut to its best round."""
    model, errors = booster(params).fit(prepared.train), []
    if prepared.valid is not None and patience is not None:
        errors = model.evaluateEachIteration(prepared.valid, "squared")
        model = cut_rounds(model, best_round(errors, patience))
    return GroupModel(prepared.features, prepared.numeric, model, errors)


def fit_group(
    train: DataFrame, target: str = "heat_demand_log", params: Mapping | None = None, early_stop: bool = False,
    patience: int = PATIENCE,
) -> GroupModel:
    """Fit on the rows of one group; ``early_stop`` holds out the rows marked ``is_valid`` to find the best round."""
    if early_stop:
        fit, valid = (train.filter(c).drop("is_valid") for c in ("NOT is_valid", "is_valid"))
        return fit_prepared(prepare(fit, target, valid), params, patience)
    return fit_prepared(prepare(train.drop("is_valid"), target), params)


def side_by_side(work: Callable, items: Sequence, threads: int = THREADS) -> list:
    """Independent jobs submitted together, so that small ones do not wait for each other."""
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(work, items))


def fit_groups(
    frames: Mapping[str, DataFrame], target: str = "heat_demand_log", params: Mapping | None = None, early_stop: bool = False,
    tuned: Mapping[str, Mapping] | None = None, patience: int = PATIENCE,
) -> dict[str, GroupModel]:
    """One model per group; the frames may differ in columns, as lag lists do. ``tuned`` holds parameters found for a
    group, which go before ``params``. A group without rows to learn from has no model."""

    return fit_models(frames, {"": (params or {}, tuned or {})}, target, early_stop, patience)[""]


def fit_models(
    frames: Mapping[str, DataFrame], models: Mapping[str, tuple[Mapping, Mapping]], target: str = "heat_demand_log",
    early_stop: bool = False, patience: int = PATIENCE,
) -> dict[str, dict[str, GroupModel]]:
    """:func:`fit_groups` for several models, name -> (params, tuned); a group's features are learnt and written once for all."""

    def one(key: str) -> list[GroupModel] | None:
        learn = frames[key].filter(F.col(target).isNotNull())
        if (learn.filter("NOT is_valid") if early_stop else learn).isEmpty():
            return None
        if early_stop:
            prepared = prepare(frames[key].filter("NOT is_valid").drop("is_valid"), target,
                               frames[key].filter("is_valid").drop("is_valid"))
        else:
            prepared = prepare(frames[key].drop("is_valid"), target)
        return [fit_prepared(prepared, {**params, **(own.get(key) or {})}, patience) for params, own in models.values()]

    fitted = dict(zip(frames, side_by_side(one, list(frames))))
    return {name: {key: found[i] for key, found in fitted.items() if found is not None} for i, name in enumerate(models)}


def predict_groups(
    models: Mapping[str, GroupModel], frames: Mapping[str, DataFrame], target: str = "heat_demand_log",
    keys: Sequence[str] = ("id", "tm", "branch_id"), name: str = "GBT",
) -> DataFrame:
    """Predictions of every group on the demand scale: (cluster_key, model, keys, y, prediction)."""
    return predict_models({name: models}, frames, target, keys)


def predict_models(
    models: Mapping[str, Mapping[str, GroupModel]], frames: Mapping[str, DataFrame], target: str = "heat_demand_log",
    keys: Sequence[str] = ("id", "tm", "branch_id"),
) -> DataFrame:
    """:func:`predict_groups` of several models, name -> models of the groups. Models of a group that share their encoders
    read its rows once, and a row's feature vector is made once for all of them."""
    shared: dict[tuple, list[tuple[str, GroupModel]]] = {}
    for name, groups in models.items():
        for key, model in groups.items():
            shared.setdefault((key, id(model.features)), []).append((name, model))
    parts = []
    for (key, _), found in shared.items():
        first = found[0][1]
        rows = encode.to_features(first.features, first.numeric, frames[key]).select(*keys, target, "features")
        for i, (_, model) in enumerate(found):
            rows = model.predictor(f"__p{i}").transform(rows)
        each = F.array(*[F.struct(F.lit(name).alias("model"), F.col(f"__p{i}").alias("p")) for i, (name, _) in enumerate(found)])
        parts.append(rows.select(*keys, F.expm1(target).alias("y"), F.inline(each)).select(
            F.lit(key).alias("cluster_key"), "model", *keys, "y", F.expm1("p").alias("prediction"),
        ))
    return reduce(DataFrame.unionByName, parts)


def draw_params(ranges: Mapping, rng: random.Random) -> dict:
    out = {}
    for name, (low, high, kind) in ranges.items():
        if kind == "int":
            out[name] = rng.randint(low, high)
        elif kind == "log":
            out[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
        elif kind == "share":
            out[name] = f"{rng.uniform(low, high):.3f}"
        else:
            out[name] = rng.uniform(low, high)
    return out


@dataclass(frozen=True)
class Search:
    """All trials, the best parameters, and the mean error they reached."""

    trials: list[tuple[int, dict, int, float]]
    best: dict
    rmse: float

    def table(self, spark: SparkSession) -> DataFrame:
        """(trial, params, folds, abandoned, rmse): ``rmse`` is the mean over the folds a trial got to."""
        most = max((folds for _, _, folds, _ in self.trials), default=0)
        rows = [(t, str(sorted(p.items())), n, n < most, r) for t, p, n, r in self.trials]
        return spark.createDataFrame(rows, "trial int, params string, folds int, abandoned boolean, rmse double").orderBy("rmse", "trial")


def fold_splits(df: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Expanding time folds where there is a ``fold`` column, else the rows marked ``is_valid``."""
    staged = materialise(df)
    if "fold" in df.columns:
        k = staged.agg(F.max("fold")).first()[0] + 1
        pairs = [(staged.filter(F.col("fold") < f), staged.filter(F.col("fold") == f)) for f in range(k)]
    else:
        pairs = [(staged.filter(~F.col("is_valid")), staged.filter("is_valid"))]
    return [(a.drop("fold", "is_valid"), b.drop("fold", "is_valid")) for a, b in pairs]


def demand_error(prepared: Prepared, params: Mapping) -> float:
    """Root mean squared error on the demand scale of a model on its held-out rows."""
    error = F.expm1("label") - F.expm1("prediction")
    scored = booster(params).fit(prepared.train).transform(prepared.valid)
    return scored.agg(F.sqrt(F.avg(error * error)).alias("rmse")).first()[0]


def search(
    df: DataFrame, target: str, trials: int = 20, ranges: Mapping = SEARCH_RANGES, seed: int = SEED,
    limits: Mapping | None = None, first: Sequence[Mapping] = (), keep: float = 0.5,
) -> Search:
    """Random draws scored by validation RMSE on the demand scale.

    Features are learnt and written once per fold; the trials of a fold run side by side. After each fold only the ``keep``
    share of trials with the best mean so far goes on, so poor parameters cost one fold. ``first`` are parameters tried
    before the draws, ``limits`` upper bounds on numbers (a budget of rounds, say). The seed fixes the draws.
    """
    rng = random.Random(seed)
    drawn = [dict(p) for p in first] + [draw_params(ranges, rng) for _ in range(trials)]
    drawn = [{**p, **{c: min(p[c], most) for c, most in (limits or {}).items() if c in p}} for p in drawn]
    scores: list[list[float]] = [[] for _ in drawn]
    mean = lambda t: sum(scores[t]) / len(scores[t])
    alive = list(range(len(drawn)))
    splits = [(a, b) for a, b in fold_splits(df) if not a.isEmpty() and not b.isEmpty()]
    for fold, prepared in enumerate(prepare(fit, target, valid) for fit, valid in splits):
        for trial, score in zip(alive, side_by_side(lambda t, data=prepared: demand_error(data, drawn[t]), alive)):
            scores[trial].append(score)
        if fold < len(splits) - 1:
            alive = sorted(alive, key=lambda t: (mean(t), t))[:max(1, math.ceil(keep * len(alive)))]
    done = [(t, drawn[t], len(scores[t]), mean(t) if scores[t] else None) for t in range(len(drawn))]
    winner = min((t for t in alive if scores[t]), key=lambda t: (mean(t), t), default=None)
    return Search(done, {} if winner is None else drawn[winner], math.nan if winner is None else mean(winner))


def random_search(df: DataFrame, target: str, trials: int = 20, **options) -> DataFrame:
    """The trials of :func:`search` as a table."""
    return search(df, target, trials, **options).table(df.sparkSession)


def tune_groups(frames: Mapping[str, DataFrame], target: str = "heat_demand_log", **options) -> dict[str, Search]:
    """A search per group; its best parameters are meant for :func:`fit_groups`."""
    return {key: search(df, target, **options) for key, df in frames.items()}
