"""Early stopping, cut and loaded models, the search and its hand-over to training."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermopanel.models import train


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    data = [(i, float(x), "ab"[i % 2], float(np.log1p(10 + 3 * x + rng.normal())), i % 3 == 0) for i, x in enumerate(rng.uniform(0, 3, 400))]
    return spark.createDataFrame(data, "id long, x double, side string, heat_demand_log double, is_valid boolean")


def test_best_round_needs_patience():
    assert train.best_round([5, 4, 3, 4, 5, 1], patience=2) == 3
    assert train.best_round([5, 4, 3, 4, 5, 1], patience=3) == 6
    assert train.best_round([1.0]) == 1 and train.best_round([3, 2, 1]) == 3


def test_a_cut_model_is_its_first_rounds(rows):
    prepared = train.prepare(rows.drop("is_valid"))
    whole = train.fit_prepared(prepared, {"maxIter": 6, "maxDepth": 3})
    cut = train.cut_rounds(whole.model, 2)
    short = train.fit_prepared(prepared, {"maxIter": 2, "maxDepth": 3}).model
    assert cut.getNumTrees == 2 and train.cut_rounds(whole.model, 6) is whole.model
    both = short.transform(cut.transform(prepared.train).withColumnRenamed("prediction", "cut"))
    assert both.filter(F.abs(F.col("cut") - F.col("prediction")) > 1e-12).count() == 0
    errors = whole.model.evaluateEachIteration(prepared.train, "squared")
    assert cut.evaluateEachIteration(prepared.train, "squared") == pytest.approx(errors[:2])


def test_early_stopping_keeps_the_best_round_and_survives_saving(spark, rows, tmp_path):
    model = train.fit_group(rows, params={"maxIter": 20, "maxDepth": 6, "stepSize": 0.5}, early_stop=True, patience=4)
    assert len(model.errors) == 20 and model.rounds == train.best_round(model.errors, 4) < 20
    model.save(str(tmp_path / "m"))
    loaded = train.GroupModel.load(spark, str(tmp_path / "m"))
    assert (loaded.numeric, loaded.errors, loaded.rounds) == (model.numeric, model.errors, model.rounds)
    data = rows.drop("is_valid")
    a, b = ({r["id"]: r["prediction"] for r in m.predict(data).collect()} for m in (model, loaded))
    assert a == b and len(a) == 400
    assert [r["feature"] for r in loaded.importance(data, 1).collect()] == ["x"]


def test_search_abandons_and_hands_over(rows):
    folded = rows.drop("is_valid").withColumn("fold", F.when(F.col("id") < 100, -1).otherwise(F.floor((F.col("id") - 100) / 100)).cast("int"))
    poor = {"maxIter": 1, "stepSize": 0.01, "maxDepth": 1}
    found = train.search(folded, "heat_demand_log", trials=2, ranges=train.CV_SEARCH_RANGES, limits={"maxIter": 3}, first=[poor])
    again = train.search(folded, "heat_demand_log", trials=2, ranges=train.CV_SEARCH_RANGES, limits={"maxIter": 3}, first=[poor])
    assert [t[:2] for t in found.trials] == [t[:2] for t in again.trials] and len(found.trials) == 3 and max(n for _, _, n, _ in found.trials) == 3
    assert min(n for _, _, n, _ in found.trials) < 3 and all(p["maxIter"] <= 3 for _, p, _, _ in found.trials)
    table = found.table(rows.sparkSession).collect()
    assert [r["abandoned"] for r in table].count(True) >= 1
    models = train.fit_groups({"a": rows, "none": rows.limit(0)}, params={"maxIter": 9}, tuned={"a": found.best})
    assert list(models) == ["a"] and models["a"].rounds == found.best["maxIter"]


def test_search_without_rows(rows):
    empty = train.search(rows.limit(0), "heat_demand_log", trials=1)
    assert empty.best == {} and empty.trials[0][2] == 0
