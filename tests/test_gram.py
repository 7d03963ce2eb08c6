"""Correlations from blocks of products against pandas, in one and many tasks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from thermopanel.operators import gram, stats


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(6)
    n = 2000
    pdf = pd.DataFrame({
        "k": np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n)), "i": np.arange(n),
        "x": rng.normal(1e6, 1, n), "z": rng.exponential(1, n), "fixed": 7.1, "w": rng.integers(0, 4, n).astype(float),
    })
    pdf["y"] = pdf.x - 1e6 + rng.normal(0, 0.5, n) + (pdf.k == "a")
    pdf.loc[rng.random(n) < 0.2, "z"] = np.nan
    pdf.loc[pdf.k == "c", "w"] = np.nan
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    return pdf, spark.createDataFrame(rows, "k string, i long, x double, z double, fixed double, w double, y double").repartition(7, "i")


COLUMNS = ["x", "z", "fixed", "w", "y"]


def test_matrix_equals_pairwise_complete_correlations(table):
    pdf, df = table
    want = pdf[COLUMNS].corr()
    got = {(r["a"], r["b"]): r["corr"] for r in stats.correlation_matrix(df, COLUMNS).collect()}
    assert len(got) == 25
    for (a, b), corr in got.items():
        if "fixed" in (a, b):
            assert corr is None
        else:
            assert corr == pytest.approx(want.loc[a, b], abs=1e-9)


@pytest.mark.parametrize("held", [gram.HELD, 40])
def test_groups(table, held, monkeypatch):
    pdf, df = table
    monkeypatch.setattr(gram, "HELD", held)
    out = {(r["k"], r["feature"]): r["corr"] for r in stats.correlation_with(df, "y", ["x", "z", "w"], ["k"]).collect()}
    assert len(out) == 12 and out["c", "w"] is None
    for (k, c), corr in out.items():
        if corr is not None:
            own = pdf[pdf.k == k]
            assert corr == pytest.approx(own[c].corr(own.y), abs=1e-8)


def test_null_keys_empty_tables_and_the_plan(spark, table):
    _, df = table
    some = df.withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    assert {r["k"] for r in stats.correlation_with(some, "y", ["x"], ["k"]).collect()} == {None, "a", "b", "c"}
    assert stats.correlation_matrix(df.limit(0), COLUMNS).count() == 0
    plan = stats.correlation_matrix(df, COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan and "Expand" not in plan
    vif = {r["feature"]: r["vif"] for r in stats.variance_inflation(df, ["x", "z", "y"]).collect()}
    complete = df.select("x", "z", "y").toPandas().dropna()
    inverse = np.linalg.inv(complete.corr().to_numpy())
    assert [vif[c] for c in "xzy"] == pytest.approx(np.diag(inverse).tolist(), rel=1e-6)
