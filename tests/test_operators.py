"""Edge cases of single operators, against pandas, numpy or hand-made rows."""

import math
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from thermopanel import rules
from thermopanel.models import encode, metrics, splits, train
from thermopanel.operators import aggregates, cleaning, clustering, crosscorr, decompose, quantiles, stats, stl
from thermopanel.operators.series import Series


# ---- rule tables -----------------------------------------------------------
def test_rule_tables():
    assert len(rules.NIGHT_RULES) == 19 * 9
    assert sorted(rules.SITES) == rules.SITES == sorted(rules.TA_BREAKPOINTS)
    assert {k: max(max(v) for v in rules.LAG_LISTS[k].values()) for k in rules.CLUSTER_KEYS} == {
        "cluster0": 30, "cluster1": 5, "cluster2_summer": 24, "cluster2_non_summer": 24, "cluster3": 28
    }


def test_boundary_day_belongs_to_both_night_periods(spark):
    # 13 April ends a period with nights until 6 and begins one with nights until 5
    hours = [4, 5, 6, 7, 20, 21]
    rows = [("A", datetime(2021, 4, 13, h), 1.0) for h in hours]
    df = spark.createDataFrame(rows, "branch_id string, tm timestamp, si double")
    got = [r["si"] for r in cleaning.night_hours_dark(df).orderBy("tm").collect()]
    assert got == [0.0, 0.0, 0.0, 1.0, 1.0, 0.0]


def test_clip_keeps_null_and_wraps_negative_direction(spark):
    df = spark.createDataFrame([(-90.0, -1.0), (None, None), (725.0, 2.0)], "wd double, ws double")
    assert [tuple(r) for r in cleaning.clip_ranges(df).collect()] == [(270.0, 0.0), (None, None), (5.0, 2.0)]


# ---- quantiles --------------------------------------------------------------
@pytest.mark.parametrize("cells, few", [(8, 16), (64, 8), (quantiles.CELLS, quantiles.FEW)])
def test_exact_quantiles_with_ties_and_skew(spark, cells, few):
    rng = np.random.default_rng(3)
    big = np.round(rng.lognormal(0, 2, 5000), 1)
    pdf = pd.DataFrame({"k": ["hot"] * 5000 + ["one"] + ["two"] * 2, "v": [*big, 7.0, 1.0, 2.0]})
    df = spark.createDataFrame(pdf)
    q = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = quantiles.exact_quantiles(df, ["k"], "v", q, cells, few).toPandas().set_index("k")
    for key, group in pdf.groupby("k"):
        np.testing.assert_allclose(got.loc[key].to_numpy(), group["v"].quantile(list(q.values())).to_numpy(), rtol=1e-12)
    whole = quantiles.exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"]
    assert whole == pytest.approx(pdf["v"].median())


def test_quantiles_over_many_magnitudes(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate([10.0 ** rng.uniform(-300, 300, 400), -(10.0 ** rng.uniform(-300, 300, 300)), [0.0, -0.0, 1e308, -1e308, 5e-324]])
    q = {f"q{i}": i / 20 for i in range(21)}
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = quantiles.exact_quantiles(df, [], "v", q, 8, 4).first()
    np.testing.assert_allclose(list(got), np.quantile(x, list(q.values())), rtol=1e-12)
    odd = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, float("inf"), float("-inf"), float("nan")] * 9], "v double")
    assert [str(v) for v in quantiles.exact_quantiles(odd, [], "v", {"a": 0, "b": 18 / 53, "c": 0.75, "d": 1}, 4, 4).first()] == ["-inf", "2.0", "inf", "nan"]


def test_a_column_with_all_rows_is_counted_in_its_partitions(spark):
    """Rows are not dealt by value or group before their cell is small: what is shuffled are counts."""
    df = spark.range(200_000).select(F.lit("hot").alias("k"), F.pmod(F.xxhash64("id"), F.lit(10 ** 9)).cast("double").alias("v"))
    out = quantiles.exact_quantiles(df, ["k"], "v", {"m": 0.5})
    want = np.median(df.toPandas()["v"])
    assert out.first()["m"] == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(k" in line]
    assert exchanges and "SinglePartition" not in plan
    rows = out._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in rows


def test_quantiles_of_nothing_and_of_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", None), ("b", 4.0)], "k string, v double")
    assert [tuple(r) for r in quantiles.exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()] == [("b", 4.0)]
    assert quantiles.exact_quantiles(df.limit(0), [], "v", {"m": 0.5}).count() == 0


def test_mode_takes_the_smallest_of_ties(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (1.0,), (1.0,), (5.0,)], "v double")
    assert quantiles.exact_mode(df, [], "v").first()["mode"] == 1.0


# ---- statistics --------------------------------------------------------------
def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "a double, b double")
    got = {(r["a"], r["b"]): r["corr"] for r in stats.correlation_matrix(df, ["a", "b"]).collect()}
    assert got[("a", "b")] is None and got[("b", "b")] == pytest.approx(1.0) and len(got) == 4


def test_pairwise_complete_correlation(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(200, 3)), columns=list("abc"))
    pdf.loc[::3, "a"] = np.nan
    pdf.loc[::5, "b"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = stats.correlation_matrix(df, list("abc")).toPandas().pivot(index="a", columns="b", values="corr")
    np.testing.assert_allclose(got.to_numpy(dtype=float), pdf.corr().to_numpy(), atol=1e-12)


@pytest.mark.parametrize("t, df, p", [(2.0, 10.0, 0.07338803477074), (0.5, 3.0, 0.65145), (12.706204736, 1.0, 0.05)])
def test_student_p_values(t, df, p):
    assert stats.student_two_sided(t, df) == pytest.approx(p, rel=1e-5)


def test_variance_inflation_against_regression(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    x[:, 2] += 0.8 * x[:, 0] - 0.5 * x[:, 1]
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")))
    got = {r["feature"]: r["vif"] for r in stats.variance_inflation(df, list("abc")).collect()}
    for i, name in enumerate("abc"):
        others = np.column_stack([np.ones(300), np.delete(x, i, axis=1)])
        residual = x[:, i] - others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        assert got[name] == pytest.approx(x[:, i].var() / residual.var(), rel=1e-8)


def test_cross_correlation_formula(spark):
    rng = np.random.default_rng(2)
    n, x = 50, np.cumsum(rng.normal(size=50))
    y = np.roll(x, 3) + rng.normal(size=50)
    pdf = pd.DataFrame({"branch_id": "A", "tm": pd.Timestamp("2021-01-01") + pd.to_timedelta(np.arange(n), "h"), "x": x, "y": y})
    got = crosscorr.cross_correlation(
        spark.createDataFrame(pdf), "x", ["y"], 49, Series(span=11, block_rows=4)
    ).toPandas().sort_values("lag")
    dx, dy = x - x.mean(), y - y.mean()
    want = [(dx[k:] * dy[: n - k]).sum() / (n - k) / (x.std() * y.std()) for k in range(1, 50)]
    np.testing.assert_allclose(got["ccf"], want, atol=1e-9)


# ---- decomposition -----------------------------------------------------------
@pytest.mark.parametrize("period", [4, 5])
def test_additive_decomposition(spark, period):
    n = 43
    rng = np.random.default_rng(4)
    y = rng.normal(size=n) + 0.3 * np.arange(n) + np.tile(np.arange(period), n)[:n]
    pdf = pd.DataFrame({"date": pd.date_range("2021-01-01", periods=n).date, "v": y})
    lane = Series(keys=(), order=("date",), axis="date", span=5, block_rows=6)
    got = decompose.additive_decomposition(spark.createDataFrame(pdf), "v", period, lane).toPandas().sort_values("date")
    half = period // 2
    weights = np.ones(2 * half + 1)
    if period % 2 == 0:
        weights[[0, -1]] = 0.5
    trend = np.full(n, np.nan)
    trend[half : n - half] = np.convolve(y, weights / period, mode="valid")
    phase = np.array([np.nanmean((y - trend)[p::period]) for p in range(period)])
    seasonal = (phase - phase.mean())[np.arange(n) % period]
    np.testing.assert_allclose(got["trend"].to_numpy(dtype=float), trend, atol=1e-9)
    np.testing.assert_allclose(got["seasonal"].to_numpy(dtype=float), seasonal, atol=1e-9)


def naive_loess(y, window, at):
    """One point at a time, straight from the definition."""
    n, out = len(y), []
    size = min(window, n)
    for x in at:
        left = int(min(max(math.floor(x) - (size - 1) // 2, 0), n - size))
        near = np.arange(left, left + size)
        radius = max(x - left, left + size - 1 - x) + max(window - n, 0) // 2
        w = np.array([(1 - (abs(j - x) / radius) ** 3) ** 3 if abs(j - x) <= 0.999 * radius else 0.0 for j in near])
        slope, level = np.polyfit(near, y[near], 1, w=np.sqrt(w))
        out.append(level + slope * x)
    return np.array(out)


def naive_stl(y, period, iterations):
    n, trend = len(y), np.zeros(len(y))
    for _ in range(iterations):
        d, cycle = y - trend, np.zeros(n + 2 * period)
        for p in range(period):
            sub = d[p::period]
            cycle[p::period] = naive_loess(sub, 7, np.arange(-1, len(sub) + 1))
        low = np.convolve(np.convolve(np.convolve(cycle, np.ones(period) / period, "valid"),
                                      np.ones(period) / period, "valid"), np.ones(3) / 3, "valid")
        low = naive_loess(low, stl.odd_at_least(period + 1), np.arange(n))
        seasonal = cycle[period : period + n] - low
        trend = naive_loess(y - seasonal, stl.trend_window(period), np.arange(n))
    return trend, seasonal


def wave(n, period):
    rng = np.random.default_rng(8)
    i = np.arange(n)
    return 10 + 0.01 * i + 3 * np.sin(2 * np.pi * i / period) + rng.normal(0, 0.3, n)


def test_stl_equals_the_point_by_point_form():
    y = wave(150, 12)
    got, want = stl.stl_arrays(y, 12, 2), naive_stl(y, 12, 2)
    np.testing.assert_allclose(got[0], want[0], atol=1e-7)
    np.testing.assert_allclose(got[1], want[1], atol=1e-7)


def test_stl_in_blocks_equals_the_whole_series(spark):
    n, period, loops = 900, 6, 2
    y = wave(n, period)
    assert stl.reach(period, loops) < 150
    pdf = pd.DataFrame({"branch_id": "A", "tm": pd.Timestamp("2021-01-01") + pd.to_timedelta(np.arange(n), "h"), "ta": y})
    short = pd.DataFrame({"branch_id": "B", "tm": pdf["tm"][:5], "ta": y[:5]})
    df = spark.createDataFrame(pd.concat([pdf, short]))
    lane = Series(span=50, block_rows=200)
    got = stl.stl(df, "ta", period, 10, loops, lane).toPandas().sort_values(["branch_id", "tm"])
    whole = stl.stl_arrays(y, period, loops)
    a, b = got[got.branch_id == "A"], got[got.branch_id == "B"]
    np.testing.assert_allclose(a["trend"], whole[0], atol=1e-9)
    np.testing.assert_allclose(a["seasonal"], whole[1], atol=1e-9)
    np.testing.assert_allclose(a["trend"] + a["seasonal"] + a["resid"], y, atol=1e-9)
    assert list(b["trend"]) == list(y[:5]) and set(b["seasonal"]) == {0.0}


def test_robust_stl_in_blocks_equals_the_whole_series(spark):
    n, period = 700, 6
    y = wave(n, period)
    y[::50] += 40
    pdf = pd.DataFrame({"branch_id": "A", "tm": pd.Timestamp("2021-01-01") + pd.to_timedelta(np.arange(n), "h"), "ta": y})
    lane = Series(span=50, block_rows=200)
    got = stl.robust_stl(spark.createDataFrame(pdf), "ta", period, 10, 2, 2, lane).toPandas().sort_values("tm")
    trend, seasonal = stl.stl_arrays(y, period, 2)
    for _ in range(2):
        r = np.abs(y - trend - seasonal)
        share = r / (6 * np.median(r))
        w = np.where(share <= 0.001, 1.0, np.where(share <= 0.999, (1 - share**2) ** 2, 0.0))
        trend, seasonal = stl.stl_arrays(y, period, 2, row_weights=w, trend=trend)
    np.testing.assert_allclose(got["trend"], trend, atol=1e-8)
    np.testing.assert_allclose(got["seasonal"], seasonal, atol=1e-8)
    plain = stl.stl_arrays(y, period, 2)[0]
    base = 10 + 0.01 * np.arange(n)
    assert np.abs(trend - base)[50:-50].mean() < np.abs(plain - base)[50:-50].mean()


# ---- clustering ---------------------------------------------------------------
def test_projection_is_centred_and_keeps_variance(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(40, 3)) * [5, 2, 0.1] + 100
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")))
    got = clustering.project2(df.select("a", F.array("a", "b", "c").alias("v")), "v", ["a"]).toPandas()
    values = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)
    np.testing.assert_allclose(got[["pc1", "pc2"]].mean(), 0, atol=1e-9)
    np.testing.assert_allclose(np.linalg.norm(got[["pc1", "pc2"]], axis=0), values[:2], rtol=1e-9)


# ---- encodings, splits, scores --------------------------------------------------
def test_unseen_labels(spark):
    seen = spark.createDataFrame([("b",), ("a",)], "c string")
    other = spark.createDataFrame([("a",), ("z",)], "c string")
    coded = encode.label_encode(encode.label_encoder(seen, ["c"]), other).orderBy("c")
    assert [r["c_code"] for r in coded.collect()] == [0, -1]
    hot = encode.one_hot_encoder(seen, ["c"]).transform(other).orderBy("c").collect()
    assert [list(r["c_onehot"].toArray()) for r in hot] == [[1.0, 0.0], [0.0, 0.0]]


def test_relative_error_needs_positive_targets(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, prediction double")
    row = metrics.regression_metrics(df).first()
    assert row["MAPE"] is None and row["MAE"] == 1.0


@pytest.mark.parametrize("n, k", [(10, 3), (23, 3), (7, 2)])
def test_expanding_folds(spark, n, k):
    df = spark.range(n).select(
        F.lit("A").alias("branch_id"), F.expr("timestamp'2021-01-01' + make_dt_interval(0, cast(id as int))").alias("tm"), "id"
    )
    got = {r["id"]: r["fold"] for r in splits.expanding_folds(df, k).collect()}
    size = n // (k + 1)
    for f in range(k):
        start = n - (k - f) * size
        assert [i for i in range(n) if got[i] == f] == list(range(start, start + size))


def test_group_model_beats_the_mean(spark):
    rng = np.random.default_rng(6)
    x = rng.uniform(-10, 30, 600)
    pdf = pd.DataFrame({
        "id": range(600), "tm": pd.Timestamp("2021-01-01"), "branch_id": np.where(np.arange(600) % 2, "B", "C"), "ta": x,
        "cluster_key": "cluster1", "heat_demand": 100 - 2 * x + rng.normal(0, 1, 600),
    })
    df = spark.createDataFrame(pdf).withColumn("heat_demand_log", F.log1p("heat_demand"))
    model = train.fit_group(df, params={"maxIter": 8, "maxDepth": 4, "stepSize": 0.3})
    scored = train.predict_groups({"cluster1": model}, {"cluster1": df})
    row = metrics.regression_metrics(scored, ["cluster_key", "model"]).first()
    assert row["R2"] > 0.8 and scored.count() == 600
    weights = model.importance(df).collect()
    assert sum(w["importance"] for w in weights) == pytest.approx(1.0)
    assert weights[0]["feature"] == "ta"


def test_missing_report_lists_only_columns_with_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    assert [tuple(r) for r in aggregates.missing_report(df).collect()] == [("b", 1, 50.0)]
