"""Positional operators on tiny chunks and blocks against plain pandas over whole series."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from thermopanel.operators import gaps, lags
from thermopanel.operators.series import IDX, LEN, Series

SMALL = Series(span=7, block_rows=5)


def panel(lengths=(60, 23, 3, 1), seed=0):
    """Irregular hours, long and short gaps, leading and trailing nulls, one short series."""
    rng = np.random.default_rng(seed)
    parts = []
    for site, n in zip("ABCD", lengths):
        hours = np.sort(rng.choice(n * 4, n, replace=False))
        x = np.round(rng.normal(10, 5, n), 2)
        x[rng.random(n) < 0.3] = np.nan
        if n > 40:
            x[8:38] = np.nan
            x[:2], x[-2:] = np.nan, np.nan
        parts.append(pd.DataFrame({
            "branch_id": site, "tm": pd.Timestamp("2021-01-01") + pd.to_timedelta(hours, "h"), "x": x,
            "y": np.round(rng.normal(0, 1, n), 3),
        }))
    return pd.concat(parts, ignore_index=True)


def to_spark(spark, pdf):
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1))
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("x", "y")})


def collected(df, *cols):
    out = df.select("branch_id", "tm", *cols).toPandas().sort_values(["branch_id", "tm"]).reset_index(drop=True)
    return out


def same(got, want):
    np.testing.assert_allclose(
        np.asarray(got, dtype=float), np.asarray(want, dtype=float), rtol=1e-9, atol=1e-9, equal_nan=True
    )


@pytest.fixture(scope="module")
def pdf():
    return panel()


def test_row_index_and_length(spark, pdf):
    got = collected(SMALL.row_index(to_spark(spark, pdf)), IDX, LEN)
    groups = pdf.groupby("branch_id")
    same(got[IDX], groups.cumcount())
    same(got[LEN], groups["tm"].transform("size"))


def test_lags_and_changes(spark, pdf):
    got = collected(lags.with_lags(to_spark(spark, pdf), {"x": [1, 4, 13]}, SMALL), "x_lag1", "x_lag4", "x_lag13")
    for n in (1, 4, 13):
        same(got[f"x_lag{n}"], pdf.groupby("branch_id")["x"].shift(n))
    got = collected(lags.changes(to_spark(spark, pdf), "y", (1, 7), SMALL), "y_diff_7h", "y_pct_1h")
    same(got["y_diff_7h"], pdf.groupby("branch_id")["y"].diff(7))
    same(got["y_pct_1h"], pdf.groupby("branch_id")["y"].pct_change(fill_method=None))


def test_change_from_zero_is_null(spark):
    rows = [("A", datetime(2021, 1, 1), 0.0), ("A", datetime(2021, 1, 1, 1), 2.0)]
    df = spark.createDataFrame(rows, "branch_id string, tm timestamp, y double")
    assert [r[0] for r in lags.changes(df, "y", (1,)).orderBy("tm").select("y_pct_1h").collect()] == [None, None]


@pytest.mark.parametrize("k", [1, 3, 9])
def test_rolling_means(spark, pdf, k):
    got = collected(lags.past_means(to_spark(spark, pdf), ["x", "y"], [k], SMALL), f"x_roll{k}", f"y_roll{k}")
    for c in "xy":
        same(got[f"{c}_roll{k}"], pdf.groupby("branch_id")[c].transform(lambda s: s.shift(1).rolling(k).mean()))
    got = collected(lags.moving_averages(to_spark(spark, pdf), ["x"], k, SMALL), "x_ma")
    same(got["x_ma"], pdf.groupby("branch_id")["x"].transform(lambda s: s.rolling(k, min_periods=k).mean()))


@pytest.mark.parametrize("n", [1, 3, 12, 30, 31, 50])
def test_padded_lags(spark, n):
    x = np.arange(n, dtype=float) + 100
    x[n // 2] = np.nan
    pdf = pd.DataFrame({
        "branch_id": "A", "tm": pd.Timestamp("2021-01-01") + pd.to_timedelta(np.arange(n), "h"), "x": x, "y": 0.0
    })
    wanted = {"x": [1, 3, 24, 30]}
    got = collected(lags.padded_lags(to_spark(spark, pdf), wanted, Series(span=7, block_rows=32)),
                    *[f"x_plag{k}" for k in wanted["x"]])
    pad = min(30, n)
    extended = pd.Series(np.concatenate([x[:pad], x]))
    for k in wanted["x"]:
        same(got[f"x_plag{k}"], extended.shift(k).iloc[pad:])


def test_unknown_lag_columns_are_skipped(spark, pdf):
    got = lags.padded_lags(to_spark(spark, pdf), {"nope": [1, 2], "y": [1]}, SMALL)
    assert "y_plag1" in got.columns and not [c for c in got.columns if c.startswith("nope")]


def test_running_sum_and_fills(spark, pdf):
    df = to_spark(spark, pdf)
    got = collected(SMALL.running_sum(df, {"total": F.col("x")}), "total")
    same(got["total"], pdf.fillna({"x": 0}).groupby("branch_id")["x"].cumsum())
    got = collected(SMALL.fill(df, ["x"]), "x")
    same(got["x"], pdf.groupby("branch_id")["x"].ffill())
    got = collected(SMALL.fill(df, ["x", "y"], forward=False, backward=True), "x")
    same(got["x"], pdf.groupby("branch_id")["x"].bfill())
    across = Series(keys=(), order=("branch_id", "tm"), axis="tm", span=7)
    got = collected(across.fill(df, ["x"], True, True), "x")
    same(got["x"], pdf["x"].ffill().bfill())


def test_running_radiation_continues_after_null(spark):
    si = [1.0, None, 2.0, 3.0]
    rows = [("A", datetime(2021, 1, 1, i), v) for i, v in enumerate(si)]
    rows.append(("A", datetime(2021, 1, 2), 5.0))
    df = spark.createDataFrame(rows, "branch_id string, tm timestamp, si double")
    got = [r[0] for r in lags.running_radiation(df).orderBy("tm").select("cumulative_si").collect()]
    assert got == [1.0, None, 3.0, 6.0, 5.0]


def test_null_runs(spark, pdf):
    got = gaps.null_runs(to_spark(spark, pdf), "x", SMALL).toPandas().sort_values(["branch_id", "start_time"])
    want = []
    for site, g in pdf.groupby("branch_id"):
        null = g["x"].isna()
        for _, run in g[null].groupby((null != null.shift()).cumsum()[null]):
            want.append((site, run["tm"].iloc[0], run["tm"].iloc[-1], len(run)))
    assert list(got[["branch_id", "start_time", "end_time", "length"]].itertuples(index=False, name=None)) == want


def test_outage_runs_split_on_steps(spark):
    hours = [0, 1, 2, 5, 6, 20]
    rows = [("A", datetime(2021, 1, 1) + timedelta(hours=h), None) for h in hours]
    df = spark.createDataFrame(rows, "branch_id string, tm timestamp, x double")
    got = sorted(r["duration"] for r in gaps.outage_runs(df, ["x"], series=Series(span=2, block_rows=2)).collect())
    assert got == [1, 2, 3]


def literal_interpolation(s: pd.Series) -> pd.Series:
    null = s.isna()
    line = s.interpolate(method="linear")
    out = s.copy()
    for _, run in s[null].groupby((null != null.shift()).cumsum()[null]):
        if len(run) <= 24:
            out.loc[run.index] = line.loc[run.index]
    return out


def test_interpolation_by_gap_length(spark, pdf):
    got = collected(gaps.interpolate_gaps(to_spark(spark, pdf), ["x"], series=Series(span=7, block_rows=30)), "x")
    same(got["x"], pdf.groupby("branch_id")["x"].transform(literal_interpolation))


def test_quadratic_interpolation_recovers_a_parabola(spark):
    i = np.arange(40.0)
    y = 3 + 2 * i - 0.25 * i * i
    x = y.copy()
    x[10:16] = np.nan
    pdf = pd.DataFrame({"branch_id": "A", "tm": pd.Timestamp("2021-01-01") + pd.to_timedelta(i, "h"), "x": x, "y": 0.0})
    got = collected(gaps.interpolate_gaps(to_spark(spark, pdf), ["x"], mode="quadratic"), "x")
    same(got["x"], y)


def test_missing_hours_per_site(spark, pdf):
    got = gaps.missing_hours(to_spark(spark, pdf)).count()
    want = sum(
        len(pd.date_range(g["tm"].min(), g["tm"].max(), freq="h")) - len(g) for _, g in pdf.groupby("branch_id")
    )
    assert got == want
