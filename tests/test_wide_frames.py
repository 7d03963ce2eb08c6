"""Wide frames: rounding, fills and lags that cost what their columns need."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from thermopanel.functions.numeric import round_half_up
from thermopanel.models import train
from thermopanel.operators import lags
from thermopanel.operators.series import Series

LANE = Series(span=24, block_rows=16)
START = datetime(2021, 1, 1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rounding_is_that_of_round(spark):
    ties = [k / 2e6 for k in range(-41, 42)] + [0.0000005, 2.5000005, 1.0000015, -1.0000015, 1e-9, -1e-9]
    odd = [0.0, -0.0, None, math.nan, math.inf, -math.inf, 1e300, -1e300, 5e-324, 999999.9999995, 1e6 + 0.1, 123456789.1234565]
    df = spark.createDataFrame([(x,) for x in ties + [x + 1e-9 for x in ties] + odd], "x double")
    drawn = spark.range(20_000).select(((F.rand(1) - 0.5) * F.pow(F.lit(10.0), F.rand(2) * 24 - 10)).alias("x"))
    for places in (2, 6, 9):
        got, want = round_half_up(F.col("x"), places) + F.lit(0.0), F.round("x", places) + F.lit(0.0)
        assert df.unionByName(drawn).filter(~got.eqNullSafe(want)).count() == 0


def test_queries_round_without_decimals(spark, sf_dir):
    plan = contract.queries()["lag_grid_ts9"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "rint(" in plan.lower()


#: site: readings of x in order
READINGS = {
    "A": [None] * 5,
    "B": [None, None, 3.0, None, 5.0, *[float(i) for i in range(40)], None, None],
    "C": [7.5],
    "D": [*[None] * 30, math.nan, 1.0, None],
    "E": [None, 2.0, None, None],
}


@pytest.fixture(scope="module")
def panel(spark):
    rows = [
        (s, START + timedelta(hours=i), x, i, i) for s, xs in READINGS.items() for i, x in enumerate(xs)
    ]
    return LANE.row_index(spark.createDataFrame(rows, "branch_id string, tm timestamp, x double, k int, i int"))


def padded_lag(xs, n, longest, padded):
    p = min(longest, len(xs)) if padded else 0
    ahead = [xs[p - n + i] if 0 <= p - n + i < p else None for i in range(n)]
    return (ahead + xs)[:len(xs)]


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("padded", [True, False])
def test_lags_filled_over_a_group(spark, panel, padded):
    wanted, longest = {"x": [1, 3, 9], "k": [2]}, 9
    df, listed = lags.group_filled(panel, ["x"], wanted, padded, LANE)
    laid = LANE.blocks(df, before=longest).select("*", *[c.alias(name) for name, c in listed.items()])
    names = ["x", *listed]
    got = LANE.own_rows(laid).orderBy("branch_id", "tm").select(*names).collect()
    for name in names:
        c, n = ("x", 0) if name == "x" else (name[0], int(name[6:]))
        flat = []
        for s in sorted(READINGS):
            xs = READINGS[s] if c == "x" else list(range(len(READINGS[s])))
            flat += padded_lag(xs, n, longest, padded)
        for way in (range(len(flat)), reversed(range(len(flat)))):
            last = None
            for i in way:
                last = flat[i] = last if flat[i] is None else flat[i]
        assert all(same(row[name], v) for row, v in zip(got, flat, strict=True)), name


def test_group_fill_sorts_no_row_per_lag(panel):
    df, listed = lags.group_filled(panel, ["x"], {"x": range(1, 10)}, True, LANE)
    laid = LANE.own_rows(LANE.blocks(df, before=9).select("*", *[c.alias(name) for name, c in listed.items()]))
    assert plan_of(laid).count("\n") < 40 and "Join" not in plan_of(laid)


def test_fill_adds_up_chunks_without_sorting_them(panel):
    plan = plan_of(LANE.fill(panel, ["x"], True, True))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_padded_lags_compute_no_lead(panel):
    out = lags.padded_lags(panel, {"x": [1, 3, 9]}, LANE)
    assert "lead(" not in plan_of(out)
    for n in (1, 3, 9):
        for s, xs in READINGS.items():
            got = [r[0] for r in out.filter(F.col("branch_id") == s).orderBy("tm").select(f"x_plag{n}").collect()]
            assert all(map(same, got, padded_lag(xs, n, 9, True)))


def test_models_of_a_group_share_its_rows_and_features(spark, tmp_path):
    rows = spark.range(200).select(
        "id", F.lit(START).alias("tm"), F.lit("B").alias("branch_id"), (F.col("id") % 7).cast("double").alias("x"),
        F.log1p(F.col("id") % 7).alias("heat_demand_log"))
    rows.write.parquet(f"{tmp_path}/rows")
    frames = {"g": spark.read.parquet(f"{tmp_path}/rows")}
    small, deep = {"maxIter": 2, "maxDepth": 2}, {"maxIter": 2, "maxDepth": 3}
    both = train.fit_models(frames, {"small": (small, {}), "deep": (small, {"g": deep})})
    assert both["small"]["g"].features is both["deep"]["g"].features
    got = train.predict_models(both, frames)
    assert plan_of(got).count("FileScan parquet") == 1
    apart = [train.predict_groups(both[m], frames, name=m) for m in ("small", "deep")]
    assert sorted(got.collect()) == sorted(apart[0].unionByName(apart[1]).collect()) and got.count() == 400
