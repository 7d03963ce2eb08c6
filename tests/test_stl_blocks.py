"""Decomposition in blocks equals that of the whole series, for any block size, nulls and long series included."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermopanel.operators.lags import past_means
from thermopanel.operators.stl import STL_SERIES, stl, stl_arrays


def hours(spark, values):
    rows = [(i, float(v) if v is not None else None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "h int, ta double").select(
        F.lit("A").alias("branch_id"), (F.lit("2021-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("h"))).alias("tm"), "h", "ta")


@pytest.mark.parametrize("n", [20_000])
def test_blocks_of_a_long_series(spark, n):
    rng = np.random.default_rng(4)
    y = 10 * np.sin(np.arange(n) / 24 * 2 * np.pi) + np.cumsum(rng.normal(0, 0.1, n)) + rng.normal(0, 1, n)
    trend, seasonal = stl_arrays(y, 24)
    for rows in (4096, 16384):
        found = stl(hours(spark, y), series=replace(STL_SERIES, block_rows=rows)).orderBy("h").toPandas()
        assert np.abs(found.trend - trend).max() < 1e-9 and np.abs(found.seasonal - seasonal).max() < 1e-9


def test_one_null_treats_the_whole_series_alike(spark):
    values = [float(i % 24) for i in range(400)]
    values[390] = None
    for rows in (128, 4096):
        found = stl(hours(spark, values), series=replace(STL_SERIES, block_rows=rows))
        assert found.where("seasonal <> 0").count() == 0


def test_means_recover_after_an_infinite_reading(spark):
    values = [float(i) for i in range(20)]
    values[5] = float("inf")
    rows = past_means(hours(spark, values), ["ta"], [3]).orderBy("h").collect()
    assert rows[8].ta_roll3 is None and rows[9].ta_roll3 == 7.0 and rows[4].ta_roll3 == 2.0
