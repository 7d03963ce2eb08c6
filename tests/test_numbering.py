"""Positions and fills along one order, over several range partitions and with many equal rows."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from thermopanel.models import splits
from thermopanel.operators import numbering, ordering


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(4)
    data = [(i, 7 if rnd.random() < 0.4 else rnd.randrange(50), rnd.choice([None, None, 1.5, 2.5])) for i in range(3000)]
    return data, spark.createDataFrame(data, "id long, t long, v double").repartition(6)


@pytest.fixture()
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_positions_follow_the_order(spark, rows, many_partitions):
    data, df = rows
    out = numbering.row_numbers(df, ["t"], "i", "n").collect()
    assert sorted(r["i"] for r in out) == list(range(len(data))) and {r["n"] for r in out} == {len(data)}
    assert [r["t"] for r in sorted(out, key=lambda r: r["i"])] == sorted(t for _, t, _ in data)
    parts = numbering.placed(df, ["t"]).groupBy("__part").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < len(data) * 0.6  # 40 % of the rows share one t


def test_last_known_values_cross_partitions(spark, rows, many_partitions):
    data, df = rows
    sparse = [(i, t, v if i % 97 == 5 else None) for i, t, v in data]
    got = {r["id"]: r["v"] for r in numbering.filled_along(spark.createDataFrame(sparse, df.schema), ["id"], ["v"]).collect()}
    now = None
    for i, _, v in sorted(sparse):
        now = now if v is None else v
        assert got[i] == now


def test_slices_and_folds(spark, rows, many_partitions):
    data, df = rows
    ids = [i for i, _, _ in data]
    for first, last in ((0, 5), (100, 130), (-10, 0), (-7, -2), (2990, 4000), (10, -2985), (5, 5)):
        want = ids[first:last or None]
        assert sorted(r["id"] for r in ordering.position_slice(df, ("id",), first, last).collect()) == want
    folds = {r["id"]: r["fold"] for r in splits.expanding_folds(df, 3, ("id",)).collect()}
    t = len(ids) // 4
    assert all(folds[i] == (max(-1, 2 - (len(ids) - 1 - i) // t) if (len(ids) - 1 - i) // t < 3 else -1) for i in ids)


def test_nothing(rows):
    _, df = rows
    assert numbering.row_numbers(df.limit(0), ["t"], "i", "n").count() == 0
    assert numbering.filled_along(df.limit(0), ["t"], ["v"]).count() == 0


@pytest.mark.parametrize("name", ["expanding_folds_ml6", "position_slice_so4", "tail_rows_so4", "scoring_fill_by_row_cl8"])
def test_no_task_gets_all_rows(spark, sf_dir, name):
    plan = contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
