"""Coverage of the inventory, plan shapes, bounded pieces, and the composed jobs."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from thermopanel import rules
from thermopanel.catalog import frames
from thermopanel.operators import lags
from thermopanel.operators.series import BLOCK, SITE_HOURS, Series
from thermopanel.plans import experiment, features
from thermopanel.sources import files, panels

INVENTORY = {"io": 7, "cl": 19, "fe": 21, "jn": 9, "ag": 21, "ts": 21, "st": 9, "km": 7, "ml": 17, "so": 4, "se": 4}


def test_every_inventory_line_has_a_query_with_sql():
    covered = {m.group(1) for n in contract.oracle_sql() if (m := re.search(r"_([a-z]{2}\d+)$", n))}
    assert {f"{k}{i}" for k, n in INVENTORY.items() for i in range(1, n + 1)} <= covered
    assert set(contract.oracle_sql()) <= set(contract.queries())


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "night_radiation_cl7", "iqr_outliers_cl12", "padded_lags_ts5", "cross_correlation_ts18", "demand_histogram_ag16",
    "squared_silhouette_of_embeddings_km3", "expanding_folds_ml6", "features_of_cluster1", "pooled_best_metrics_ml12",
])
def test_no_cross_joins(spark, sf_dir, name):
    plan = plan_of(contract.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_many_lags_share_one_window_and_the_scan_reads_two_columns(spark, sf_dir):
    plan = plan_of(lags.lag_grid(frames.clean(spark, sf_dir), ["ta", "ta_chi"], 23))
    windows = re.findall(r"\n[^\n]*Window \[lag", plan)
    assert len(windows) == 1
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert set(re.findall(r"(\w+):", schema)) <= {"event_id", "value"}


def test_blocks_are_bounded_and_lose_no_row(spark):
    rows = spark.range(10_000).select(
        F.when(F.col("id") < 9_900, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("branch_id"),
        F.expr("timestamp'2021-01-01' + make_dt_interval(0, cast(id as int))").alias("tm"), "id",
    )
    lane = Series(span=100, block_rows=64)
    laid = lane.blocks(rows, before=10, after=5)
    assert laid.groupBy("branch_id", BLOCK).count().agg(F.max("count")).first()[0] <= 64 + 15
    own = lane.own_rows(laid)
    assert own.count() == 10_000 and own.select("id").distinct().count() == 10_000


def test_unmapped_dataset_raises(spark):
    with pytest.raises(ValueError, match="unknown dataset"):
        files.load_dataset(spark, "/nowhere", "cold")


def test_features_without_look_ahead(spark, sf_dir):
    raw = panels.obs_season(spark, sf_dir)
    frame = features.group_frame(raw, "cluster1", padded=False, fill=None, decompose=False)
    cut = datetime(2021, 1, 20)
    early = features.group_frame(raw.filter(F.col("tm") < cut), "cluster1", padded=False, fill=None, decompose=False)
    columns = ["id", "ta_plag2", "ws_lag24", "ta_roll24", "dew_point", "cumulative_si"]
    a = sorted(map(tuple, frame.filter(F.col("tm") < cut).select(*columns).collect()))
    assert a == sorted(map(tuple, early.select(*columns).collect())) and a


def test_all_groups_keep_every_mapped_row(spark, sf_dir):
    raw = panels.obs_season(spark, sf_dir)
    keys = ("cluster1", "cluster2_summer", "cluster2_non_summer")
    got = features.all_groups(raw, keys, decompose=False, lag_columns=["ta"])
    sites = rules.cluster_members(1) + rules.cluster_members(2)
    want = frames.ready_season(spark, sf_dir).filter(F.col("branch_id").isin(sites)).count()
    assert got.count() == want
    assert not got.filter("cluster_key = 'cluster1' AND ta_plag24 IS NOT NULL").head(1)


def test_all_groups_share_one_pass_over_the_panel(spark, sf_dir):
    frames_of_groups = features.group_frames(panels.obs_season(spark, sf_dir), ("cluster1", "cluster3"), decompose=False, fill="group")
    for key, frame in frames_of_groups.items():
        plan = plan_of(frame)
        assert "events.parquet" not in plan and frame.count() > 0
        alone = features.group_frame(panels.obs_season(spark, sf_dir), key, decompose=False, fill="group")
        columns = ["id", "ta", "ws", "ta_roll24", "cumulative_si", "dew_point"]
        assert sorted(frame.select(*columns).collect()) == sorted(alone.select(*columns).collect())


def test_training_run_end_to_end(spark, sf_dir):
    raw = panels.obs_season(spark, sf_dir)
    options = experiment.Options(models={"GBT": {"maxIter": 1, "maxDepth": 2}}, keys=("cluster1",))
    cut = datetime(2021, 1, 25)
    out = experiment.run(
        raw.filter(F.col("tm") < cut), raw.filter(F.col("tm") >= cut), raw.select("id", "heat_demand"), options
    )
    assert out["metrics"].count() == 1 and out["global_metrics"].first()["RMSE"] > 0
    filled = out["submission"].filter("heat_demand IS NOT NULL")
    want = frames.ready_season(spark, sf_dir).filter(F.col("tm") >= cut).filter(F.col("branch_id").isin(*"BCG")).count()
    assert out["submission"].count() == raw.count() and filled.count() == want


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
    assert SITE_HOURS.span % 24 == 0
