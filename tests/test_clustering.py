"""Scores and k-means against plain numpy, beyond one tile, and on repeated, lone and missing points."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermopanel.operators import clustering, lloyd


def cloud(spark, n=300, groups=7, d=3, seed=1):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, groups, n)
    x = np.round(rng.normal(size=(n, d)) + 3 * label[:, None] % 5, 3)
    x[n // 3:2 * n // 3] = x[0]  # a third of the rows is one point
    label[n // 3:2 * n // 3] = label[0]
    label[-1] = 99  # a group of one
    rows = [(i, v.tolist(), int(l)) for i, (v, l) in enumerate(zip(x, label))]
    return x, label, spark.createDataFrame(rows, "key long, v array<double>, l int").repartition(4)


def plain_silhouette(x, label, power=1):
    gap = ((x[:, None] - x[None]) ** 2).sum(axis=2) ** (power / 2)
    out = []
    for i, own in enumerate(label):
        size = (label == own).sum()
        if size == 1:
            out.append(0.0)
            continue
        a = gap[i, label == own].sum() / (size - 1)
        b = min((gap[i, label == other].mean() for other in set(label) - {own}), default=None)
        out.append(0.0 if b is None or max(a, b) == 0 else (b - a) / max(a, b))
    return np.mean(out)


@pytest.mark.parametrize("tile_rows", [None, 16])
def test_silhouettes(spark, tile_rows):
    x, label, df = cloud(spark)
    df = df.withColumn("half", F.col("key") % 2).unionByName(spark.createDataFrame([(1000, None, 1, 0), (1001, [1.0, 2.0, 3.0], None, 0)], "key long, v array<double>, l int, half long"))
    got = {r["labels"]: r["silhouette"] for r in clustering.silhouettes(df, "v", ["l", "half"], tile_rows).collect()}
    assert got["l"] == pytest.approx(plain_silhouette(x, label), abs=1e-9)
    assert got["half"] == pytest.approx(plain_silhouette(x, np.arange(len(x)) % 2), abs=1e-9)
    squared = clustering.squared_silhouette(df, "v", "l", tile_rows).first()["silhouette"]
    assert squared == pytest.approx(plain_silhouette(x, label, 2), abs=1e-9)


def test_scores_of_nothing_and_of_one_group(spark):
    _, _, df = cloud(spark, 30)
    for score in (clustering.silhouette, clustering.squared_silhouette):
        assert score(df.limit(0), "v", "l").first()["silhouette"] is None
        assert score(df.withColumn("l", F.lit(1)), "v", "l").first()["silhouette"] == 0.0
    assert clustering.dispersion_scores(df.limit(0), "v", "l").first() == (None, None)


@pytest.mark.parametrize("groups, tile_rows", [(7, None), (1500, 200)])
def test_dispersion_takes_any_number_of_groups(spark, groups, tile_rows):
    x, label, df = cloud(spark, 4000, groups)
    names, at = np.unique(label, return_inverse=True)
    centres = np.array([x[at == g].mean(axis=0) for g in range(len(names))])
    own = np.sqrt(((x - centres[at]) ** 2).sum(axis=1))
    spread = np.array([own[at == g].mean() for g in range(len(names))])
    gap = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(gap > 0, np.add.outer(spread, spread) / gap, -np.inf)
    within, total = (own ** 2).sum(), ((x - x.mean(axis=0)) ** 2).sum()
    k, n = len(names), len(x)
    got = clustering.dispersion_scores(df, "v", "l", tile_rows).first()
    assert got["calinski_harabasz"] == pytest.approx((total - within) / (k - 1) / (within / (n - k)))
    assert got["davies_bouldin"] == pytest.approx(ratio.max(axis=1).mean())
    means = {r["l"]: r["v"] for r in clustering.mean_vectors(df, "l", "v").collect()}
    np.testing.assert_allclose([means[l] for l in names], centres, atol=1e-9)


def plain_lloyd(x, centres):
    for _ in range(300):
        near = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[near == g].mean(axis=0) if (near == g).any() else c for g, c in enumerate(centres)])
        if np.allclose(new, centres, atol=1e-12):
            break
        centres = new
    return near, ((x - centres[near]) ** 2).sum()


def test_all_runs_share_passes_and_equal_plain_steps(spark):
    x, _, df = cloud(spark, 200)
    runs = lloyd.written_starts(df, "key", "v", [2, 5], starts=3)
    assert len(runs) == 6
    best = lloyd.fit(df, "key", "v", [2, 5], starts=3)
    for k in (2, 5):
        plain = [plain_lloyd(x, r.centres) for r in runs if r.k == k]
        near, cost = min(plain, key=lambda p: round(p[1], 6))
        assert best[k].cost == pytest.approx(cost)
        got = {r["key"]: r[f"cluster_of{k}"] for r in lloyd.assign(df, "v", {k: best[k]}).collect()}
        assert [got[i] for i in range(len(x))] == near.tolist()


def test_more_groups_than_points(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [0.0])], "key long, v array<double>")
    best = lloyd.fit(df, "key", "v", [1, 2, 3], starts=2)
    assert sorted(best) == [1, 2] and best[2].cost == 0
    assert [r["cluster_of2"] for r in lloyd.assign(df, "v", {2: best[2]}).collect()] == [0, 0]
    assert lloyd.fit(df.limit(0), "key", "v", [2]) == {}
