"""Grouping points by pattern: k-means, scores of an assignment, projection.

Scores take any number of points and groups. Pairwise distances and point-to-group distances go tile by tile
(:mod:`thermopanel.operators.tiles`); group moments are combined before the shuffle.
Points whose label or vector is null are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermopanel.operators import lloyd
from thermopanel.operators.tiles import numbered, over_tile_pairs, squared_distances, tile_count, vectors_of

#: distances a task holds at once
HELD = 1 << 20


def assemble(df: DataFrame, columns: Sequence[str], missing: float = 0.0) -> DataFrame:
    """Columns to one vector; a cell without data gets ``missing``."""
    filled = df.na.fill(missing, subset=list(columns))
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(filled)


def filled_vector(columns: Sequence[str], missing: float = 0.0) -> Column:
    """Columns as one array; a cell without data gets ``missing``."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(missing)) for c in columns])


def kmeans_assign(points: DataFrame, key: str, vector: str, ks: Sequence[int], **options) -> DataFrame:
    """The points with a column ``cluster_of{k}`` per k; all k and starts share their passes."""
    return lloyd.assign(points, vector, lloyd.fit(points, key, vector, ks, **options))


def elbow_curve(points: DataFrame, key: str, vector: str, ks: Sequence[int] = range(2, 12), **options) -> DataFrame:
    """Within-cluster sum of squares per k."""
    costs = [(k, run.cost) for k, run in sorted(lloyd.fit(points, key, vector, ks, **options).items())]
    return points.sparkSession.createDataFrame(costs, "k int, inertia double")


# ---- silhouettes -----------------------------------------------------------------------------------------------------
def _labelled(points: DataFrame, vector: str, *labels: str) -> DataFrame:
    """(v, label0, label1, ...) with labels as text; rows with a null among them are left out."""
    v = F.transform(vector, lambda x: x.cast("double"))
    return points.select(v.alias("v"), *[F.col(c).cast("string").alias(f"label{i}") for i, c in enumerate(labels)]).na.drop()


def _silhouette_value(a: Column, b: Column, size: Column) -> Column:
    """A point alone in its group scores 0."""
    return F.when(size <= 1, 0.0).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))


def _text(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy(zero_copy_only=False).astype(str)


def _label_sums(count: int):
    """Per point of the left tile, labelling and label of the right tile: sum of distances and number of points."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        x, y, n = vectors_of(left, "v"), vectors_of(right, "v"), right.column("n").to_numpy()
        named = [np.unique(_text(right, f"label{i}"), return_inverse=True) for i in range(count)]
        weights = np.concatenate([np.zeros((len(y), 0)), *[(group[:, None] == np.arange(len(names))) * n[:, None] for names, group in named]], axis=1)
        totals, step = [np.zeros((0, weights.shape[1]))], max(1, HELD // max(1, len(y)))
        for i in range(0, len(x) if len(y) else 0, step):
            totals.append(np.sqrt(squared_distances(x[i:i + step], y)) @ weights)
        total = np.concatenate(totals)
        points, width = len(total), weights.shape[1]
        which = np.concatenate([np.zeros(0, int), *[np.full(len(names), i) for i, (names, _) in enumerate(named)]])
        own = [_text(left, f"label{i}")[:points, None] == names for i, (names, _) in enumerate(named)]
        label = [str(x) for names, _ in named for x in names]
        return pa.table({
            "id": pa.array(np.repeat(left.column("id").to_numpy()[:points], width), pa.int64()),
            "which": pa.array(np.tile(which, points), pa.int32()), "label": pa.array(label * points, pa.string()),
            "own": pa.array(np.concatenate(own, axis=1).ravel() if points else [], pa.bool_()),
            "n": pa.array(np.repeat(left.column("n").to_numpy()[:points], width), pa.int64()),
            "total": pa.array(total.ravel(), pa.float64()),
            "size": pa.array(np.tile(weights.sum(axis=0), points).astype(np.int64), pa.int64()),
        })

    return work


def silhouettes(points: DataFrame, vector: str, labels: Sequence[str], tile_rows: int | None = None) -> DataFrame:
    """Mean silhouette with Euclidean distances of several labellings of the same points: (labels, silhouette).

    Exact for any number of points. Points equal in all columns count once with a weight. Every two tiles of points meet in a
    task, once for all labellings; sums of distances per (point, group) are added up. The work grows with the square
    of the distinct points: for many, :func:`squared_silhouette` is linear.
    """
    known = _labelled(points, vector, *labels)
    rows = numbered(known.groupBy(*known.columns).agg(F.count(F.lit(1)).alias("n")))
    tiles = tile_count(rows, "v", tile_rows)
    parts = over_tile_pairs(
        rows, rows, tiles, tiles, _label_sums(len(labels)),
        "id long, which int, label string, own boolean, n long, total double, size long")
    groups = parts.groupBy("id", "which", "label").agg(
        F.max("own").alias("own"), F.max("n").alias("n"), F.sum("total").alias("total"), F.sum("size").alias("size"))
    own = F.col("own")
    each = groups.groupBy("id", "which").agg(
        F.max("n").alias("n"), F.max(F.when(own, F.col("size"))).alias("size"),
        F.max(F.when(own, F.try_divide(F.col("total"), F.col("size") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"),
    )
    score = _silhouette_value(F.col("a"), F.col("b"), F.col("size"))
    means = each.groupBy("which").agg((F.sum(score * F.col("n")) / F.sum("n")).alias("silhouette"))
    return means.select(F.get(F.lit(list(labels)), F.col("which")).alias("labels"), "silhouette")


def silhouette(points: DataFrame, vector: str, label: str, tile_rows: int | None = None) -> DataFrame:
    """Mean silhouette of one labelling; null without points."""
    return silhouettes(points, vector, [label], tile_rows).agg(F.max("silhouette").alias("silhouette"))


def group_moments(points: DataFrame, vector: str, label: str) -> DataFrame:
    """Per group, as (label, n, s, q): size, sum vector and sum of squared norms, combined before the shuffle."""
    rows = _labelled(points, vector, label).select(F.col("label0").alias("label"), array_to_vector("v").alias("v"))
    summary = rows.groupBy("label").agg(Summarizer.metrics("count", "sum", "normL2").summary(F.col("v")).alias("m"))
    squares = F.aggregate(vector_to_array("m.normL2"), F.lit(0.0), lambda acc, x: acc + x * x)
    return summary.select("label", F.col("m.count").alias("n"), vector_to_array("m.sum").alias("s"), squares.alias("q"))


def _group_distances(left: pa.Table, right: pa.Table) -> pa.Table:
    """Per point of the left tile: total to its own group, if that is in the right tile, and the least mean to another."""
    x, s = vectors_of(left, "v"), vectors_of(right, "s")
    n, q = right.column("n").to_numpy().astype(float), right.column("q").to_numpy()
    if not len(x) or not len(s):
        return pa.table({"id": pa.array([], pa.int64()), "total": pa.array([], pa.float64()), "size": pa.array([], pa.int64()), "b": pa.array([], pa.float64())})
    total = np.outer((x * x).sum(axis=1), n) - 2 * x @ s.T + q
    names = {name: i for i, name in enumerate(right.column("label").to_pylist())}
    own = np.array([names.get(name, -1) for name in left.column("label").to_pylist()])
    mean, here = total / n, np.flatnonzero(own >= 0)
    mean[here, own[here]] = np.inf
    best = mean.min(axis=1)
    at = np.maximum(own, 0)
    return pa.table({
        "id": left.column("id"), "total": pa.array(total[np.arange(len(x)), at], pa.float64(), mask=own < 0),
        "size": pa.array(n[at].astype(np.int64), pa.int64(), mask=own < 0), "b": pa.array(best, pa.float64(), mask=~np.isfinite(best)),
    })


def squared_silhouette(points: DataFrame, vector: str, label: str, tile_rows: int | None = None) -> DataFrame:
    """Mean silhouette with squared Euclidean distances, linear in the number of points, for any number of groups.

    The mean squared distance to a group follows from its size, sum and squared norms: |x|^2 - 2 x.s/n + q/n.
    """
    rows = numbered(_labelled(points, vector, label).withColumnRenamed("label0", "label"))
    groups = numbered(group_moments(rows, "v", "label"))
    parts = over_tile_pairs(
        rows, groups, tile_count(rows, "v", tile_rows), tile_count(groups, "s", tile_rows), _group_distances,
        "id long, total double, size long, b double")
    each = parts.groupBy("id").agg(F.max("total").alias("total"), F.max("size").alias("size"), F.min("b").alias("b"))
    a = F.try_divide(F.col("total"), F.col("size") - 1)
    return each.agg(F.avg(_silhouette_value(a, F.col("b"), F.col("size"))).alias("silhouette"))


# ---- dispersion ----------------------------------------------------------------------------------------------------------
def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def _distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x))


def _worst_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    """Per group of the left tile, the worst ratio of spread to centre distance with a group of the right tile."""
    x, y = vectors_of(left, "c"), vectors_of(right, "c")
    if not len(x) or not len(y):
        return pa.table({"id": pa.array([], pa.int64()), "worst": pa.array([], pa.float64())})
    gap = np.sqrt(squared_distances(x, y))
    spread = np.add.outer(left.column("spread").to_numpy(), right.column("spread").to_numpy())
    apart = np.not_equal.outer(left.column("id").to_numpy(), right.column("id").to_numpy()) & (gap > 0)
    ratio = np.where(apart, spread / np.where(apart, gap, 1), -np.inf).max(axis=1)
    return pa.table({"id": left.column("id"), "worst": pa.array(ratio, pa.float64(), mask=~np.isfinite(ratio))})


def dispersion_scores(points: DataFrame, vector: str, label: str, tile_rows: int | None = None) -> DataFrame:
    """Calinski-Harabasz and Davies-Bouldin of a fixed assignment, for any number of groups."""
    centre = F.transform("s", lambda x: x / F.col("n"))
    groups = numbered(group_moments(points, vector, label).withColumn("c", centre))
    totals = groups.groupBy(F.lit("all")).agg(  # by a constant: no groups give no row
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("points"), F.sum("q").alias("q"), F.sum(_dot(F.col("s"), F.col("s")) / F.col("n")).alias("kept"),
        vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("grand"),
    )
    between = F.col("kept") - _dot(F.col("grand"), F.col("grand")) / F.col("points")
    within = F.col("q") - F.col("kept")
    calinski = F.try_divide(between * (F.col("points") - F.col("k")), within * (F.col("k") - 1))

    # mean distance to the own centre needs one more pass over the points
    to_own = _labelled(points, vector, label).withColumnRenamed("label0", "label").join(groups.select("label", "c"), "label")
    spread = to_own.groupBy("label").agg(F.avg(_distance(F.col("v"), F.col("c"))).alias("spread"))
    scattered = numbered(groups.select("label", "c").join(spread, "label"))
    tiles = tile_count(scattered, "c", tile_rows)
    worst = over_tile_pairs(scattered, scattered, tiles, tiles, _worst_pairs, "id long, worst double")
    davies = worst.groupBy("id").agg(F.max("worst").alias("worst")).agg(F.avg("worst").alias("davies_bouldin")).scalar()
    return totals.agg(F.max(calinski).alias("calinski_harabasz"), davies.alias("davies_bouldin"))


def project2(points: DataFrame, vector: str, keys: Sequence[str]) -> DataFrame:
    """Centred projection on the two main axes; on each, the point farthest from the centre has a positive place.

    Of equally far points the one whose keys come last decides.
    """
    vectors = points.select(*keys, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("features"))
    scaler = StandardScaler(inputCol="features", outputCol="__c", withMean=True, withStd=False)
    centred = scaler.fit(vectors).transform(vectors)
    projected = PCA(k=2, inputCol="__c", outputCol="__p").fit(centred).transform(centred)
    xy = vector_to_array("__p")
    placed = projected.select(*keys, xy[0].alias("pc1"), xy[1].alias("pc2"))
    far = lambda c: F.signum(F.max_by(c, F.struct(F.round(F.abs(c), 9), *keys)))
    one, two = placed.agg(far("pc1"), far("pc2")).first() or (1.0, 1.0)
    return placed.withColumns({"pc1": F.col("pc1") * F.lit(one or 1.0), "pc2": F.col("pc2") * F.lit(two or 1.0)})


def mean_vectors(items: DataFrame, group: str, vector: str) -> DataFrame:
    """Element-wise mean per group, back as an array; one combined vector per group and task travels."""
    rows = items.select(group, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("v"))
    return rows.groupBy(group).agg(vector_to_array(Summarizer.mean(F.col("v"))).alias(vector))


def members(assigned: DataFrame, cluster: str, item: str, separator: str = ",") -> DataFrame:
    """Sorted member list per cluster of a one-row-per-item table such as the sites."""
    listed = F.array_join(F.array_sort(F.collect_set(item)), separator)
    return assigned.groupBy(cluster).agg(listed.alias("members"), F.count_distinct(item).alias("size"))
