"""k-means by Lloyd's steps, for several numbers of groups and several starts in the same passes.

Each pass reads the points once: a task assigns its points to the nearest centre of every run and hands on one row per
run and group with count, sum and cost. The centres are k x dimension numbers per run and travel with the task.

Starts are written out, not drawn inside a pass: start s takes the points whose hash of (seed + s, key) is least, so
every engine that can hash finds the same ones. Ties go to the group with the smaller number; a group without points keeps its
centre.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermopanel.operators.tiles import squared_distances, vectors_of

SEED, STARTS, MAX_STEPS, TOLERANCE = 42, 10, 300, 1e-9


@dataclass(frozen=True)
class Run:
    k: int
    start: int
    centres: np.ndarray
    cost: float = np.inf


def written_starts(points: DataFrame, key: str, vector: str, ks: Sequence[int], starts: int = STARTS, seed: int = SEED) -> list[Run]:
    """The centres every run begins with; at most the largest k rows per start come to the driver."""
    runs = []
    for s in range(starts):
        mark = F.md5(F.concat_ws("|", F.lit(str(seed + s)), F.col(key).cast("string")))
        first = points.select(vector).orderBy(mark, F.col(key)).limit(max(ks)).collect()
        runs += [Run(k, s, np.array([r[0] for r in first[:k]], float)) for k in ks if len(first) >= k]
    return runs


def _pass(points: DataFrame, vector: str, runs: Sequence[Run]) -> dict[tuple[int, int], tuple[int, float, np.ndarray]]:
    """(run, group): number of points, cost and sum of the points nearest to the group's centre."""
    centres = [r.centres for r in runs]

    def work(batches):
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            x = vectors_of(pa.Table.from_batches([batch]), vector)
            for r, c in enumerate(centres if len(x) else ()):
                d = squared_distances(x, c)
                nearest = d.argmin(axis=1)
                for g in np.unique(nearest):
                    own = nearest == g
                    n, cost, total = held.get((r, g), (0, 0.0, 0.0))
                    held[r, g] = [n + int(own.sum()), cost + float(d[own, g].sum()), total + x[own].sum(axis=0)]
        keys = list(held)
        yield pa.RecordBatch.from_arrays([
            pa.array([r for r, _ in keys], pa.int32()), pa.array([int(g) for _, g in keys], pa.int32()),
            pa.array([held[k][0] for k in keys], pa.int64()), pa.array([held[k][1] for k in keys], pa.float64()),
            pa.array([held[k][2].tolist() for k in keys], pa.list_(pa.float64())),
        ], names=["run", "cluster", "n", "cost", "total"])

    parts = points.select(vector).mapInArrow(work, "run int, cluster int, n long, cost double, total array<double>")
    sums = parts.groupBy("run", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), Summarizer.sum(array_to_vector("total")).alias("total"))
    rows = sums.select("run", "cluster", "n", "cost", vector_to_array("total").alias("total")).collect()
    return {(r["run"], r["cluster"]): (r["n"], r["cost"], np.array(r["total"])) for r in rows}


def fit(
    points: DataFrame, key: str, vector: str, ks: Sequence[int], starts: int = STARTS, seed: int = SEED, max_steps: int = MAX_STEPS,
) -> dict[int, Run]:
    """The cheapest run for each k. Write the points out first: they are read once per step."""
    runs = written_starts(points, key, vector, ks, starts, seed)
    moving, done = runs, []
    for step in range(max_steps + 1):
        found = _pass(points, vector, moving) if moving else {}
        left = []
        for i, run in enumerate(moving):
            own = {g: found[i, g] for g in range(run.k) if (i, g) in found}
            cost = sum(c for _, c, _ in own.values())
            centres = run.centres.copy()
            for g, (n, _, total) in own.items():
                centres[g] = total / n
            still = np.abs(centres - run.centres).max(initial=0) <= TOLERANCE * max(1.0, np.abs(centres).max(initial=0))
            if still or step == max_steps:
                done.append(Run(run.k, run.start, run.centres, cost))
            else:
                left.append(Run(run.k, run.start, centres))
        moving = left
    return {k: min((r for r in done if r.k == k), key=lambda r: (round(r.cost, 6), r.start)) for k in {r.k for r in done}}


def assign(points: DataFrame, vector: str, runs: dict[int, Run], name: str = "cluster_of") -> DataFrame:
    """The points with one more column per k, ``name`` followed by k: the number of the nearest centre."""
    ks = sorted(runs)
    columns = [f"{name}{k}" for k in ks]
    centres = [runs[k].centres for k in ks]

    def work(batches):
        for batch in batches:
            x = vectors_of(pa.Table.from_batches([batch]), vector)
            for column, c in zip(columns, centres):
                batch = batch.append_column(column, pa.array(squared_distances(x, c).argmin(axis=1) if len(x) else [], pa.int32()))
            yield batch

    schema = T.StructType([*points.schema.fields, *[T.StructField(column, T.IntegerType()) for column in columns]])
    return points.mapInArrow(work, schema)
