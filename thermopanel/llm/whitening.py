"""Embedding whitening with leading eigenvalues found by slicing the spectrum.

The covariance of all vectors is summed on the executors; what reaches the driver is its dimension x dimension numbers,
whatever the number of vectors. There ``leading`` finds the largest eigenvalues without a full decomposition: Sylvester's
law says that LDL' of the covariance minus a shift has as many negative pivots as there are eigenvalues below the shift, so
counting pivots and halving intervals isolates the k-th one. Rayleigh quotient iteration then converges cubically from within
the interval, and two more counts, just below and above the result, certify that it is number k.

Entries c become integers ``floor(scale * c) + shift``, so that counts, sums and deviations are exact.

Defined cases: rows whose vector is null, or holds a null, a NaN, an infinity or an entry of 2**40 / scale or more in size,
are left out of the fit and of the result. Of vectors of different lengths the most frequent length counts (ties: the longer
one), the others are left out too. Equal vectors, repeated and null ids are rows like any other. Directions without variance
have no component, so a table with fewer than eight has fewer rows per vector, and equal vectors or an empty table have none.
``deviation`` is null where it does not fit a long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from thermopanel.llm.common import rows, small_batches

#: Sizes of entries from here on are not taken as numbers.
LARGEST = float(1 << 40)
EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Scale:
    """How entries become integers."""

    scale: float = 1024.0
    shift: int = 100_000


@dataclass(frozen=True)
class Whitening:
    """``values`` fall; ``axes`` has a unit eigenvector per column; ``certified`` says which numbers the counts confirm."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    axes: np.ndarray
    trace: float
    certified: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x minus the mean, with the whole part of the mean taken off in integers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole) - rest

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes / np.sqrt(self.values)


def integers(column: pa.Array, scale: Scale) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors: the rows that hold usable ones, and their integers."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False) * scale.scale
    sizes = np.maximum(lengths, 0)
    ends = np.cumsum(sizes)
    usable = np.isfinite(flat)
    usable[usable] = np.abs(flat[usable]) < LARGEST
    bad = np.concatenate(([0], np.cumsum(~usable)))
    whole = (lengths > 0) & (bad[ends] == bad[ends - sizes])
    for d in np.unique(lengths[whole]):
        at = np.flatnonzero(whole & (lengths == d))
        places = (ends - sizes)[at][:, None] + np.arange(d)
        yield at, np.floor(flat[places]).astype(np.int64) + scale.shift


def matrix(batch: pa.RecordBatch, d: int, scale: Scale, vector: str) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a batch with usable vectors of d entries, and these."""
    for at, x in integers(batch.column(batch.schema.get_field_index(vector)), scale):
        if x.shape[1] == d:
            return at, x
    return np.zeros(0, np.int64), np.zeros((0, d), np.int64)


def totals(df: DataFrame, vector: str, scale: Scale) -> tuple[int, list[int]]:
    """Number of vectors of the most frequent length, and their sums per entry, exactly."""

    def run(batches):
        held: dict[int, list] = {}

        def told(d):
            n, sums = held.pop(d)
            yield rows("size int, pos int, n long, total long", [d] * d, range(d), [n] * d, sums)

        for batch in batches:
            for at, x in integers(batch.column(0), scale):
                d = x.shape[1]
                n, sums = held.get(d, (0, 0))
                held[d] = [n + len(at), sums + x.sum(axis=0)]
                if held[d][0] > 1 << 20:  # 2**20 entries below 2**41 still fit a long
                    yield from told(d)
        for d in list(held):
            yield from told(d)

    parts = df.select(vector).mapInArrow(run, "size int, pos int, n long, total long")
    whole = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found = parts.groupBy("size", "pos").agg(F.sum("n").alias("n"), whole).orderBy("pos").collect()
    if not found:
        return 0, []
    _, d = max((r["n"], r["size"]) for r in found)
    own = [r for r in found if r["size"] == d]
    return own[0]["n"], [int(r["total"]) for r in own]


def moments(df: DataFrame, vector: str, d: int, scale: Scale, values) -> np.ndarray:
    """The mean of v v' over all vectors, v = values(x); each task hands on one sum per pair of entries."""

    def run(batches):
        n, total = 0, 0.0
        for batch in batches:
            at, x = matrix(batch, d, scale, vector)
            v = values(x)
            n, total = n + len(at), total + v.T @ v
        if n:
            i, j = np.triu_indices(len(total))
            yield rows("i int, j int, n long, total double", i, j, np.full(len(i), n), total[i, j])

    parts = df.select(vector).mapInArrow(run, "i int, j int, n long, total double")
    found = parts.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    size = max(r["j"] for r in found) + 1
    out = np.zeros((size, size))
    for r in found:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["total"] / r["n"]
    return out


# ---- eigenvalues of a symmetric matrix ----------------------------------------------------------------------------
def below(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie below the shift: negative pivots of LDL' with 1 x 1 and 2 x 2 pivots."""
    m, count, bound = a - shift * np.eye(len(a)), 0, (1 + 17 ** 0.5) / 8

    def swap(i, j):
        if i != j:
            m[[i, j]] = m[[j, i]]
            m[:, [i, j]] = m[:, [j, i]]

    k = 0
    while k < len(m):
        own, column = abs(m[k, k]), np.abs(m[k + 1:, k])
        most = column.max(initial=0.0)
        two = False
        if own < bound * most:
            r = k + 1 + int(column.argmax())
            beside = np.abs(m[r, k:])
            beside[r - k] = 0
            widest = beside.max()
            if own * widest < bound * most * most:
                two = abs(m[r, r]) < bound * widest
                swap(k + 1 if two else k, r)
        if two:
            pivot, c = m[k:k + 2, k:k + 2], m[k + 2:, k:k + 2].copy()
            det = pivot[0, 0] * pivot[1, 1] - pivot[0, 1] * pivot[1, 0]
            count += 1 if det < 0 else 2 * bool(pivot[0, 0] < 0)
            inverse = np.array([[pivot[1, 1], -pivot[0, 1]], [-pivot[1, 0], pivot[0, 0]]]) / det
            m[k + 2:, k + 2:] -= c @ inverse @ c.T
            k += 2
        else:
            if m[k, k]:
                c = m[k + 1:, k].copy()
                count += bool(m[k, k] < 0)
                m[k + 1:, k + 1:] -= np.outer(c, c) / m[k, k]
            k += 1
    return count


def leading(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest positive eigenvalues, falling, their unit eigenvectors as columns, and which of them are certified."""
    d = len(a)
    reach = float(np.abs(a).sum(axis=1).max(initial=0.0))  # no eigenvalue is larger
    fine = 4 * d * EPS * reach
    counts = {2 * reach: 0}

    def above(s: float) -> int:
        if s not in counts:
            counts[s] = d - below(a, s)
        return counts[s]

    def confirmed(value: float, k: int) -> bool:
        """The k-th eigenvalue is this one, but for rounding."""
        return above(value - 2 * fine) >= k > above(value + 2 * fine)

    wanted = min(most, above(fine)) if reach else 0
    values, axes, sure = np.zeros(wanted), np.zeros((d, wanted)), np.zeros(wanted, bool)
    rng = np.random.default_rng(0)
    for k in range(1, wanted + 1):
        found = axes[:, :k - 1]
        low = max((s for s, c in counts.items() if c >= k))
        high = min(s for s, c in counts.items() if c < k)

        def halved(low, high):
            middle = (low + high) / 2
            return (middle, high) if above(middle) >= k else (low, middle)

        def unit(v):
            for _ in range(2):
                v = v - found @ (found.T @ v)
            return v / np.linalg.norm(v)

        def solved(shift, v):
            try:
                return unit(np.linalg.solve(a - shift * np.eye(d), v))
            except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
                return unit(np.linalg.solve(a - (shift + fine) * np.eye(d), v))

        while above(low) - above(high) > 1 and high - low > fine:
            low, high = halved(low, high)
        while True:
            v = unit(rng.standard_normal(d))
            for _ in range(2):
                v = solved((low + high) / 2, v)
            value, best = v @ a @ v, np.inf
            while low - fine <= value <= high + fine:
                error = float(np.linalg.norm(a @ v - value * v))
                if error >= best / 2:  # cubic convergence has reached rounding
                    break
                best, kept = error, (value, v)
                v = solved(value, v)
                value = v @ a @ v
            if best < np.inf and confirmed(kept[0], k) or high - low <= fine:
                break
            low, high = halved(low, high)
        value, v = kept if best < np.inf else (value, v)
        value = min(max(value, low - fine), high + fine)
        values[k - 1], axes[:, k - 1], sure[k - 1] = value, v * np.sign(v[np.abs(v).argmax()]), confirmed(value, k)
    return values, axes, sure


# ---- the operator --------------------------------------------------------------------------------------------------
def fit(df: DataFrame, components: int = 8, vector: str = "embedding", scale: Scale = Scale()) -> Whitening | None:
    """Mean and leading eigenpairs of the covariance (divisor n) of all usable vectors; None without any."""
    small_batches(df.sparkSession)
    n, sums = totals(df, vector, scale)
    if not n:
        return None
    d = len(sums)
    start = Whitening(n, tuple(sums), np.ones(d), np.eye(d), 0.0, np.ones(d, bool))
    covariance = moments(df, vector, d, scale, start.centred)
    values, axes, sure = leading(covariance, components)
    return Whitening(n, tuple(sums), values, axes, float(np.trace(covariance)), sure)


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding", scale: Scale = Scale()) -> float:
    """Largest entry, in size, of the whitened vectors' covariance minus the identity, measured over all of them."""
    found = moments(df, vector, len(model.sums), scale, lambda x: np.column_stack([model.project(x), np.ones(len(x))]))
    mean = found[:-1, -1]
    return float(np.abs(found[:-1, :-1] - np.outer(mean, mean) - np.eye(len(mean))).max())


def deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over the entries of (n x - sum)**2; null where it exceeds a long. Integers wrap, so what fits one is exact."""
    wrapped = np.array([(s + (1 << 63)) % (1 << 64) - (1 << 63) for s in model.sums], np.int64)
    with np.errstate(over="ignore"):
        gaps = x * np.int64(model.n) - wrapped
        exact = (gaps * gaps).sum(axis=1)
    about = (model.centred(x) ** 2).sum(axis=1) * float(model.n) ** 2
    fits = about < 2.0 ** 62
    out = [int(e) if f else None for e, f in zip(exact, fits)]
    for i in np.flatnonzero(~fits & (about < 2.0 ** 64)):
        whole = sum((int(v) * model.n - s) ** 2 for v, s in zip(x[i], model.sums))
        out[i] = whole if whole < 1 << 63 else None
    return out


FIELDS = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, certified boolean"
)


def whiten(df: DataFrame, components: int = 8, vector: str = "embedding", key: str = "vec_id", scale: Scale = Scale()) -> DataFrame:
    """One row per usable vector and component: ``FIELDS``, of which the key keeps its own name."""
    fields = FIELDS.replace("vec_id", key, 1)
    model = fit(df, components, vector, scale)
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], fields)
    error = identity_error(df, model, vector, scale)
    m, shares = len(model.values), model.values / model.trace

    def run(batches):
        for batch in batches:
            at, x = matrix(batch, len(model.sums), scale, vector)
            ids = batch.column(batch.schema.get_field_index(key)).cast(pa.int64())
            size = len(at) * m
            yield rows(
                fields, ids.take(pa.array(np.repeat(at, m))), np.tile(np.arange(1, m + 1), len(at)), np.full(size, model.n),
                pa.array(deviations(x, model), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), m))),
                model.project(x).ravel(), np.tile(shares, len(at)), np.full(size, error), np.tile(model.certified, len(at)),
            )

    return df.select(key, vector).mapInArrow(run, fields)
