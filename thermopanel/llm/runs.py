"""Periodic runs of words, found by recursive frequency splitting and a lag scan.

A run is a stretch of words with smallest period q, at least max(6, 4 q) long, that no neighbouring word extends. So each
of its words occurs four times in it at least (six times where only q = 1 has room), and a word that occurs less often in its
segment is in no run: the segment is split there. The pieces have fewer occurrences each, so they are counted and
split again until nothing changes; what survives is little more than the runs themselves.

Surviving segments are scanned lag by lag. The lags from l to 2 l - 1, l a power of two, are tried at every 2 l-th word
only: a run with such a lag repeats l words at one of these places. So a scale compares half as many blocks as the segment
has words, and a segment of n words costs n log n. Where a block recurs, the words themselves are compared
to both sides. Blocks inside a run of a smaller scale are skipped: by Fine and Wilf's theorem their lag is no smallest period.

Words are compared by 64-bit hashes, of which two different words share one with a chance of 2**-64.

Defined cases: a null text counts as empty, has no words and no runs, and collapses to the empty text; very long texts and
texts of one repeated word cost n log n like any other; repeated rows are worked on one by one; a null id counts as the empty
text where the edit hashes it; no rows give no rows; other columns are ignored, and kept by ``collapse``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from thermopanel.llm.common import Texts, finished, mixed, per_text, released, slices, small_batches, texts_column

#: Least words of a run, and least number of periods.
LEAST, PERIODS = 6, 4
#: Comparisons of blocks held at once.
HELD = 1 << 20
#: From this many words on a segment has room for a period of 2.
ROOM = 2 * PERIODS

Edit = Callable[[object, int], tuple[int, int] | None]


def planted(doc_id, n: int) -> tuple[int, int] | None:
    """The edit of every tenth document by hash: from word a on, the words repeat with period p. (a, p), or None."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def word_order(ids: list, bounds: np.ndarray, edit: Edit | None) -> tuple[np.ndarray, set[int]]:
    """For each word place of the slice the place its word comes from, and the texts that an edit changes."""
    order, changed = np.arange(bounds[-1]), set()
    for i, doc_id in enumerate(ids) if edit else ():
        first, n = int(bounds[i]), int(bounds[i + 1] - bounds[i])
        if found := edit(doc_id, n):
            a, p = found
            order[first + a:first + n] = first + a + np.arange(n - a) % p
            changed.add(i)
    return order, changed


def surviving(words: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places left when every word too rare for its segment has split it, again and again; and their segments' numbers."""
    at, segment, done = np.arange(len(words)), owners, []
    while len(at):
        _, segment, size = np.unique(segment, return_inverse=True, return_counts=True)
        # of equal (segment, word) pairs, the number of occurrences
        by = np.lexsort((words[at], segment))
        new = np.ones(len(at), bool)
        new[1:] = (words[at][by][1:] != words[at][by][:-1]) | (segment[by][1:] != segment[by][:-1])
        group = np.cumsum(new) - 1
        often = np.empty(len(at), np.int64)
        often[by] = np.bincount(group)[group]
        room = size[segment]
        keep = (room >= LEAST) & (often >= np.where(room < ROOM, LEAST, PERIODS))
        whole = np.bincount(segment, keep, len(size)) == size
        done.append(at[whole[segment]])
        rest = keep & ~whole[segment]
        at, old = at[rest], segment[rest]
        cut = np.ones(len(at), bool)
        cut[1:] = (np.diff(at) > 1) | (np.diff(old) != 0)
        segment = np.cumsum(cut)
    at = np.sort(np.concatenate(done)) if done else at
    cut = np.ones(len(at), bool)
    cut[1:] = (np.diff(at) > 1) | (owners[at][1:] != owners[at][:-1])
    return at, np.cumsum(cut) - 1


def stretch(x: np.ndarray, at: int, q: int, first: int, last: int) -> tuple[int, int]:
    """The longest [s, e) around ``at`` in [first, last) whose words recur q places on, e included up to the last of them."""
    left, right, step = at, at, 64
    while left > first:
        low = max(first, left - step)
        differ = np.flatnonzero(x[low:left] != x[low + q:left + q])
        if len(differ):
            left = low + int(differ[-1]) + 1
            break
        left, step = low, 2 * step
    step = 64
    while right + q < last:
        high = min(last - q, right + step)
        differ = np.flatnonzero(x[right:high] != x[right + q:high + q])
        if len(differ):
            right += int(differ[0])
            break
        right, step = high, 2 * step
    return left, right + q


def primes(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def lag_scan(x: np.ndarray, segment: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, as places in ``x``; segments are stretches of equal, rising numbers."""
    runs: list[tuple[int, int, int]] = []
    if not len(x):
        return runs
    firsts = np.flatnonzero(np.diff(segment, prepend=-1))
    sizes = np.diff(np.append(firsts, len(x)))
    block, covered = finished(x.copy()), np.zeros(len(x), np.int64)
    size = 1
    while (room := sizes >= max(LEAST, PERIODS * size)).any():
        counts = (sizes[room] - 2 * size) // (2 * size) + 1
        ends = np.cumsum(counts)
        anchors = (np.arange(ends[-1]) - np.repeat(ends - counts, counts)) * 2 * size + np.repeat(firsts[room], counts)
        lasts = np.repeat((firsts + sizes)[room], counts)
        longest = np.repeat(sizes[room] // PERIODS, counts)
        lags, some = np.arange(size, 2 * size), []
        for k in range(0, len(anchors), step := max(1, HELD // size)):
            a, last = anchors[k:k + step, None], lasts[k:k + step, None]
            there = a + lags
            fits = (there + size <= last) & (lags <= longest[k:k + step, None])
            same = fits & (block[np.minimum(there, len(block) - 1)] == block[a]) & (covered[a] < there + size)
            row, column = np.nonzero(same)
            some.append(np.column_stack([lags[column], anchors[k + row], lasts[k + row], np.repeat(firsts[room], counts)[k + row]]))
        found = np.concatenate(some)
        found = found[np.lexsort((found[:, 1], found[:, 0]))]
        at, fresh = 0, set()
        while at < len(found):
            q, a, last, first = (int(v) for v in found[at])
            s, e = stretch(x, a, q, first, last)
            if e - s >= max(LEAST, PERIODS * q) and not any((x[s:s + q] == x[s + q // p:s + q + q // p]).all() for p in primes(q)):
                fresh.add((s, e - s, q))
            same_lag = int(np.searchsorted(found[:, 0], q, side="right"))
            at = max(at + 1, at + int(np.searchsorted(found[at:same_lag, 1], e - q)))
        for s, length, _ in fresh:
            covered[s:s + length] = np.maximum(covered[s:s + length], s + length)
        runs += sorted(fresh)
        if size < len(block):
            block = mixed(block[:-size], block[size:])
        size *= 2
    return runs


class Scanned:
    """The words of a slice, after the edit, and their runs by text: (start, length, period), in this order."""

    def __init__(self, column: Texts, ids: list, edit: Edit | None = None):
        self.bounds = column.bounds
        self.order, self.changed = word_order(ids, self.bounds, edit)
        words = column.hashes()[self.order]
        at, segment = surviving(words, column.owners)
        self.runs: list[list[tuple[int, int, int]]] = [[] for _ in ids]
        for s, length, q in lag_scan(words[at], segment):
            place = int(at[s])
            i = int(np.searchsorted(self.bounds, place, side="right")) - 1
            self.runs[i].append((place - int(self.bounds[i]), length, q))
        for found in self.runs:
            found.sort(key=lambda r: (r[0], r[2]))

    def collapsed(self, i: int, text: bytes) -> bytes:
        """The words of text i that no run repeats, joined by one space."""
        words = text.split()
        if i in self.changed:
            words = [words[k] for k in (self.order[self.bounds[i]:self.bounds[i + 1]] - self.bounds[i]).tolist()]
        if self.runs[i]:
            edges = np.zeros(len(words) + 1, np.int64)
            for s, length, q in self.runs[i]:
                edges[s + q] += 1
                edges[s + length] -= 1
            words = [words[k] for k in np.flatnonzero(np.cumsum(edges)[:-1] == 0).tolist()]
        return b" ".join(words)


def scanned(batch: pa.RecordBatch, edit: Edit | None = None) -> tuple[Scanned, list[bytes]]:
    texts = batch.column(batch.schema.get_field_index("text")).cast(pa.string())
    ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
    return Scanned(texts_column(batch), ids, edit), [(t or "").encode() for t in texts.to_pylist()]


def longest_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    return min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)


FIELDS = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def digest_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """Per document: doc_id, number of runs, the longest one, digests of all runs and of the collapsed text."""

    def work():
        def step(batch):
            found, texts = scanned(batch, edit)
            best = [longest_run(r) for r in found.runs]
            listed = ["".join(f"{s},{n},{q}\n" for s, n, q in r) for r in found.runs]
            return {
                "n_runs": [len(r) for r in found.runs],
                "start": [b and b[0] for b in best], "length": [b and b[1] for b in best], "period": [b and b[2] for b in best],
                "exponent_milli": [b and 1000 * b[1] // b[2] for b in best],
                "runs_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in listed],
                "collapsed_sha256": [hashlib.sha256(found.collapsed(i, t)).hexdigest() for i, t in enumerate(texts)],
            }
        return step

    return per_text(docs, "doc_id long", FIELDS, work)


def find_runs(docs: DataFrame) -> DataFrame:
    """One row per run: doc_id, start, length, period (in words), and the words of one period."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("unit", pa.string())])

    def run(batches):
        for batch in slices(batches):
            found, texts = scanned(batch)
            ids, out = batch.column(0).to_pylist(), []
            for doc_id, runs, text in zip(ids, found.runs, texts):
                words = text.split() if runs else []
                out += [(doc_id, s, n, q, b" ".join(words[s:s + q]).decode()) for s, n, q in runs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 5, schema)], schema=schema)

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        released(run), "doc_id long, start long, length long, period long, unit string")


def collapse(docs: DataFrame) -> DataFrame:
    """The documents with every run cut to its first period; a text without runs stays as it is, null included."""

    def run(batches):
        for batch in slices(batches):
            found, texts = scanned(batch)
            at = batch.schema.get_field_index("text")
            old = batch.column(at).to_pylist()
            new = [found.collapsed(i, t).decode() if found.runs[i] else old[i] for i, t in enumerate(texts)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(released(run), docs.schema)
