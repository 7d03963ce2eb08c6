"""LM scoring by a gated recurrent network with a class-factored softmax.

Words of the training documents are counted over the whole corpus. The most frequent ones, the mark for all other
words, and the end mark are the network's tokens; frequent tokens sit in small classes, and
p(token) = p(class | state) p(token | class, state). A word outside the vocabulary has the probability of the mark
times its add-one share among such words, so every text has a proper probability. The vocabulary grows with the cube
root of the counted tokens (``vocabulary_size``: 5,000 words for 4 million tokens, 55,000 for 5 billion, 800,000 for
16 trillion), the classes with the root of the vocabulary.

Training is truncated backpropagation through time in numpy, over windows of ``WINDOW`` steps with the state carried
from window to window; documents of more than ``STRETCH`` tokens are trained on as stretches that begin with a state of
zero. Steps after the end of a lane are masked. A first model is trained on a bounded sample; from it, shards train on
all training documents, each on its share, and their weights are averaged by the tokens seen, in two levels. A row's
shard and its place there come from a hash of its id and text, so the result does not depend on how rows lie in
files; the number of shards grows with the root of the counted tokens. The output biases start at the unigram
distribution.

Scoring reads whole documents, in lanes that are laid end to end and go on from slice to slice, the state carried across
windows and set to zero where a document begins; the result is the base-10 log-likelihood of the complete document.

Counts go by 64-bit hashes of words (equal for two words with a chance of 2**-64). The counts of the most frequent words
(``HEAD``, or eight times the vocabulary) travel with the tasks; the rest are joined by word, none of which is frequent.

Defined cases: a null or empty text is its end mark alone; without training documents N and V are 0, every word is
unknown and the score is that of an untrained network; repeated rows are scored one by one, null ids belong to
training; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from thermopanel.llm.common import Texts, arrow_schema, ragged, released, remainder, remainder_column, rows, slices, staged

HIDDEN = 16
HEAD = 1 << 16
WINDOW, LANES, SCORED_LANES = 32, 256, 512
STRETCH = 1024
#: Positions whose output is computed at once in scoring.
SCORED_AT_ONCE = 1 << 15
#: Entries of a softmax made at once: they fit into a core's cache.
SOFTMAX_AT_ONCE = 1 << 16
#: Bytes of texts begun or not yet scored, and of their rows, that a task of scoring keeps.
WAITING_BYTES = 48 << 20
#: Documents of the first model's sample, on average; shards added up in one task; weights in one row.
SAMPLE, ADDED, PIECE = 2_000, 32, 1 << 16
RATE = 0.05
FOLDS, HELD_OUT = 7, 2
END, OTHER = 0, 1         # token numbers; vocabulary words follow


def vocabulary_size(n_tokens: int) -> int:
    """Words that the network knows."""
    return int(32 * max(n_tokens, 1) ** (1 / 3))


def shard_count(n_tokens: int) -> int:
    """Shards of the training documents: a few for a small corpus, so that each sees enough of it."""
    return max(1, math.ceil(math.sqrt(n_tokens / (1 << 19))))


def count_words(docs: DataFrame) -> DataFrame:
    """word (hash), c over all texts; each task adds up its own first."""
    schema = "word long, c long"

    def count(batches):
        found, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in slices(batches):
            once, n = np.unique(Texts(batch.column(0)).hashes(lower=True), return_counts=True)
            found, inverse = np.unique(np.concatenate([found, once]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([counts, n]), len(found)).astype(np.int64)
            if len(found) > 1_000_000:
                yield rows(schema, found.view(np.int64), counts)
                found, counts = found[:0], counts[:0]
        if len(found):
            yield rows(schema, found.view(np.int64), counts)

    return docs.select("text").mapInArrow(released(count), schema).groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Words:
    """The most frequent words (sorted hashes), their counts and token numbers, and totals."""

    hashes: np.ndarray
    counts: np.ndarray
    tokens: np.ndarray
    n: int                    # training tokens, ends included
    v: int                    # distinct ones, the end included
    ends: int
    outside: int              # tokens and distinct words outside the vocabulary
    outside_distinct: int
    token_counts: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each word, -1 if it is not among the most frequent; hashes are spread evenly, so their leading bits
        lead to a few rows."""
        if not len(self.hashes):
            return np.full(len(keys), -1)
        bits = max(1, len(self.hashes).bit_length() + 2)
        if not hasattr(self, "rows_from"):
            self.rows_from = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
            self.crowded = int(np.diff(self.rows_from, append=len(self.hashes)).max())
        at = self.rows_from[keys >> np.uint64(64 - bits)]
        last, found = len(self.hashes) - 1, np.full(len(keys), -1)
        for _ in range(self.crowded):
            row = np.minimum(at, last)
            np.copyto(found, row, where=self.hashes[row] == keys)
            at += 1
        return found


def gather(counts: DataFrame, n_documents: int) -> Words:
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    known = vocabulary_size(int(total) + n_documents)
    top = counts.orderBy(F.desc("c"), "word").limit(max(HEAD, 8 * known)).toArrow().to_pandas()
    words, c = top["word"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    token = np.where(np.arange(len(words)) < known, np.arange(len(words)) + 2, OTHER)
    inside = c[:known]
    order = np.argsort(words)
    outside = int(total - inside.sum())
    return Words(words[order], c[order], token[order], int(total) + n_documents, int(distinct) + (n_documents > 0), n_documents,
                 outside, int(distinct) - len(inside), np.concatenate([[n_documents, outside], inside]).astype(np.int64))


def added_up(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the stretches of rows that begin at ``first``: short ones together, row by row, long ones each by itself."""
    sizes, out = np.diff(first, append=len(values)), values[first]
    more = np.flatnonzero(sizes > 1)
    for k in range(1, 8):
        out[more] += values[first[more] + k]
        more = more[sizes[more] > k + 1]
    for i in more.tolist():
        out[i] += values[first[i] + 8:first[i] + sizes[i]].sum(axis=0)
    return out


class Lanes:
    """Sequences laid end to end in lanes, the longest of a set first. A lane goes on with the next set, so that all lanes
    run until nothing follows; ``h`` holds their states."""

    def __init__(self, lanes: int, hidden: int = HIDDEN, at_once: int | None = None):
        self.lanes, self.hidden, self.at_once = lanes, hidden, at_once
        self.empty()

    def empty(self) -> None:
        # per position: input, target, the caller's mark, whether a sequence begins; lane by lane, the longest lane first
        self.left = [np.zeros(0, kind) for kind in (np.int32, np.int32, np.int32, bool)]
        self.sizes, self.h = np.zeros(self.lanes, np.int64), np.zeros((self.lanes, self.hidden), np.float32)

    def add(self, tokens: np.ndarray, bounds: np.ndarray, marks: np.ndarray) -> None:
        """Lay out further sequences, ``tokens`` cut at ``bounds``, behind those that are left."""
        begins = np.zeros(len(tokens), bool)
        begins[bounds[:-1]] = True
        before = np.concatenate([[END], tokens[:-1]])       # a text follows the end of another
        sizes = np.diff(bounds)
        order = np.argsort(-sizes, kind="stable")
        ends, lane_of = [(size, lane) for lane, size in enumerate(self.sizes.tolist())], np.empty(len(order), np.int64)
        heapq.heapify(ends)
        for k, size in enumerate(sizes[order].tolist()):
            filled, lane_of[k] = ends[0]
            heapq.heapreplace(ends, (filled + size, int(lane_of[k])))
        lane_of = np.concatenate([np.arange(self.lanes), lane_of])
        starts = np.concatenate([np.cumsum(self.sizes) - self.sizes, len(self.left[0]) + bounds[:-1][order]])
        sizes = np.concatenate([self.sizes, sizes[order]])
        filled = np.bincount(lane_of, sizes, self.lanes).astype(np.int64)
        by_length, rank = np.argsort(-filled, kind="stable"), np.empty(self.lanes, np.int64)
        rank[by_length] = np.arange(self.lanes)
        order = np.argsort(rank[lane_of], kind="stable")
        at = ragged(np.arange(len(self.left[0]) + len(tokens)), starts[order], sizes[order])
        self.left = [np.concatenate([old, new.astype(old.dtype)])[at] for old, new in zip(self.left, (before, tokens, marks, begins))]
        self.sizes, self.h = filled[by_length], self.h[by_length]

    def windows(self, last: bool):
        """(inputs, targets, begins, marks, whether there is a token) of each window, in order: (steps, lanes still running).
        ``WINDOW`` steps each, or as many as ``at_once`` positions allow. Windows that some lane does not fill wait for what
        follows, unless this is the ``last`` set."""
        inputs, targets, marks, first = self.left
        starts, t = np.cumsum(self.sizes) - self.sizes, 0
        until = int(self.sizes[0 if last else -1])
        while t < until:
            running = int(np.searchsorted(-self.sizes, -t))
            steps = WINDOW if self.at_once is None else max(WINDOW, self.at_once // running)
            if not last and t + steps > until:
                break
            steps = min(steps, until - t)
            time = np.arange(t, t + steps)[:, None]
            there = time < self.sizes[:running]
            part = np.minimum(starts[:running] + time, len(targets) - 1)
            self.h = self.h[:running]
            yield inputs[part], targets[part], first[part] & there, marks[part], there
            t += steps
        if last:
            self.empty()
        elif t:
            at = ragged(np.arange(len(targets)), starts + t, self.sizes - t)
            self.left, self.sizes = [x[at] for x in self.left], self.sizes - t


class Network:
    """Gated recurrent unit, class and word softmax; weights are float32 arrays in ``w``."""

    def __init__(self, token_counts: np.ndarray, classes: int | None = None, hidden: int = HIDDEN, seed: int = 7):
        n = len(token_counts)
        classes = classes or max(8, math.isqrt(n) // 2)
        self.hidden = hidden
        # classes of about equal share of the square root of counts: frequent tokens in small ones
        share = np.sqrt(token_counts + 1.0)
        order = np.argsort(-share, kind="stable")
        place = np.minimum((np.cumsum(share[order]) / share.sum() * classes).astype(int), classes - 1)
        _, place = np.unique(place, return_inverse=True)
        self.klass, self.within = np.empty(n, np.int64), np.empty(n, np.int64)
        self.klass[order] = place
        self.first = np.searchsorted(place, np.arange(place.max() + 2))
        self.within[order] = np.arange(n) - self.first[place]
        rng = np.random.default_rng(seed)
        f = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        k = int(place.max()) + 1
        totals = np.add.reduceat(token_counts[order] + 1.0, self.first[:-1])
        logs = np.log((token_counts[order] + 1.0) / totals[place])
        self.w = {
            "input": f(n, 3 * hidden), "gates": f(hidden, 2 * hidden), "state": f(hidden, hidden), "bias": np.zeros(3 * hidden, np.float32),
            # a row per class and per token, tokens in order of class: the bias, the weights, and a one that adds up rows
            "class": np.column_stack([np.log(totals / totals.sum()), f(k, hidden), np.ones(k)]).astype(np.float32),
            "word": np.column_stack([logs, f(n, hidden), np.ones(n)]).astype(np.float32),
        }
        self.squares = {name: np.full_like(x, 1e-3) for name, x in self.w.items()}
        self.wide = True

    def check(self) -> None:
        """Whether exponents could leave the range of a float: states lie between -1 and 1, and the biases are logarithms
        of shares to begin with. Weights move by less than the room left while a slice is learnt."""
        self.wide = any(float(np.abs(self.w[name][:, :-1]).sum(axis=1).max()) > 40 for name in ("class", "word"))

    def softmax(self, name: str, part: slice, states: np.ndarray, place: np.ndarray, total: np.ndarray,
                back: np.ndarray | None = None, grad: np.ndarray | None = None) -> np.ndarray:
        """Exponent of each column's place among the rows ``part`` of a table, ``total`` gets the sum of the powers; ``states``
        are columns between a one and a zero. ``grad`` gets the gradient of the table, and ``back`` that
        at the states, times ``total``."""
        table, out = self.w[name][part], np.empty(len(place), np.float32)
        at_once = max(1, SOFTMAX_AT_ONCE // len(table))
        for start in range(0, len(place), at_once):
            block = slice(start, min(start + at_once, len(place)))
            ready, each = states[:, block], np.arange(block.stop - start)
            p = table @ ready
            if self.wide:
                p -= p.max(axis=0)
            flat, chosen = p.reshape(-1), place[block] * len(each) + each
            out[block] = flat.take(chosen)
            np.exp(p, out=p)
            sums = np.matmul(np.ones(len(table), np.float32), p, out=total[block])
            if grad is None:
                continue
            flat[chosen] -= sums
            np.matmul(table[:, 1:-1].T, p, out=back[:, block])
            weighted = ready * (1 / sums)
            if start:
                grad += p @ weighted.T
            else:
                np.matmul(p, weighted.T, out=grad)
        return out

    def forward(self, inputs: np.ndarray, begins: np.ndarray, h: np.ndarray, keep: bool = False):
        """States of a window: inputs and begins are (steps, lanes). With ``keep`` also what the way back needs: update and
        reset gates (2, steps, lanes, hidden), candidates, and the states that steps begin with."""
        w, n = self.w, self.hidden
        # the three parts of the input apart, each a whole array; halves, as the gates are tanh(x / 2) / 2 + 1 / 2
        given = w["input"].reshape(-1, n).take(3 * inputs + np.arange(3)[:, None, None], axis=0)
        given += w["bias"].reshape(3, 1, 1, n)
        given[:2] *= 0.5
        gates = w["gates"].reshape(n, 2, n).transpose(1, 0, 2) * np.float32(0.5)
        starting, first = begins.any(axis=1).tolist(), h
        states = np.empty((*inputs.shape, n), np.float32)
        zr, rh = np.empty((2, *h.shape), np.float32), np.empty_like(h)
        for t, some in enumerate(starting):
            if some:
                h = np.where(begins[t][:, None], np.float32(0), h)
            np.matmul(h, gates, out=zr)
            zr += given[:2, t]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            candidate = np.matmul(np.multiply(zr[1], h, out=rh), w["state"])
            candidate += given[2, t]
            np.tanh(candidate, out=candidate)
            new = states[t]
            np.subtract(candidate, h, out=new)
            new *= zr[0]
            new += h
            h = new
            if keep:           # what was given is not needed again
                given[:2, t], given[2, t] = zr, candidate
        if not keep:
            return states, None, h
        before = np.concatenate([first[None], states[:-1]])
        before[begins] = 0
        return states, (given[:2], given[2], before), h

    def output(self, states: np.ndarray, targets: np.ndarray, learn: bool):
        """log p of each target; with ``learn`` also the gradient at the states, having added those of the output."""
        # rows in order of class, so that a class is a stretch of them
        klass, places = self.klass[targets], self.within[targets]
        order = np.argsort(klass.astype(np.uint16) if len(self.first) < 1 << 16 else klass, kind="stable")
        klass, places = klass[order], places[order]
        ready = np.zeros((self.hidden + 2, len(order)), np.float32)
        ready[0] = 1
        ready[1:-1] = states[order].T
        total = np.ones((2, len(order)), np.float32)
        grads, back = {"word": None, "class": None}, [None, None]
        if learn:
            grads, back = {name: np.zeros_like(self.w[name]) for name in grads}, np.zeros((2, self.hidden, len(order)), np.float32)
        starts = np.flatnonzero(np.diff(klass, prepend=-1))
        out = np.zeros(len(order), np.float32)
        for k, start, end in zip(klass[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(klass)]):
            part, these = slice(self.first[k], self.first[k + 1]), slice(start, end)
            if part.stop - part.start > 1:             # else a class of one token, which is certain
                out[these] = self.softmax("word", part, ready[:, these], places[these], total[0, these],
                                          back[0][:, these] if learn else None, grads["word"][part] if learn else None)
        out += self.softmax("class", slice(None), ready, klass, total[1], back[1], grads["class"])
        logs = np.log(total)
        out -= logs[0]
        out -= logs[1]
        found = np.empty_like(out)
        found[order] = out
        if not learn:
            return found, None
        back /= total[:, None]
        back[0] += back[1]
        given = np.empty((len(order), self.hidden), np.float32)
        given[order] = back[0].T
        for name, grad in grads.items():
            self.step(name, grad, slice(None))
        return found, given

    def step(self, name: str, grad: np.ndarray, part) -> None:
        """A step of the method that divides by the root of the squares so far. The gradient is per full window, so
        the few lanes that run on with long documents take small steps."""
        grad *= np.float32(4 / (LANES * WINDOW))
        np.clip(grad, np.float32(-1), np.float32(1), out=grad)
        squares = self.squares[name][part]
        squares += grad * grad
        if isinstance(part, np.ndarray):           # chosen rows are a copy, a stretch of them is not
            self.squares[name][part] = squares
        grad /= np.sqrt(squares)
        grad *= np.float32(RATE)
        self.w[name][part] -= grad

    def learn(self, inputs: np.ndarray, targets: np.ndarray, begins: np.ndarray, there: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
        """One window: forward, back through its steps, and a step of all weights. Steps that are not ``there`` count for
        nothing; they follow all others of their lane."""
        w, n = self.w, self.hidden
        states, ((z, r), candidate, before), last = self.forward(inputs, begins, h, True)
        if there.all():
            score, back = self.output(states.reshape(-1, n), targets.reshape(-1), True)
            back = back.reshape(states.shape)
        else:
            back = np.zeros_like(states)
            score, back[there] = self.output(states[there], targets[there], True)
        # what the gradient at a state is multiplied by on its way, for all steps at once
        stays = 1 - z
        to_candidate = candidate * candidate
        np.subtract(1, to_candidate, out=to_candidate)
        to_candidate *= z
        to_update = candidate - before
        to_update *= z
        to_update *= stays
        reset = r * before
        to_reset = 1 - r
        to_reset *= reset
        turned, state = w["gates"].reshape(n, 2, n).transpose(1, 2, 0).copy(), w["state"].T.copy()
        given = np.empty((3, *inputs.shape, n), np.float32)
        dh, more, ending = np.zeros_like(back[0]), np.empty((2, *back[0].shape), np.float32), begins.any(axis=1).tolist()
        for t in range(len(inputs) - 1, -1, -1):
            dh += back[t]
            d_candidate = np.multiply(dh, to_candidate[t], out=given[2, t])
            d_rh = d_candidate @ state
            np.multiply(dh, to_update[t], out=given[0, t])
            np.multiply(d_rh, to_reset[t], out=given[1, t])
            dh *= stays[t]
            d_rh *= r[t]
            dh += d_rh
            np.matmul(given[:2, t], turned, out=more)
            dh += more[0]
            dh += more[1]
            if ending[t]:
                dh[begins[t]] = 0
        flat, ids = given.reshape(3, -1, n), inputs.reshape(-1)
        gates = before.reshape(-1, n).T @ flat[:2]
        order = np.argsort(ids.astype(np.uint16) if len(w["input"]) < 1 << 16 else ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.diff(ids, prepend=-1))
        in_order = given.reshape(-1, n).take(order[:, None] + len(order) * np.arange(3), axis=0).reshape(-1, 3 * n)
        for name, grad, part in (("gates", gates.transpose(1, 0, 2).reshape(n, 2 * n), ...), ("state", reset.reshape(-1, n).T @ flat[2], ...),
                                 ("bias", (np.ones(len(order), np.float32) @ flat).reshape(-1), ...), ("input", added_up(in_order, first), ids[first])):
            self.step(name, grad, part)
        return float(score.sum()), last


def sequences(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts, an end after each; bounds; hash of each word and its row in the table (-1: none), ends left out."""
    keys = texts.hashes(lower=True)
    found = words.find(keys)
    tokens = np.where(found >= 0, words.tokens[np.maximum(found, 0)] if len(words.tokens) else OTHER, OTHER)
    tokens = np.insert(tokens, texts.bounds[1:], END)
    return tokens, texts.bounds + np.arange(len(texts) + 1), keys, found


def windows(tokens: np.ndarray, bounds: np.ndarray, lanes: int, at_once: int | None = None):
    """The windows of one set of sequences that nothing follows; marks are positions in ``tokens``."""
    laid = Lanes(lanes, at_once=at_once)
    laid.add(tokens, bounds, np.arange(len(tokens)))
    yield from laid.windows(last=True)


def train(network: Network, tokens: np.ndarray, bounds: np.ndarray) -> int:
    """All windows of all texts; returns the tokens seen."""
    sizes = np.diff(bounds)
    pieces = -(-sizes // STRETCH)
    number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = np.append(np.repeat(bounds[:-1], pieces) + number * STRETCH, bounds[-1])
    network.check()
    h = np.zeros((LANES, network.hidden), np.float32)
    for inputs, targets, begins, _, there in windows(tokens, cuts, LANES):
        _, h = network.learn(inputs, targets, begins, there, h[:there.shape[1]])
    return len(tokens)


def score_lanes(network: Network, lanes: Lanes, found: np.ndarray, last: bool) -> int:
    """Add the log-likelihood of the tokens that can be run to ``found``, at their marks; how many of the first texts are done."""
    for inputs, targets, begins, marks, there in lanes.windows(last):
        states, _, lanes.h = network.forward(inputs, begins, lanes.h)
        each, _ = network.output(states[there], targets[there], False)
        found += np.bincount(marks[there], each, len(found))
    return int(lanes.left[2].min(initial=len(found)))


def score_texts(network: Network, tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Natural log-likelihood of each text of one set that nothing follows, float64."""
    network.check()
    lanes, found = Lanes(SCORED_LANES, network.hidden, SCORED_AT_ONCE), np.zeros(len(bounds) - 1)
    lanes.add(tokens, bounds, np.repeat(np.arange(len(found)), np.diff(bounds)))
    score_lanes(network, lanes, found, last=True)
    return found


WEIGHTS = "shard long, name string, piece long, tokens long, weights binary"


def fit(training: DataFrame, words: Words) -> Network:
    """The averaged network. Only its weights reach the driver; the shards' are added up in tasks, ``ADDED`` at a time."""
    spark = training.sparkSession
    network = Network(words.token_counts)
    if not words.ends:
        return network
    share = min(1.0, SAMPLE / words.ends)
    dealt = training.select("text", F.xxhash64("doc_id", "text").alias("place"))
    some = dealt.where(F.pmod("place", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("place").limit(4 * SAMPLE).toArrow()
    for batch in slices(some.to_batches()):
        train(network, *sequences(Texts(batch.column(0)), words)[:2])
    shared, shards = spark.sparkContext.broadcast((network, words)), shard_count(words.n)

    def weights(shard, own, seen):
        for name, x in own.w.items():
            for i, start in enumerate(range(0, x.size, PIECE)):
                part = x.reshape(-1)[start:start + PIECE].astype(np.float64) * seen
                yield rows(WEIGHTS, [shard], [name], [i], [seen], [part.tobytes()])

    def shard(batches):
        start, table = shared.value

        def pieces():
            for batch in slices(batches, rows=4_000, size=4 << 20):
                numbers = batch.column(1).to_numpy()
                for first in np.flatnonzero(np.diff(numbers, prepend=-1)).tolist():
                    last = int(np.searchsorted(numbers, numbers[first], side="right"))
                    yield int(numbers[first]), Texts(batch.column(0).slice(first, last - first))

        for number, group in itertools.groupby(pieces(), key=lambda piece: piece[0]):
            own = Network(table.token_counts)
            own.w = {k: x.copy() for k, x in start.w.items()}
            own.squares = {k: x.copy() for k, x in start.squares.items()}
            yield from weights(number, own, sum(train(own, *sequences(texts, table)[:2]) for _, texts in group))

    def added(key, group):
        group = group.sort_by("shard")
        total = sum(np.frombuffer(x, np.float64) for x in group.column("weights").to_pylist())
        return pa.table({"shard": group.column("shard")[:1], "name": [key[0].as_py()], "piece": [key[1].as_py()],
                         "tokens": [sum(group.column("tokens").to_pylist())], "weights": [total.tobytes()]}, schema=arrow_schema(WEIGHTS))

    trained = (dealt.withColumn("shard", F.pmod(F.shiftright("place", 8), F.lit(shards)).cast("int"))
               .repartitionById(shards, "shard").sortWithinPartitions("shard", "place")
               .select("text", "shard").mapInArrow(released(shard), WEIGHTS))
    some = trained.groupBy("name", "piece", F.floor(F.col("shard") / ADDED)).applyInArrow(added, WEIGHTS)
    parts: dict[str, dict[int, np.ndarray]] = {}
    for row in some.groupBy("name", "piece").applyInArrow(added, WEIGHTS).toLocalIterator():
        parts.setdefault(row["name"], {})[row["piece"]] = np.frombuffer(row["weights"], np.float64) / row["tokens"]
    for name, found in parts.items():
        whole = np.concatenate([found[i] for i in sorted(found)])
        network.w[name] = whole.reshape(network.w[name].shape).astype(np.float32)
    return network


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_sum double, net double, rare array<long>"
NET = 6


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    training = docs.where(remainder_column("doc_id", FOLDS) != HELD_OUT)
    counts = staged(count_words(training))
    words = gather(counts, training.count())
    shared = spark.sparkContext.broadcast((fit(training, words), words))
    scale = float(np.log10(words.n + words.v + 1))

    def score(batches):
        network, table = shared.value
        network.check()
        log_counts = np.log10(table.counts + 1.0)
        lanes, waiting, net = Lanes(SCORED_LANES, network.hidden, SCORED_AT_ONCE), [], np.zeros(0)

        def scored(last):
            """Rows of the first slices whose texts are all scored."""
            nonlocal net
            done, start = score_lanes(network, lanes, net, last), 0
            while waiting and start + len(waiting[0]) <= done:
                batch = waiting.pop(0)
                found = batch.column(NET).to_numpy() + net[start:start + len(batch)] / np.log(10)
                yield batch.set_column(NET, "net", pa.array(found))
                start += len(batch)
            net = net[start:]
            lanes.left[2] -= np.int32(start)

        for batch in slices(batches):
            texts = Texts(batch.column(1))
            tokens, bounds, keys, found = sequences(texts, table)
            owner, n, known = texts.owners, len(texts), found >= 0
            lanes.add(tokens, bounds, len(net) + np.repeat(np.arange(n), np.diff(bounds)))
            net = np.append(net, np.zeros(n))
            base = np.bincount(owner[known], log_counts[found[known]], n) + np.log10(table.ends + 1.0)
            rare_owner, rare = owner[~known], keys[~known].view(np.int64)
            cuts = np.searchsorted(rare_owner, np.arange(n + 1)).astype(np.int32)
            # words of the table outside the vocabulary: their share among such words
            tail = known.copy()
            tail[known] = table.tokens[found[known]] == OTHER
            outside = np.bincount(owner[tail], log_counts[found[tail]], n) - np.bincount(owner[tail], minlength=n) * share
            ids = batch.column(0).to_pylist()
            waiting.append(rows(
                SCORED, np.zeros(n, np.int64), batch.column(0), [remainder(i, FOLDS) == HELD_OUT for i in ids], texts.sizes + 1,
                np.bincount(owner[known], minlength=n) + (table.ends > 0), base, outside,
                pa.ListArray.from_arrays(cuts, pa.array(rare))))
            yield from scored(sum(x.nbytes for x in [*waiting, *lanes.left]) > WAITING_BYTES)
        yield from scored(True)

    share = float(np.log10(words.outside + words.outside_distinct + 1))
    scored = staged(docs.mapInArrow(released(score), SCORED).withColumn("row", F.monotonically_increasing_id()))
    # rare words: none is frequent, since the HEAD most frequent are not among them
    rare = scored.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("n"))
    tails = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(1.0))).alias("logs"),
        F.sum("n").alias("n_rare"), F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"))
    none = F.lit(0)
    return scored.drop("rare").join(tails, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", none)).alias("n_known"),
        F.lit(words.n).cast("long").alias("train_tokens"),
        (F.col("base_sum") + F.coalesce("logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        (F.col("net") + F.coalesce("logs", F.lit(0.0)) - F.coalesce("n_rare", none) * F.lit(share)).alias("score"))
