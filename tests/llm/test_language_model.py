"""The recurrent model against a plain version, its gradients against differences, and its results under another layout."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from thermopanel.llm import language_model as lm
from thermopanel.llm.common import ASCII_LOWER, Texts

SMALL = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def plain_steps(net, inputs, targets):
    """log p of each target, one step at a time in float64."""
    w = {k: x.astype(np.float64) for k, x in net.w.items()}
    n, h, out = net.hidden, np.zeros(net.hidden), []
    for token, target in zip(inputs, targets):
        given = w["input"][token] + w["bias"]
        z, r = np.split(sigmoid(given[:2 * n] + h @ w["gates"]), 2)
        h = h + z * (np.tanh(given[2 * n:] + (r * h) @ w["state"]) - h)
        k = net.klass[target]
        p = np.exp(w["class"][:, 1:-1] @ h + w["class"][:, 0])
        part = slice(net.first[k], net.first[k + 1])
        q = np.exp(w["word"][part, 1:-1] @ h + w["word"][part, 0])
        out.append(math.log(p[k] / p.sum()) + math.log(q[net.within[target]] / q.sum()))
    return out


def test_scores_equal_a_plain_version_and_do_not_depend_on_the_layout(spark):
    docs = documents(spark)
    training = docs.where(lm.remainder_column("doc_id", lm.FOLDS) != lm.HELD_OUT)
    counts = lm.count_words(training).cache()
    words = lm.gather(counts, training.count())
    net = lm.fit(training, words)
    by_hash = {r.word: r.c for r in counts.collect()}
    number = {int(np.int64(np.uint64(h))): int(t) for h, t in zip(words.hashes.view(np.int64), words.tokens)}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    found = {r.doc_id: r for r in lm.score_documents(docs.repartition(5, F.rand(3))).collect()}
    again = {r.doc_id: r for r in lm.score_documents(docs.coalesce(1)).collect()}
    assert found.keys() == again.keys() == texts.keys()
    assert all(math.isclose(found[i].score, again[i].score, rel_tol=1e-6) for i in texts)
    for i in sorted(texts)[:25]:
        data = texts[i].encode().translate(ASCII_LOWER).split()
        hashes = [int(Texts(lm.pa.array([x])).hashes().view(np.int64)[0]) for x in data]
        tokens = [number.get(h, lm.OTHER) for h in hashes] + [lm.END]
        score = sum(plain_steps(net, [lm.END, *tokens[:-1]], tokens)) / math.log(10)
        for h, token in zip(hashes, tokens):
            if token == lm.OTHER:
                score += math.log10((by_hash.get(h, 0) + 1) / (words.outside + words.outside_distinct + 1))
        assert math.isclose(found[i].score, score, rel_tol=1e-4), i
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 7 == 2)


def test_gradient_equals_differences_where_lanes_end_within_the_window():
    rng = np.random.default_rng(5)
    net = lm.Network(np.array([5, 3, 9, 1, 1, 4, 7, 2]), classes=3, hidden=4)
    for name in net.w:
        net.w[name] = (rng.standard_normal(net.w[name].shape) * 0.4).astype(np.float32)
        if name in ("class", "word"):
            net.w[name][:, -1] = 1
    inputs, targets = rng.integers(0, 8, (6, 3)), rng.integers(0, 8, (6, 3))
    begins, there = np.zeros((6, 3), bool), np.arange(6)[:, None] < np.array([6, 4, 1])
    begins[0], begins[3, 0] = True, True
    caught = {}

    def step(name, grad, part):
        caught.setdefault(name, np.zeros(net.w[name].shape))[part] += grad.copy()

    def loss():
        states, _, _ = net.forward(inputs, begins, np.zeros((3, 4), np.float32))
        return float(-net.output(states[there], targets[there], False)[0].astype(np.float64).sum())

    net.step = step
    net.learn(inputs, targets, begins, there, np.zeros((3, 4), np.float32))
    for name, grad in caught.items():
        flat = net.w[name].reshape(-1)
        learnt = np.arange(flat.size).reshape(net.w[name].shape)
        learnt = (learnt[:, :-1] if name in ("class", "word") else learnt).reshape(-1)
        for i in rng.choice(learnt, min(len(learnt), 12), replace=False):
            kept = flat[i]
            flat[i] = kept + 0.02
            up = loss()
            flat[i] = kept - 0.02
            down = loss()
            flat[i] = kept
            assert abs((up - down) / 0.04 - grad.reshape(-1)[i]) < 0.02, (name, i)


def test_windows_hold_every_token_once_in_order():
    rng = np.random.default_rng(1)
    sizes = np.append(rng.integers(1, 40, 70), 900)
    bounds = np.append(0, np.cumsum(sizes))
    tokens = rng.integers(1, 50, bounds[-1])
    tokens[bounds[1:] - 1] = lm.END
    for at_once in (None, 200):
        seen, last = np.zeros(len(tokens), int), {}
        for inputs, targets, begins, part, there in lm.windows(tokens, bounds, 8, at_once):
            for t, lane in np.argwhere(there):
                i = part[t, lane]
                seen[i] += 1
                assert targets[t, lane] == tokens[i] and inputs[t, lane] == (tokens[i - 1] if i else lm.END)
                assert begins[t, lane] == (i in bounds[:-1]) and (begins[t, lane] or last[lane] == i - 1)
                last[lane] = i
        assert (seen == 1).all()


def test_sizes_grow_with_the_corpus():
    assert lm.vocabulary_size(4_000_000) < lm.vocabulary_size(88_000_000) < lm.vocabulary_size(5_000_000_000)
    assert lm.shard_count(0) == 1 and lm.shard_count(4_000_000) < lm.shard_count(88_000_000)


def sets_of_sequences(rng, sizes):
    tokens = [rng.integers(1, 8, sum(some)) for some in sizes]
    bounds = [np.append(0, np.cumsum(some)) for some in sizes]
    for t, b in zip(tokens, bounds):
        t[b[1:] - 1] = lm.END
    return tokens, bounds


def test_lanes_go_on_with_the_next_set_and_lose_no_token():
    rng = np.random.default_rng(2)
    tokens, bounds = sets_of_sequences(rng, [rng.integers(1, 90, 25) for _ in range(40)] + [[1500, 3], [2]])
    lanes, seen, windows, alone, places = lm.Lanes(8, 1), [], [], 0, 0
    for k, (t, b) in enumerate(zip(tokens, bounds)):
        lanes.add(t, b, np.arange(len(t)) + places)
        for inputs, targets, begins, marks, there in lanes.windows(last=k == len(tokens) - 1):
            if k < 40:
                assert there.all() and there.shape == (lm.WINDOW, 8)
            windows.append(there.size)
            for lane in range(there.shape[1]):
                # the state of a lane is the last mark it has seen
                before = lanes.h[lane, 0]
                for step in np.flatnonzero(there[:, lane]):
                    mark, whole = marks[step, lane], np.concatenate(tokens)
                    assert targets[step, lane] == whole[mark]
                    assert begins[step, lane] or (before == mark and inputs[step, lane] == whole[mark - 1])
                    before = mark + 1
                    seen.append(mark)
                lanes.h[lane, 0] = before
        places += len(t)
        alone += sum(there.size for *_, there in lm.windows(t, b, 8))
    assert sorted(seen) == list(range(places))
    # far fewer steps are run in vain than if each set were run to its end
    assert sum(windows) - places < 0.5 * (alone - places)


def test_scores_over_several_sets_equal_those_of_each_text_alone():
    rng = np.random.default_rng(3)
    net = lm.Network(np.array([5, 3, 9, 1, 1, 4, 7, 2]), classes=3, hidden=4)
    tokens, bounds = sets_of_sequences(rng, [[400, 3, 1], [20, 70, 5, 9], [1], [33] * 12])
    found, lanes = np.zeros(0), lm.Lanes(3, 4, 40)
    for t, b in zip(tokens, bounds):
        marks = len(found) + np.repeat(np.arange(len(b) - 1), np.diff(b))
        lanes.add(t, b, marks)
        found = np.append(found, np.zeros(len(b) - 1))
        done = lm.score_lanes(net, lanes, found, False)
        assert done <= len(found)
    assert done < lm.score_lanes(net, lanes, found, True) == len(found)
    plain = [sum(plain_steps(net, [lm.END, *t[i:j - 1]], t[i:j])) for t, b in zip(tokens, bounds) for i, j in zip(b[:-1], b[1:])]
    assert np.allclose(found, plain, rtol=1e-5)


def test_sums_of_stretches():
    rng = np.random.default_rng(4)
    values = rng.standard_normal((400, 6))
    first = np.array([0, 1, 2, 9, 10, 18, 27, 200, 399])
    assert np.allclose(lm.added_up(values, first), np.add.reduceat(values, first))
    assert np.allclose(lm.added_up(values[:1], first[:1]), values[:1])
