"""Periodic runs against a plain search over all lags, the contract's digests, and awkward texts."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from thermopanel.llm import runs
from thermopanel.llm.common import Texts
from thermopanel.llm.queries import QUERIES


def plain(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            e = i + q
            if e - s >= max(6, 4 * q) and not any(all(w[k] == w[k + d] for k in range(s, e - d)) for d in range(1, q)):
                out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(words):
    return runs.Scanned(Texts(pa.array([" ".join(words)])), [0]).runs[0]


def test_equal_to_all_lags():
    rnd, texts = random.Random(3), []
    for _ in range(1500):
        n, k, w = rnd.randint(0, 130), rnd.choice([1, 2, 3, 6, 20]), []
        while len(w) < n:
            w += [str(rnd.randrange(k)) for _ in range(rnd.randint(1, 9))] * (rnd.randint(1, 9) if rnd.random() < 0.5 else 1)
        texts.append(w)
    together = runs.Scanned(Texts(pa.array([" ".join(w) for w in texts])), list(range(len(texts)))).runs
    assert together == [plain(w) for w in texts]


def fibonacci(n):
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("words", [
    fibonacci(400), fibonacci(90) * 4 + ["z"] + fibonacci(70) * 5, ["a"] * 300, ["a", "b", "a", "a", "b"] * 40,
    ["x"] * 5, ["x"] * 6, ["a", "b"] * 4, (["a", "b"] * 3)[:7], ["a"] * 9 + (["a"] * 8 + ["b"]) * 6 + ["a"] * 30,
])
def test_words_with_much_repetition(words):
    assert found(words) == plain(words)


def test_long_texts():
    assert found(["a"] * 300_000) == [(0, 300_000, 1)]
    assert found([str(i % 40_000) for i in range(170_000)]) == [(0, 170_000, 40_000)]
    assert found(["x" * 300_000]) == []


def test_hashes_alone_do_not_make_a_run(monkeypatch):
    """Blocks that only share their hash are told apart by the words."""
    monkeypatch.setattr(runs, "finished", lambda x: np.zeros_like(x))
    monkeypatch.setattr(runs, "mixed", lambda a, b: np.zeros_like(a))
    words = ["a", "b", "c"] * 5 + ["d", "e", "a", "b"] * 5 + ["q"] * 7
    assert found(words) == plain(words)


def contract(doc_id, text):
    """The query's row, word by word."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    all_runs = plain(words)
    dropped = {i for s, length, q in all_runs for i in range(s + q, s + length)}
    best = min(all_runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda x: hashlib.sha256(x).hexdigest()
    return (len(all_runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            digest("".join(f"{s},{k},{q}\n" for s, k, q in all_runs).encode()),
            digest(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_the_query_follows_its_contract(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    short = {r.doc_id: r.text for r in docs.where("length(text) < 8000 OR text IS NULL").collect()}
    out = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    assert len(out) == docs.count() and sum(row[0] > 0 for row in out.values()) > 3
    for doc_id, text in short.items():
        assert out[doc_id] == contract(doc_id, text), doc_id


ROWS = [(None, "a b a b a b a b a b", 1), (1, None, 2), (2, "", 3), (3, " \t\n", 4), (4, "x x x x x x x y", 5), (4, "x x x x x x x y", 5), (5, "é 😀 " * 9, 6)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, period int").repartition(2)


def test_awkward_rows(docs):
    out = sorted(runs.digest_runs(docs, runs.planted).collect(), key=str)
    assert sorted((tuple(r) for r in out), key=str) == sorted(((i, *contract(i, t)) for i, t, _ in ROWS), key=str)
    assert runs.digest_runs(docs.limit(0)).count() == 0


def test_runs_and_collapsed_texts(docs):
    listed = {(r.doc_id, r.start, r.length, r.period, r.unit) for r in runs.find_runs(docs).collect()}
    assert listed == {(None, 0, 10, 2, "a b"), (4, 0, 7, 1, "x"), (5, 0, 18, 2, "é 😀")}
    out = runs.collapse(docs)
    assert out.columns == docs.columns
    assert {(r.doc_id, r.text) for r in out.collect()} == {(None, "a b"), (1, None), (2, ""), (3, " \t\n"), (4, "x y"), (5, "é 😀")}
    assert out.agg(F.sum("period")).first()[0] == 26
