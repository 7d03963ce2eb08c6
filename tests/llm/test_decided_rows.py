"""Near-duplicates decided row by row, links at exactly the limit, and quotations in lower-cased texts."""

import random
import time

import pytest

from thermopanel.llm import neardup, toxicity

A, B = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))


def test_no_text_is_lost_where_ids_repeat(spark):
    rows = [(3, B), (5, A), (5, B), (7, A), (None, B), (9, ""), (9, ""), (None, None), (11, "only here"), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, row double").repartition(2)
    kept = neardup.filter_documents(docs)
    assert kept.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert left == sorted([(3, B), (5, A), (9, ""), (9, ""), (None, None), (11, "only here"), (None, "no id")], key=str)
    labels = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.label(docs).collect()), key=str)
    want = [(3, 3, True), (5, 3, False), (None, 3, False), (5, 5, True), (7, 5, False), (9, 9, True), (9, 9, True), (11, 11, True)]
    assert labels == sorted([*want, (None, None, True), (None, None, True), (None, None, True)], key=str)


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, A), (1, A), (2, B), (4, B + " more")], "doc_id long, text string")
    assert sorted(r.doc_id for r in neardup.filter_documents(docs).collect()) == [1, 2]
    assert all(r.component_id in (1, 2) for r in neardup.label(docs).collect())


def test_pairs_at_the_limit_are_all_linked(spark):
    """Sets of 4 and 5 shingles up to 12 and 15 that share exactly 80 percent of their union."""
    rnd, rows = random.Random(2), []
    for i in range(1500):
        k = rnd.choice([1, 2, 3])
        common = [f"w{i}_{j}" for j in range(4 * k + 3)]
        rows += [(2 * i, " ".join(common)), (2 * i + 1, " ".join([*common, *[f"x{i}_{j}" for j in range(k)]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {r.doc_id: r.component_id for r in neardup.label(docs).collect()}
    assert all(found[2 * i + 1] == 2 * i for i in range(1500))


def test_quotation_is_seen_behind_letters_that_grow():
    lexicon = toxicity.Lexicon({"grobian": 2.0}, {})
    plain = [toxicity.features(f'{"i" * 10} "grobian" {x}', lexicon) for x in ("", "")]
    grown = toxicity.features(f'{"İ" * 10} "grobian" ', lexicon)
    assert grown == plain[0] != toxicity.features(f'{"i" * 10} grobian ', lexicon)
    assert toxicity.features('"grobian\n"', lexicon) == toxicity.features("grobian", lexicon)


def test_many_quoted_hits_take_linear_time():
    lexicon = toxicity.Lexicon({"grobian": 2.0}, {})
    start = time.process_time()
    toxicity.features('"grobian" ' * 40_000, lexicon)
    assert time.process_time() - start < 5


def test_words_ruled_out_together_are_those_the_automaton_rejects():
    rnd = random.Random(7)
    terms = ["".join(rnd.choice("abcde") for _ in range(n)) for n in (3, 4, 5, 6, 7, 7, 8, 9, 12)]
    lexicon = toxicity.Lexicon({t: 1.0 for t in terms}, {})
    words = ["".join(rnd.choice("abcdef") for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    for t in terms:
        for _ in range(300):
            w = list(t)
            for _ in range(rnd.randint(0, 3)):
                i, kind = rnd.randrange(len(w) + 1), rnd.randrange(4)
                if kind == 0:
                    w.insert(i, rnd.choice("abcdef"))
                elif kind == 1 and i < len(w):
                    w[i] = rnd.choice("abcdef")
                elif kind == 2 and i < len(w):
                    del w[i]
                elif i + 1 < len(w):
                    w[i], w[i + 1] = w[i + 1], w[i]
            words.append("".join(w))
    near = lexicon.near(words)
    assert near.tolist() == [lexicon.match(w)[0] > 0 for w in words] and 0 < near.sum() < len(words)
