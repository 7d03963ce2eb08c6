"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (words and pairs of neighbouring words): the target model is counted from the
trusted documents, the raw model from all documents. The log importance weight of a document is the sum over its
n-grams of log(target / raw), its own n-grams left out of both, divided by the square root of their number, so that
long documents neither drown nor flood the sample. Adding Gumbel noise, drawn from a hash of the document, and
keeping the k largest keys samples without replacement in proportion to the weights.

k is a share of the documents. The k-th largest key is found from histograms of the keys, each within the cell of
the one before that holds it, until the rows of one cell are few; so no task sees all rows.

Defined cases: a null text or one without words has weight 0; without trusted documents all weights are 0 and the
sample is uniform; repeated rows have equal keys and stand or fall together but for the last place, which goes by
doc_id; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from thermopanel.llm.common import Texts, per_text, staged
from thermopanel.llm.quality import Model, _inputs, _is_trusted, _ngrams, _text, count_buckets

SHARE = 0.5
SEED = 20
CELLS = 4096


def log_weights(texts: Texts, model: Model, trusted: np.ndarray) -> np.ndarray:
    words, sizes = texts.hashes(), texts.sizes
    out = np.zeros(len(texts))
    if model.target.sum() > 0 and len(words):
        buckets = len(model.raw)
        grams, owner = _ngrams(words, sizes, buckets)
        keys, counts = np.unique(owner * buckets + grams, return_counts=True)
        owner, keys = keys // buckets, keys % buckets
        totals = np.maximum(2 * sizes - 1, 0)
        each = model.ratios(keys, counts, totals[owner], trusted[owner]) * counts
        out = np.bincount(owner, each, len(texts)) / np.sqrt(np.maximum(totals, 1))
    return out


def weigh(docs: DataFrame, labels: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, log_weight and the Gumbel key of every document."""
    docs, model = count_buckets(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        def step(batch):
            texts = Texts(_text(batch))
            return {"n_words": texts.sizes, "log_weight": log_weights(texts, shared.value, _is_trusted(batch, shared.value.trusted))}

        return step

    found = per_text(docs, "doc_id long", "n_words long, log_weight double", work, _inputs(docs).columns)
    # 52 bits of a hash as a number strictly between 0 and 1
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
    return found.withColumn("sample_key", F.col("log_weight") - F.log(-F.log(uniform)))


def top_k(keyed: DataFrame, k: int) -> DataFrame:
    """Column kept: whether a row is among the k largest by (sample_key, doc_id); ``keyed`` is read several times."""
    if k <= 0:
        return keyed.withColumn("kept", F.lit(False))
    low, high = keyed.agg(F.min("sample_key"), F.max("sample_key")).first()
    if low is None:
        return keyed.withColumn("kept", F.lit(True))
    above = 0
    while True:
        # rows over ``high`` are in; the k-th is among those from low to high
        width = (high - low) / CELLS
        inside = keyed.where(F.col("sample_key").between(low, high))
        if width <= 0 or low + width <= low:
            break
        cell = F.least(F.floor((F.col("sample_key") - low) / width).cast("int"), F.lit(CELLS - 1)).alias("cell")
        counts = {r["cell"]: (r["n"], r["low"], r["high"]) for r in inside.groupBy(cell).agg(
            F.count("*").alias("n"), F.min("sample_key").alias("low"), F.max("sample_key").alias("high")).collect()}
        for number in sorted(counts, reverse=True):
            n, cell_low, cell_high = counts[number]
            if above + n >= k:
                break
            above += n
        low, high = cell_low, cell_high
        if low == high:
            break
    # what is left has one key: the last places go by doc_id, found the same way over ids
    tied, last = keyed.where(F.col("sample_key") == low), k - above
    limit = _kth_id(tied, last)
    return keyed.withColumn("kept", (F.col("sample_key") > low) | ((F.col("sample_key") == low) & (
        F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))) <= F.lit(limit))))


def _kth_id(tied: DataFrame, k: int) -> int:
    """The k-th smallest id of rows with one key."""
    ids = tied.groupBy(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i")).agg(F.count("*").alias("n"))
    seen = 0
    for row in ids.orderBy("i").limit(k).toLocalIterator():
        seen += row["n"]
        if seen >= k:
            return row["i"]
    return (1 << 63) - 1


def resample(docs: DataFrame, labels: DataFrame, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, log_weight, sample_key, kept for every document."""
    keyed = staged(weigh(docs, labels, seed))
    return top_k(keyed, round(share * keyed.count()))
