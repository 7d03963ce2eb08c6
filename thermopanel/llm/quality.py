"""Quality rules: hashed n-gram log-likelihood ratio between trusted texts and the raw corpus.

Words and pairs of neighbouring words fall into ``BUCKETS`` hash buckets. One multinomial over the buckets is
counted from all documents (raw), one from the documents labelled as good (target); both are smoothed with the
uniform distribution, in proportion to their size. A document scores the mean over its n-grams of
log(target / raw), its own n-grams left out of both counts, so that labelled and other documents compare. The
verdict is a fixed cut: the trusted documents' mean score less ``DEVIATIONS`` standard deviations. Everything
is counted over all rows; only the bucket table (fixed size) and three numbers reach the driver.

Defined cases: a null text counts as empty; no words gives a score of 0 and fails the base rule; without trusted
documents the score is 0 and only the base rule decides; repeated rows are scored one by one; other columns
are ignored, and kept by ``filter_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from thermopanel.llm.common import IdSet, Texts, keep_rows, marked, mixed, per_text, released, rows, slices, texts_column

BUCKETS = 1 << 16
SMOOTHING = 1.0
DEVIATIONS = 4.0
#: Trusted ids sent as one array (8 bytes each); beyond, the documents are joined with the labels.
TRUSTED_LIMIT = 2_000_000
MIN_WORDS, REPEAT_SHARE = 50, 50
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, llr double"
)


@dataclass
class Model:
    """Bucket counts and totals of target and raw; ``trusted`` None: documents carry a column."""

    target: np.ndarray
    raw: np.ndarray
    trusted: IdSet | None

    def ratios(self, keys: np.ndarray, counts: np.ndarray, totals: np.ndarray, own: np.ndarray) -> np.ndarray:
        """log(target / raw) per (document, bucket), without the document's own share."""
        n_target, n_raw = self.target.sum(), self.raw.sum()
        even = SMOOTHING / len(self.raw)
        raw = np.maximum(self.raw[keys] - counts, 0) / np.maximum(n_raw - totals, 1)
        target = np.maximum(self.target[keys] - counts * own, 0) / np.maximum(n_target - totals * own, 1)
        return np.log((target + even) / (raw + even))


def _ngrams(words: np.ndarray, sizes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and word pairs, with the number of the text of each."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
    pairs = mixed(words[:-1], words[1:])[inside] if len(words) else words
    grams = np.concatenate([mixed(words, np.zeros_like(words)), pairs])
    return (grams % np.uint64(buckets)).astype(np.int64), np.concatenate([owner, owner[1:][inside] if len(owner) else owner])


def count_buckets(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, Model]:
    """The multinomials over all documents; returns the documents as the scorer wants them."""
    trusted = labels.where("quality = 1").select("doc_id")
    docs, ids = marked(docs, trusted, TRUSTED_LIMIT, "__trusted")
    schema = "bucket int, raw long, target long"

    def count(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in slices(batches):
            texts = texts_column(batch)
            grams, owner = _ngrams(texts.hashes(), texts.sizes, buckets)
            raw += np.bincount(grams, minlength=buckets)
            target += np.bincount(grams[_is_trusted(batch, ids)[owner]], minlength=buckets)
        full = np.flatnonzero(raw)
        yield rows(schema, full.astype(np.int32), raw[full], target[full])

    found = _inputs(docs).mapInArrow(released(count), schema).groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow().to_pandas()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[found["bucket"]], target[found["bucket"]] = found["raw"], found["target"]
    return docs, Model(target, raw, ids)


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(*[c for c in ("doc_id", "text", "__trusted") if c in docs.columns])


def _is_trusted(batch: pa.RecordBatch, ids: IdSet | None) -> np.ndarray:
    if ids is not None:
        return ids.has(batch.column(batch.schema.get_field_index("doc_id")))
    return np.array([bool(x) for x in batch.column(batch.schema.get_field_index("__trusted")).to_pylist()], bool)


def _repeated(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a 3-word window found twice or more in it."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    if len(words) < 3:
        return np.zeros(len(sizes), np.int64)
    same = owner[2:] == owner[:-2]
    at = np.flatnonzero(same)
    keys = mixed(mixed(mixed(words[:-2], words[1:-1]), words[2:])[at], owner[at].astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    equal = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[at[twice] + shift] = True
    return np.bincount(owner[covered], minlength=len(sizes))


def _duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def measure(column: pa.Array, model: Model | None, trusted: np.ndarray) -> dict:
    texts = Texts(column)
    words, sizes = texts.hashes(), texts.sizes
    repeats = _repeated(words, sizes)
    llr = np.zeros(len(texts))
    if model is not None and model.target.sum() > 0 and len(words):
        buckets = len(model.raw)
        grams, owner = _ngrams(words, sizes, buckets)
        keys, counts = np.unique(owner * buckets + grams, return_counts=True)
        owner, keys = keys // buckets, keys % buckets
        totals = np.maximum(2 * sizes - 1, 0)
        each = model.ratios(keys, counts, totals[owner], trusted[owner]) * counts
        llr = np.bincount(owner, each, len(texts)) / np.maximum(totals, 1)
    return {
        "n_words": sizes,
        "word_chars": texts.summed(texts.full & (texts.data & 0xC0 != 0x80)),
        "n_symbols": texts.summed(SYMBOLS[texts.data]),
        "n_dup_lines": [_duplicate_lines(t) for t in texts.column.to_pylist()],
        "n_repeat_words": repeats,
        "base_failed": (sizes < MIN_WORDS) | (100 * repeats > REPEAT_SHARE * sizes),
        "llr": llr,
    }


def _text(batch: pa.RecordBatch) -> pa.Array:
    return batch.column(batch.schema.get_field_index("text"))


def fit(docs: DataFrame, labels: DataFrame, deviations: float = DEVIATIONS) -> tuple[DataFrame, object, float]:
    """Documents, broadcast model, and the cut from the scores of all trusted documents."""
    docs, model = count_buckets(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "n long, total double, squares double"

    def sums(batches):
        for batch in slices(batches):
            column = _text(batch).filter(pa.array(_is_trusted(batch, shared.value.trusted)))
            llr = measure(column, shared.value, np.ones(len(column), bool))["llr"]
            yield rows(schema, [len(llr)], [llr.sum()], [(llr ** 2).sum()])

    n, total, squares = _inputs(docs).mapInArrow(released(sums), schema).agg(F.sum("n"), F.sum("total"), F.sum("squares")).first()
    if not n:
        return docs, shared, float("-inf")
    mean = total / n
    # rounded: the order of the sums must not move the cut
    return docs, shared, round(mean - deviations * max(squares / n - mean * mean, 0.0) ** 0.5, 9)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, llr, cut and kept for every document."""
    docs, shared, cut = fit(docs, labels)

    def work():
        return lambda batch: measure(_text(batch), shared.value, _is_trusted(batch, shared.value.trusted))

    scored = per_text(docs, "doc_id long", FIELDS, work, _inputs(docs).columns)
    return scored.withColumn("cut", F.lit(cut)).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(cut)))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    columns = docs.columns
    docs, shared, cut = fit(docs, labels)

    def work():
        def step(batch):
            found = measure(_text(batch), shared.value, _is_trusted(batch, shared.value.trusted))
            return ~found["base_failed"] & (found["llr"] >= cut)

        return step

    return keep_rows(docs, work).select(*columns)
