"""Document fingerprints by I-Match, over several randomised lexicons.

Document frequencies are counted over distinct texts, so that a text with many copies does not make its own terms
common. Terms whose inverse document frequency lies in the chosen band form the lexicon; terms too common or too rare
say nothing about near copies. Rare is what stands in few rows, copies included: the terms of a text that has
copies do tell about them. Only equal texts count once; near copies count as texts of their own. The distinct terms of a document that
are in the lexicon, sorted, are hashed; and so is what is left of them in each of several random subsets of
the lexicon. ``SUBSETS`` subsets hold half of the lexicon, as many a quarter, and so on: large ones tell near copies
apart, small ones hold few terms of a document and still agree when much of it has changed. The fingerprint lists
the hashes; likeness is the share of equal ones among those where either text has a term.

Terms are 64-bit hashes of lower-cased words. Words with the same hash (a chance of 2**-64 a pair) count as one.
The lexicon goes to the tasks whole, as sorted arrays of at most about ``LEXICON_LIMIT`` terms (8 bytes each) of which
a worker holds one at a time: every slice of texts is looked up in each.

Defined cases: a null text counts as empty; texts without a term in the lexicon share the fingerprint of no
terms and are like each other alone; ties in doc_id are ordered by text, null ids come first; a single
document follows itself; repeated rows are kept; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from thermopanel.llm.common import Texts, finished, released, rows, slices, staged

#: Inverse document frequency, ln(N / df): in at least 3 documents of any corpus, and in at most 1 of 20 distinct texts.
LEAST_IDF, LEAST_DOCUMENTS = math.log(20), 3
SUBSETS, LEVELS = 8, 9
HASHES = 1 + SUBSETS * LEVELS
#: Rows of the lexicon, or of the table of copied texts, that travel and are held at once.
LEXICON_LIMIT = 2_000_000
#: Rows that one block of the document order holds, about.
BLOCK_ROWS = 4_000


def text_hashes(texts: Texts) -> np.ndarray:
    """(n, 2) 64-bit values: a 128-bit hash of each text."""
    digests = b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts.column.to_pylist())
    return np.frombuffer(digests, np.uint64).reshape(-1, 2)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """a, b, count: the hash of each distinct text and its number of rows."""
    schema = "a long, b long"

    def run(batches):
        for batch in slices(batches):
            yield rows(schema, *text_hashes(Texts(batch.column(0))).view(np.int64).T)

    return docs.select("text").mapInArrow(released(run), schema).groupBy("a", "b").count()


def shipped(table: DataFrame, n: int) -> list[Broadcast]:
    """The ``n`` rows of a table of longs as arrays sorted by the first column, in pieces of about ``LEXICON_LIMIT`` rows:
    the driver and each worker hold one piece at a time."""
    pieces = max(1, -(-n // LEXICON_LIMIT))
    out = []
    for k in range(pieces):
        part = table.where(F.pmod(table.columns[0], F.lit(pieces)) == k).toArrow()
        columns = [c.to_numpy().view(np.uint64) for c in part.columns]
        order = np.argsort(columns[0])
        out.append(table.sparkSession.sparkContext.broadcast([c[order] for c in columns]))
    return out


def held(pieces: list[Broadcast]):
    """Each piece that has rows, in turn; of several, a worker lets go of one before it reads the next."""
    for piece in pieces:
        columns = piece.value
        if len(columns[0]):
            yield columns
        del columns
        if len(pieces) > 1 and getattr(piece, "_path", None):
            piece.__dict__.pop("_value", None)


def copies_of(texts: Texts, copied: list[Broadcast]) -> np.ndarray:
    """In how many rows each text stands."""
    out = np.ones(len(texts), np.int64)
    hashes = None
    for a, b, counts in held(copied):
        hashes = text_hashes(texts) if hashes is None else hashes
        at = np.minimum(np.searchsorted(a, hashes[:, 0]), len(a) - 1)
        known = (a[at] == hashes[:, 0]) & (b[at] == hashes[:, 1])
        out[known] = counts[at[known]]
    return out


def document_frequencies(docs: DataFrame, copied: list[Broadcast]) -> DataFrame:
    """term, df, n_rows: in how many distinct texts and in how many rows; each task adds up its own first.

    Each of the c rows of a text counts as 1 / c of it. What that takes from the rows is summed, mostly 0.
    """
    schema = "term long, n_rows long, less double"

    def count(batches):
        found, counts, less = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)
        for batch in slices(batches):
            texts = Texts(batch.column(0))
            keys = texts.hashes(lower=True)
            owner = texts.owners
            order = np.lexsort((owner, keys))
            keys, owner = keys[order], owner[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
            once, at = np.unique(keys[new], return_inverse=True)
            n = np.bincount(at, minlength=len(once))
            more = np.bincount(at, (1 - 1 / copies_of(texts, copied))[owner[new]], len(once))
            found, inverse = np.unique(np.concatenate([found, once]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([counts, n]), len(found)).astype(np.int64)
            less = np.bincount(inverse, np.concatenate([less, more]), len(found))
            if len(found) > 2_000_000:
                yield rows(schema, found.view(np.int64), counts, less)
                found, counts, less = found[:0], counts[:0], less[:0]
        if len(found):
            yield rows(schema, found.view(np.int64), counts, less)

    summed = docs.select("text").mapInArrow(released(count), schema).groupBy("term").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("less").alias("less"))
    return summed.select("term", (F.col("n_rows") - F.round("less").cast("long")).alias("df"), "n_rows")


def lexicon(docs: DataFrame, n_texts: int, copied: list[Broadcast]) -> DataFrame:
    """The terms within the band, of ``n_texts`` distinct texts."""
    most = max(LEAST_DOCUMENTS, int(n_texts / math.exp(LEAST_IDF)))
    return document_frequencies(docs, copied).where((F.col("n_rows") >= LEAST_DOCUMENTS) & (F.col("df") <= most)).select("term")


def fingerprints(terms: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """(n, HASHES) 32-bit hashes of the sorted distinct lexicon terms of each text; 0 for none."""
    order = np.lexsort((terms, owner))
    terms, owner = terms[order], owner[order]
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
    terms, owner = terms[new], owner[new]
    out = np.zeros((n, HASHES), np.uint32)
    value = finished(terms ^ np.uint64(0x5BD1E995))
    for k in range(HASHES):
        kept, whose = value, owner
        if k:
            level = np.uint64((1 << (1 + (k - 1) // SUBSETS)) - 1)
            keep = finished(terms + np.uint64(k)) & level == 0
            kept, whose = value[keep], owner[keep]
        if len(whose):
            # a set's hash: the sum of its terms' hashes, which are distinct and in a fixed order
            starts = np.flatnonzero(np.concatenate(([True], whose[1:] != whose[:-1])))
            total = finished(np.add.reduceat(kept, starts) + np.uint64(k))
            out[whose[starts], k] = np.maximum(total >> np.uint64(32), np.uint64(1))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal hashes where either text has a term; 1 if neither has any."""
    either = ((a > 0) | (b > 0)).sum(axis=1)
    return np.where(either > 0, ((a == b) & (a > 0)).sum(axis=1) / np.maximum(either, 1), 1.0)


def written(prints: np.ndarray) -> list[str]:
    return [row.astype(">u4").tobytes().hex() for row in prints]


def among(keys: np.ndarray, terms: list[Broadcast]) -> np.ndarray:
    """Which keys are in the lexicon."""
    once, inverse = np.unique(keys, return_inverse=True)
    found = np.zeros(len(once), bool)
    for (known,) in held(terms):
        at = np.minimum(np.searchsorted(known, once), len(known) - 1)
        found |= known[at] == once
    return found[inverse]


def ordered_blocks(docs: DataFrame, n: int) -> tuple[DataFrame, int]:
    """doc_id, text, block, halo: blocks of consecutive doc_ids; the first rows of a block are also sent, as its halo,
    to the block before, the first block's to the last.

    The blocks' limits are ids, from an approximate quantile of doc_id alone.
    """
    blocks = max(1, n // BLOCK_ROWS)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    shares = [i / blocks for i in range(1, blocks)]
    limits, least = docs.select(F.percentile_approx(key, shares or [0.0], 20 * max(blocks, 500)), F.min(key)).first()
    limits = np.unique(np.array([least, *(limits if shares else [])], np.int64))
    schema = "doc_id long, text string, block int, halo boolean"

    def spread(batches):
        for batch in slices(batches):
            ids = batch.column(0).fill_null(-(1 << 63)).to_numpy()
            block = np.searchsorted(limits, ids, side="right") - 1
            first = np.flatnonzero(np.isin(ids, limits))
            whole = rows(schema, batch.column(0), batch.column(1), block.astype(np.int32), np.zeros(len(ids), bool))
            yield whole
            if len(first):
                part = batch.take(pa.array(first))
                yield rows(schema, part.column(0), part.column(1), ((block[first] - 1) % len(limits)).astype(np.int32), np.ones(len(first), bool))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(spread), schema), len(limits)


FIELDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per document with its fingerprint, that of its edited text, and their likeness to it."""
    spark = docs.sparkSession
    counted = staged(distinct_texts(docs))
    n_texts, n, n_copied = counted.select(F.count("*"), F.coalesce(F.sum("count"), F.lit(0)), F.count_if(F.col("count") > 1)).first()
    if not n:
        return spark.createDataFrame([], FIELDS)
    copied = shipped(counted.where("count > 1"), n_copied)
    terms = staged(lexicon(docs, n_texts, copied))
    known = shipped(terms, terms.count())
    blocks, n_blocks = ordered_blocks(docs, n)

    def prints(*groups: list[str]) -> list[np.ndarray]:
        """Fingerprints of the texts of each group, which are looked up together."""
        found = [Texts(pa.array(texts, pa.string())) for texts in groups]
        keys = [texts.hashes(lower=True) for texts in found]
        keep = np.split(among(np.concatenate(keys), known), np.cumsum([len(k) for k in keys])[:-1])
        return [fingerprints(k[x], t.owners[x], len(t)) for k, x, t in zip(keys, keep, found)]

    def run(batches):
        kept: list[tuple[int, str, bool]] = []

        def done(part: list[tuple[int, str, bool]]):
            """Rows for all but the last of ``part``, each with the next as its successor."""
            texts = [x[1] for x in part]
            changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
            own, new = prints(texts, changed)
            return rows(
                FIELDS, [x[0] for x in part[:-1]], [len(t) for t in texts[:-1]],
                [hashlib.sha256(t.encode()).hexdigest() for t in changed], written(own[:-1]), written(new),
                likeness(own[:-1], new), likeness(own[:-1], own[1:]))

        block = None
        for batch in slices(batches, rows=500):
            for doc_id, text, b, halo in zip(*(c.to_pylist() for c in batch.columns)):
                if b != block:
                    if len(kept) > 1:
                        yield done(kept)
                    kept, block = [], b
                if kept and kept[-1][2]:
                    continue  # the successor of the block's last row is the first halo row
                kept.append((doc_id, text or "", halo))
            if len(kept) > 1:
                yield done(kept)
                kept = kept[-1:]

    arranged = blocks.repartition(min(n_blocks, 4096), "block").sortWithinPartitions(
        "block", "halo", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return arranged.mapInArrow(released(run), FIELDS)
