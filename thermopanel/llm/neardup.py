"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, star-shaped edges.

A document is the set of its distinct shingles. Documents with the same set form a class; everything below works
on one representative per class (its smallest doc_id), so thousands of exact copies cost one.

Signature. One permutation of the hash space is cut into ``BINS`` equal bins, and the smallest hash in a bin is its
value. An empty bin takes the value of a bin drawn by a hash of (bin, attempt), again until it is not empty
(optimal densification). ``PERMUTATIONS`` such sketches keep short documents, whose bins are mostly borrowed,
as findable as long ones.

Candidates. ``ROWS`` neighbouring bins make a band, equal bands a bucket. A bucket of n members gives n - 1
edges: its centre with each other member, never all pairs. A candidate is confirmed on full sets. What a
star can miss is a link between two members that are not linked with its centre. So the components of the stars'
links are set against the buckets: members of one bucket that are still in different components are compared
too, if their rarest shingles and the low bits of their signatures leave it possible. After that two texts that share a bucket
are linked, compared, or ruled out.

Components are found by alternating large and small stars over the confirmed links, written to the shared folder
each round.

Defined cases: a null text, or one without words, has no shingles and is linked with nothing; fewer words than
a shingle make one shingle of them all; no rows give no rows; other columns are ignored. Where an id is null or stands for
different texts, rows are linked by their place in the table instead of their id (``by_row``): a component's id is the smallest
id in it, null if none of its rows has one. ``filter_documents`` decides row by row: of a component one row stays, the one with
the smallest id (of equals the first), also where ids repeat or are null; rows without shingles all stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from thermopanel.llm.common import Texts, finished, keep_rows, marked, mixed, released, rows, slices, staged

WORDS = 4
SIMILARITY = 80           # percent
PERMUTATIONS, BINS, ROWS = 10, 30, 5
#: Signature values of which two bits each go with a document, and how many must agree for a comparison of sets that have
#: ``FEW`` shingles or more: 217.6 of 256 agree on average at a similarity of 0.8, with a standard deviation of 5.7, so 160
#: are ten deviations off. Smaller sets, whose bins are mostly borrowed and vary together, are always compared.
VALUES, AGREE, FEW = 256, 160, 64
BANDS = PERMUTATIONS * BINS // ROWS
ATTEMPTS = 64
#: Ids sent to the tasks as one array (8 bytes each); beyond, documents are joined with them.
WANTED_LIMIT = 2_000_000
#: Cells of the table by which shingles are ordered from rare to frequent (8 bytes each).
RARITY = 1 << 18


def shingles(texts: Texts, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending within it, and where each text's begin (n + 1 bounds)."""
    hashes, sizes = texts.hashes(lower=True), texts.sizes
    owner = texts.owners
    n = len(hashes)
    grams = hashes
    for k in range(1, words):
        grams = mixed(grams[: max(n - k, 0)], hashes[k:])
    same = owner[: len(grams)] == owner[words - 1:] if n >= words else np.zeros(0, bool)
    grams, grams_owner = grams[same], owner[: len(same)][same]
    # the whole sequence of a short text, with its length mixed in
    short = np.flatnonzero((sizes > 0) & (sizes < words))
    if len(short):
        first = texts.bounds[short]
        value = finished(sizes[short].astype(np.uint64))
        for k in range(words - 1):
            more = k < sizes[short]
            value[more] = mixed(value[more], hashes[first[more] + k])
        grams, grams_owner = np.concatenate([grams, value]), np.concatenate([grams_owner, short])
    order = np.lexsort((grams, grams_owner))
    grams, grams_owner = grams[order], grams_owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (grams_owner[1:] != grams_owner[:-1])
    grams, grams_owner = grams[new], grams_owner[new]
    return grams, np.searchsorted(grams_owner, np.arange(len(texts) + 1))


_PROBES: dict[int, np.ndarray] = {}


def _probes(bins: int) -> np.ndarray:
    """Which bin an empty bin asks at each attempt: the same for every document."""
    if bins not in _PROBES:
        asked = np.arange(bins * ATTEMPTS, dtype=np.uint64).reshape(bins, ATTEMPTS)
        _PROBES[bins] = (finished(asked + np.uint64(0x51ED2701)) % np.uint64(bins)).astype(np.int64)
    return _PROBES[bins]


EMPTY = np.uint64(2**64 - 1)


def sketches(grams: np.ndarray, bounds: np.ndarray, permutations: int = PERMUTATIONS, bins: int = BINS) -> np.ndarray:
    """Densified signatures, (texts, permutations * bins); texts must have a shingle."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    out = np.empty((n, permutations * bins), np.uint64)
    probes = _probes(bins)
    for p in range(permutations):
        h = finished(grams ^ finished(np.full(1, p + 1, np.uint64)))
        cell = owner * bins + ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        values = np.full(n * bins, EMPTY)
        np.minimum.at(values, cell, h)
        table = values.reshape(n, bins)
        empty = table == EMPTY
        row, column = np.nonzero(empty)
        filled = table.copy()
        left = np.arange(len(row))
        for attempt in range(ATTEMPTS):
            if not len(left):
                break
            found = table[row[left], probes[column[left], attempt]]
            good = found != EMPTY
            filled[row[left[good]], column[left[good]]] = found[good]
            left = left[~good]
        if len(left):  # never a full bin in all attempts: the text's smallest value
            filled[row[left], column[left]] = table.min(axis=1)[row[left]]
        out[:, p * bins:(p + 1) * bins] = filled
    return out


def bands(signatures: np.ndarray, size: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band, its place included."""
    n, width = signatures.shape
    parts = signatures.reshape(n, width // size, size)
    key = np.broadcast_to(np.arange(width // size, dtype=np.uint64), (n, width // size)).copy()
    for k in range(size):
        key = mixed(key, parts[:, :, k])
    return key


def low_bits(signatures: np.ndarray) -> np.ndarray:
    """The two lowest bits of ``VALUES`` of the values, 32 in an integer."""
    low = finished(signatures[:, :VALUES]) & np.uint64(3)
    return sum(low[:, k::32] << np.uint64(2 * k) for k in range(32)).view(np.int64)


LONGS = VALUES // 32
SIGNED = "doc_id long, n_shingles long, name_hi long, name_lo long, bits array<long>, bands array<long>"


def signed(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, a 128-bit name of the set, signature bits and band keys."""

    def lists(values: np.ndarray) -> pa.ListArray:
        n, width = values.shape
        return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * width, pa.array(values.reshape(-1)))

    def run(batches):
        for batch in slices(batches):
            grams, bounds = shingles(Texts(batch.column(1)), words)
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            names, bits, keys = (np.zeros((len(sizes), k), np.int64) for k in (2, LONGS, BANDS))
            if len(full):
                for k in range(2):
                    parts = finished(grams + np.uint64((k + 1) * 0xA24BAED4963EE407 % 2**64))
                    names[full, k] = np.add.reduceat(parts, bounds[full]).view(np.int64)
                found = sketches(grams, np.append(bounds[full], len(grams)))
                bits[full], keys[full] = low_bits(found), bands(found).view(np.int64)
            yield rows(SIGNED, batch.column(0), sizes, names[:, 0], names[:, 1], lists(bits), lists(keys))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(run), SIGNED)


def confirmed(pairs: DataFrame, docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity; only the texts in question are moved."""
    schema = "a long, b long"
    pairs = staged(pairs)
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    texts = wanted_texts(docs, wanted)

    def run(batches):
        for part in slices(batches, rows=1000, text="one"):
            for batch in slices([part], text="other"):
                (x, xb), (y, yb) = (shingles(Texts(batch.column(k)), words) for k in (2, 3))
                keep = pa.array([_similar(x[xb[i]:xb[i + 1]], y[yb[i]:yb[i + 1]], similarity) for i in range(len(batch))], pa.bool_())
                yield rows(schema, batch.column(0).filter(keep), batch.column(1).filter(keep))

    return (
        pairs.join(texts.withColumnsRenamed({"doc_id": "a", "text": "one"}), "a")
        .join(texts.withColumnsRenamed({"doc_id": "b", "text": "other"}), "b")
        .select("a", "b", "one", "other").mapInArrow(released(run), schema)
    )


def _similar(a: np.ndarray, b: np.ndarray, similarity: int) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= similarity * (len(both) - common)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all linked nodes: the smallest node reachable. Large and small stars in turn."""
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(
            least.select("a", F.col("m").alias("b"))).distinct()
        after = staged(small.withColumn("h", F.xxhash64("a", "b")))
        if _mark(after) == _mark(edges.withColumn("h", F.xxhash64("a", "b"))):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        edges = after.select("a", "b")


def _mark(edges: DataFrame) -> tuple:
    """Two numbers that tell edge sets apart."""
    return tuple(edges.agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)"))).first())


def possible(similarity: int = SIMILARITY):
    """Column: sizes of the sides x and y, and the signature bits of large sets, leave the similarity possible."""
    low = F.lit(0x5555555555555555)
    differ = None
    for k in range(LONGS):
        z = F.col("x.bits")[k].bitwiseXOR(F.col("y.bits")[k])
        n = F.bit_count((z.bitwiseOR(F.shiftrightunsigned(z, 1))).bitwiseAND(low))
        differ = n if differ is None else differ + n
    return ((F.least("x.n_shingles", "y.n_shingles") < FEW) | (differ <= VALUES - AGREE)) & (
        F.lit(100) * F.least("x.n_shingles", "y.n_shingles") >= F.lit(similarity) * F.greatest("x.n_shingles", "y.n_shingles"))


def links_of(reps: DataFrame, docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """All confirmed links (a, b) between the classes; ``reps``: rows of ``signed``, one for each class."""
    facts = ["doc_id", "n_shingles", "bits"]
    buckets = reps.select("doc_id", F.explode("bands").alias("bucket"))
    centres = buckets.groupBy("bucket").agg(F.min("doc_id").alias("centre"), F.count("*").alias("n")).where("n > 1")
    members = staged(buckets.join(centres, "bucket").select("bucket", "doc_id", "centre"))
    known = reps.select(*facts)

    def judged(pairs: DataFrame) -> DataFrame:
        x = known.withColumnRenamed("doc_id", "a").alias("x")
        y = known.withColumnRenamed("doc_id", "b").alias("y")
        return pairs.join(x, "a").join(y, "b").where(possible(similarity)).select("a", "b")

    stars = members.where("doc_id > centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct()
    found = staged(confirmed(judged(stars), docs, words, similarity))
    named = components(found).withColumnRenamed("node", "doc_id")
    placed = members.join(named, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    several = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    # members that are not their bucket's centre: its star has compared the centre with all others
    left = staged(placed.where("doc_id > centre").join(several, "bucket").select("doc_id", "component").distinct())
    rest = judged(staged(sharing(left, docs, words, similarity)).join(stars, ["a", "b"], "left_anti"))
    return found.union(staged(confirmed(rest, docs, words, similarity)))


def wanted_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and text of the documents among ``wanted`` (one column doc_id), written to the shared folder."""
    texts, ids = marked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), wanted, WANTED_LIMIT, "__wanted")
    if ids is not None:
        shared = docs.sparkSession.sparkContext.broadcast(ids)
        texts = keep_rows(texts, lambda: lambda batch: shared.value.has(batch.column(0)))
    else:
        texts = texts.where("__wanted")
    return staged(texts.select("doc_id", "text"))


def sharing(left: DataFrame, docs: DataFrame, words: int, similarity: int) -> DataFrame:
    """Pairs (a, b) of ``left`` (doc_id, component), components differing, that can be similar by their rare shingles.

    Shingles are put in one order for all texts, rare ones first. Similar sets of m <= n shingles have at least
    s / (100 + s) * (m + n) in common, so the first one they share is followed by that many in both: it is among the first
    (100 - s) % of the larger set and among the first (100 - s) / (100 + s) of the smaller. Texts that have only a
    frequent passage in common never meet, however many they are. The order goes by counts in ``RARITY`` cells;
    cells that several shingles share make it less sharp, never wrong.
    """
    texts = wanted_texts(docs, left.select("doc_id"))

    def count(batches):
        total = np.zeros(RARITY, np.int64)
        for batch in slices(batches):
            total += np.bincount(_cell(shingles(Texts(batch.column(1)), words)[0]), minlength=RARITY)
        full = np.flatnonzero(total)
        yield rows("cell long, n long", full, total[full])

    table = texts.mapInArrow(released(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(RARITY, np.int64)
    counts[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    fields = "doc_id long, shingle long, size long, place long"

    def first(batches):
        for batch in slices(batches):
            grams, bounds = shingles(Texts(batch.column(1)), words)
            sizes = np.diff(bounds)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            grams = grams[np.lexsort((grams, shared.value[_cell(grams)], owner))]
            place = np.arange(len(grams)) - bounds[owner]
            keep = 100 * (sizes[owner] - place) >= similarity * sizes[owner]
            yield rows(fields, batch.column(0).take(pa.array(owner[keep])), grams[keep].view(np.int64), sizes[owner[keep]], place[keep])

    table = staged(texts.mapInArrow(released(first), fields).join(left, "doc_id"))
    several = table.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    table = staged(table.join(several.select("shingle"), "shingle", "left_semi"))
    both = similarity * (F.col("x.size") + F.col("y.size"))
    return (
        table.where(F.lit(100 + similarity) * (F.col("size") - F.col("place")) >= F.lit(2 * similarity) * F.col("size")).alias("x")
        .join(table.alias("y"), (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") != F.col("y.component"))
              & (F.struct("x.size", "x.doc_id") < F.struct("y.size", "y.doc_id"))
              & (F.lit(100 + similarity) * F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place")) >= both))
        .select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()
    )


def _cell(grams: np.ndarray) -> np.ndarray:
    return (finished(grams) % np.uint64(RARITY)).astype(np.int64)


def label(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    rows_ = staged(signed(docs, words))
    own = F.struct("n_shingles", "name_hi", "name_lo")
    unclear = rows_.groupBy("doc_id").agg(F.min(own).alias("low"), F.max(own).alias("high")).where("doc_id IS NULL OR low < high")
    if not unclear.isEmpty():
        return by_row(docs, words, similarity)[2].drop("row", "group")
    return _kept(_labelled(rows_, docs, words, similarity))


def _kept(labelled: DataFrame) -> DataFrame:
    return labelled.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _labelled(rows_: DataFrame, docs: DataFrame, words: int, similarity: int) -> DataFrame:
    """doc_id, n_shingles, component_id for written rows of ``signed``, whose ids are not null and name one set each."""
    name = ["n_shingles", "name_hi", "name_lo"]
    narrow = rows_.select("doc_id", *name)
    classes = staged(narrow.where("n_shingles > 0").groupBy(*name).agg(F.min("doc_id").alias("rep")))
    # repeated rows are one row here
    reps = rows_.join(classes.select(F.col("rep").alias("doc_id"), *name), ["doc_id", *name], "left_semi")
    links = links_of(reps.dropDuplicates(["doc_id"]), docs, words, similarity)
    named = components(links).withColumnRenamed("node", "rep")
    groups = classes.join(named, "rep", "left").select(*name, F.coalesce("component", "rep").alias("component_id"))
    return narrow.join(groups, name, "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def by_row(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> tuple[DataFrame, str, DataFrame]:
    """The documents, written with a column for their row; its name (the first of ``row``, ``row_``, ... that is free); and
    doc_id, n_shingles, component_id, row, group and kept of each row."""
    place = "row"
    while place in docs.columns:
        place += "_"
    numbered = staged(docs.withColumn(place, F.monotonically_increasing_id()))
    texts = numbered.select(F.col(place).alias("doc_id"), "text")
    found = staged(_labelled(staged(signed(texts, words)), texts, words, similarity))
    ids = numbered.select(F.col(place).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    rows_ = found.select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("group")).join(ids, "row")
    least = rows_.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return numbered, place, _kept(rows_.join(least, "group").select("doc_id", "n_shingles", "component_id", "row", "group"))


def filter_documents(docs: DataFrame, words: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """One row of each component, with all its columns."""
    columns = docs.columns
    rows_ = staged(signed(docs, words))
    if not rows_.groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id IS NULL OR n > 1").isEmpty():
        numbered, place, found = by_row(docs, words, similarity)
        first = F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
        chosen = found.groupBy("group").agg(first.alias(place)).select(place)
        return numbered.join(chosen, place, "left_semi").select(*columns)
    gone = _kept(_labelled(rows_, docs, words, similarity)).where("NOT kept").select("doc_id")
    docs, ids = marked(docs, staged(gone), WANTED_LIMIT, "__gone")
    if ids is None:
        return docs.where("__gone IS NULL").select(*columns)
    shared = docs.sparkSession.sparkContext.broadcast(ids)
    return keep_rows(docs, lambda: lambda batch: ~shared.value.has(batch.column(batch.schema.get_field_index("doc_id"))))
