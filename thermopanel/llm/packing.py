"""Best-fit packing by minimum bin slack.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens. Bins are planned on the lengths
alone: the table of how many pieces have each length holds ``capacity`` numbers at most, whatever the corpus. For
each bin, a subset-sum dynamic programme over bitsets of the available lengths finds the fullest feasible
combination that holds the longest piece left; that combination is removed - as many times as the
counts allow, so that planning takes few steps for any number of pieces. Pieces are then numbered within their
length (counts per block and length, running totals of these, and numbers within a block), and the n-th piece of
a length takes the n-th place planned for it. A place is an interval of numbers, so the plan stays small too.

Defined cases: a null text counts as empty and is the end id alone; only documents longer than a bin are cut,
the first piece taking what full pieces leave; repeated rows are packed one by one, in any order among
themselves; no documents give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from thermopanel.llm.common import Texts, ragged, released, rows, slices, staged

CAPACITY = 1024
#: Distinct stretches of text whose ids a task remembers; bounds its memory.
REMEMBERED = 200_000
CHECKED = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Tokens:
    """Ids of texts by the tokenizers library, an end id after each.

    Byte-level tokens never run past a space that stands between two visible characters (the space goes with
    what follows), so a text falls into stretches there, and each distinct stretch of a slice is encoded once. The
    vocabulary read by the tokenizers library is handed to tiktoken, which merges alike and faster; one stretch in
    ``CHECKED`` is encoded by both and compared, and a stretch with a special token's text by the former alone.
    """

    #: Bytes known to be visible: printable ASCII and the bytes of longer characters, but see ``_visible``.
    PRINTABLE = np.zeros(256, bool)
    PRINTABLE[0x21:0x7F] = True
    PRINTABLE[0x80:] = True
    #: First two bytes of characters some of which are white space; such characters count as not visible.
    DOUBTFUL = ((0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80))

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = end
        special = self.tokenizer.get_added_tokens_decoder()
        self.mark = next((t.content for t in special.values() if t.special), None)
        self.fast = self._ranked()
        self.reset()

    def _ranked(self):
        """The same vocabulary for the faster library: its ids are the order of the merges."""
        import tiktoken
        from public_tokenizers import PATTERN

        letters = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in letters]
        byte = {chr(b): b for b in letters} | {chr(256 + k): b for k, b in enumerate(others)}
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {bytes(byte[c] for c in piece): i for piece, i in self.tokenizer.get_vocab().items() if piece not in added}
        return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def reset(self) -> None:
        self.number: dict[int, int] = {}
        self.pool = np.zeros(0, np.uint32)
        self.lengths = np.zeros(0, np.int64)

    def _visible(self, data: np.ndarray) -> np.ndarray:
        out = self.PRINTABLE[data]
        for a, b in self.DOUBTFUL:
            at = np.flatnonzero((data[:-1] == a) & (data[1:] == b))
            for k in range(3):
                out[np.minimum(at + k, len(data) - 1)] = False
        return out

    def _stretches(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """First byte of every stretch, and the bounds of each text's stretches."""
        data = texts.data
        opens = np.zeros(len(data), bool)
        if len(data) > 2:
            seen = self._visible(data)
            opens[1:-1] = (data[1:-1] == 0x20) & seen[:-2] & seen[2:]
        # a neighbour in the next text is none
        opens[texts.offsets[1:-1][texts.offsets[1:-1] < len(data)]] = False
        ends = texts.offsets[1:] - 1
        opens[ends[ends >= 0]] = False
        opens[texts.offsets[:-1][np.diff(texts.offsets) > 0]] = True
        starts = np.flatnonzero(opens)
        return starts, np.searchsorted(starts, texts.offsets)

    def _encode(self, stretches: list[bytes]) -> list[list[int]]:
        strings = [s.decode() for s in stretches]
        out = [self._library(s) if self.mark and self.mark in s else self.fast.encode_ordinary(s) for s in strings]
        for k in range(0, len(strings), CHECKED):
            if out[k] != self._library(strings[k]):
                raise ValueError(f"ids differ from the tokenizers library's: {strings[k]!r}")
        return out

    def _library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def flat(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the bounds of each text's."""
        texts = Texts(column)
        starts, bounds = self._stretches(texts)
        ends = np.append(starts[1:], len(texts.data)) if len(starts) else starts
        keys, first, inverse = np.unique(texts.spans(starts, ends), return_index=True, return_inverse=True)
        if len(self.number) > REMEMBERED:
            self.reset()
        new = [k for k, key in enumerate(keys.tolist()) if key not in self.number]
        if new:
            data = texts.data.tobytes()
            found = self._encode([data[starts[first[k]]:ends[first[k]]] for k in new])
            for k, key in enumerate(keys[new].tolist(), len(self.lengths)):
                self.number[key] = k
            self.pool = np.concatenate([self.pool, np.fromiter((i for x in found for i in x), np.uint32)])
            self.lengths = np.concatenate([self.lengths, [len(x) for x in found]]).astype(np.int64)
        at = np.fromiter(map(self.number.__getitem__, keys.tolist()), np.int64, len(keys))[inverse]
        begin = np.cumsum(self.lengths) - self.lengths
        # the end id of each text is a stretch of its own
        pool, lengths = np.append(self.pool, np.uint32(self.end)), np.append(self.lengths, 1)
        begin = np.append(begin, len(self.pool))
        at = np.insert(at, bounds[1:], len(self.lengths))
        bounds = bounds + np.arange(len(bounds))
        ids = ragged(pool, begin[at], lengths[at])
        return ids, np.concatenate(([0], np.cumsum(lengths[at])))[bounds]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        flat, bounds = self.flat(pa.array(texts, pa.string()))
        return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: full ones, but for the first."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces_of(docs: DataFrame, path: str, end: int = 2, capacity: int = CAPACITY) -> DataFrame:
    def run(batches):
        tokens = Tokens(path, end)
        for batch in slices(batches):
            flat, bounds = tokens.flat(batch.column(1))
            data = flat.astype("<u4").tobytes()
            out = [
                (doc_id, k, start, length, zlib.crc32(data[4 * (a + start):4 * (a + start + length)]))
                for doc_id, a, b in zip(batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist())
                for k, (start, length) in enumerate(cut(b - a, capacity))
            ]
            yield rows(PIECES, *zip(*out))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(run), PIECES)


def fullest(lengths: np.ndarray, counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """The combination of available lengths that fills ``room`` most: (length, how often).

    Bit s of a set says that sum s can be reached. Counts are split into powers of two, so a length takes few
    steps; longer lengths come first, and the way back takes the latest items that can be left out last.
    """
    reach, whole = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    for length, count in zip(lengths.tolist(), counts.tolist()):
        if length > room:
            continue
        most, chunk = min(count, room // length), 1
        while most > 0:
            take = min(chunk, most)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & whole
            most -= take
            chunk *= 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            out[length] = out.get(length, 0) + take
    return sorted(out.items(), reverse=True)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as (how many alike, [(length, how often in each)]) from the number of pieces of each length."""
    left, out = counts.astype(np.int64).copy(), []
    while True:
        full = np.flatnonzero(left)[::-1]
        if not len(full):
            return out
        longest = int(full[0])
        left[longest] -= 1
        full = full[left[full] > 0]
        found = dict(fullest(full, left[full], capacity - longest))
        left[longest] += 1
        found[longest] = found.get(longest, 0) + 1
        times = min(int(left[n]) // k for n, k in found.items())
        for n, k in found.items():
            left[n] -= k * times
        out.append((times, sorted(found.items(), reverse=True)))


def places(bins: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """Per length, in order: (first number, first sequence, how often in a bin, offset in it, number of bins)."""
    out: dict[int, list[tuple[int, int, int, int, int]]] = {}
    given: dict[int, int] = {}
    sequence = 0
    for times, members in bins:
        offset = 0
        for length, often in members:
            first = given.get(length, 0)
            out.setdefault(length, []).append((first, sequence, often, offset, times))
            given[length] = first + often * times
            offset += length * often
        sequence += times
    return out


def numbered(pieces: DataFrame, blocks: int) -> DataFrame:
    """Column ``number``: 0, 1, ... within each length, whichever task a piece is in.

    A length may hold a third of all pieces; so pieces are numbered within (length, block) and the blocks'
    counts added up, a table of ``blocks`` rows for each length.
    """
    keyed = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)).cast("int"))
    within = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "start", "ids_crc32")
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = keyed.groupBy("length", "block").agg(F.count("*").alias("n")).select(
        "length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return keyed.withColumn("number", F.row_number().over(within) - 1).join(totals, ["length", "block"]).withColumn(
        "number", F.col("number") + F.col("base")).drop("base", "block")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to the pieces."""
    spark = pieces.sparkSession
    sizes = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in sizes:
        counts[length] = n
    planned = spark.sparkContext.broadcast(places(plan(counts, capacity)))
    # about 100,000 pieces a block
    blocks = max(64, int(counts.sum() // 100_000))
    schema = f"{PIECES}, sequence_id long, offset long"

    def place(batches):
        starts = {n: np.array([x[0] for x in found]) for n, found in planned.value.items()}
        table = {n: np.array(found, np.int64) for n, found in planned.value.items()}
        for batch in batches:
            lengths = batch.column(3).to_numpy()
            number = batch.column(5).to_numpy()
            sequence, offset = np.empty(len(number), np.int64), np.empty(len(number), np.int64)
            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                row = table[n][np.searchsorted(starts[n], number[at], side="right") - 1]
                which = number[at] - row[:, 0]
                sequence[at] = row[:, 1] + which // row[:, 2]
                offset[at] = row[:, 3] + which % row[:, 2] * n
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[
                "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    names = [x.split()[0] for x in PIECES.split(", ")]
    return numbered(pieces, blocks).select(*names, "number").mapInArrow(released(place), schema)


def pack_documents(docs: DataFrame, path: str, end: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(staged(pieces_of(docs, path, end, capacity)), capacity)
