"""Reading, splitting and staging shared by the corpus operators."""

from __future__ import annotations

import ctypes
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from thermopanel.session import shared_dir, ship

#: Text handled at once inside a task.
SLICE_ROWS, SLICE_BYTES = 2_000, 2 << 20


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``SLICE_ROWS`` rows: a batch of texts is held whole by the executor and by its
    worker, and the operators work on slices of it anyway."""
    if not 0 < int(spark.conf.get(BATCH)) <= SLICE_ROWS:
        spark.conf.set(BATCH, str(SLICE_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, which must be set."""
    return shared_dir(spark).rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: later passes start from files, not from lineage."""
    small_batches(df.sparkSession)
    path = f"{stage_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_BYTES,
           text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds a bounded amount of text (one text at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if i > start and (i - start >= rows or total + n > size):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(column):
            yield batch.slice(start)


def released(run: Callable) -> Callable:
    """``run``, after which the worker hands unused memory back: workers live on from stage to stage, and what one
    stage left to the allocators would count against the next."""

    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return whole


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
}


def arrow_schema(fields: str) -> pa.Schema:
    """``"name type, name type"`` as an Arrow schema."""
    return pa.schema([(name, ARROW[kind]) for name, kind in (f.split() for f in fields.split(","))])


def rows(fields: str, *columns) -> pa.RecordBatch:
    schema = arrow_schema(fields)
    arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def per_text(docs: DataFrame, keys: str, fields: str, work: Callable[[], Callable[[pa.RecordBatch], dict]],
             inputs: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """One row out for each row in: the key columns and what ``work`` makes of the texts.

    ``work`` is called once a task and returns the function from a slice to its columns.
    """
    schema = ", ".join(x for x in (keys, fields) if x)

    def run(batches):
        step, out = work(), arrow_schema(schema)
        for batch in slices(batches):
            found = step(batch)
            columns = [
                pa.array(found[f.name], f.type) if f.name in found else batch.column(batch.schema.get_field_index(f.name)).cast(f.type)
                for f in out
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    small_batches(docs.sparkSession)
    return docs.select(*inputs).mapInArrow(released(run), schema)


def keep_rows(docs: DataFrame, work: Callable[[], Callable[[pa.RecordBatch], np.ndarray]]) -> DataFrame:
    """The rows, with all their columns, for which ``work`` says true; no shuffle."""

    def run(batches):
        step = work()
        for batch in slices(batches):
            yield batch.filter(pa.array(np.asarray(step(batch), bool)))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(released(run), docs.schema)


ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words_of(text: str, lower: bool = False) -> list[bytes]:
    """The words of one text, for small work and as the plain form of ``Texts``."""
    data = text.encode()
    return (data.translate(ASCII_LOWER) if lower else data).split()


def finished(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return x


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An order-dependent 64-bit mix of two hash arrays."""
    return finished((a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x7F4A7C159E3779B9)))


def _byte_values(seed: int, lower: bool) -> np.ndarray:
    values = finished(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 0x51_7CC1_B727_220A_95 % (1 << 63)) + np.uint64(seed))
    if lower:
        values[65:91] = values[97:123]
    return values


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x5851F42D4C957F2D
_POWERS: dict[str, np.ndarray] = {}
SEGMENT = 1 << 19


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64, for i below n at least."""
    if len(_POWERS.get("up", ())) < n:
        n = max(n, SEGMENT + 4096)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


class Texts:
    """The UTF-8 bytes of a slice of texts as one array, cut into words without Python strings.

    A word is a run of anything but the space and U+0009 to U+000D. ``hashes`` are 64-bit polynomial
    hashes of the words' bytes; two different words share one with a chance of 2**-64.
    """

    def __init__(self, column: pa.Array):
        if column.null_count:
            column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
        self.column = column = column.cast(pa.large_binary())
        n = len(column)
        self.offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = column.buffers()[2]
        whole = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.data = whole[self.offsets[0]:self.offsets[-1]]
        self.offsets = self.offsets - self.offsets[0]
        full = ~SPACE[self.data]
        before, after = np.zeros(len(full), bool), np.zeros(len(full), bool)
        before[1:], after[:-1] = full[:-1], full[1:]
        filled = np.flatnonzero(np.diff(self.offsets))
        before[self.offsets[filled]] = False
        after[self.offsets[filled + 1] - 1] = False
        self.full = full
        self.starts, self.ends = np.flatnonzero(full & ~before), np.flatnonzero(full & ~after) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.sizes = np.diff(self.bounds)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def owners(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self)), self.sizes)

    def summed(self, flags: np.ndarray) -> np.ndarray:
        """Per text, how many of its bytes are flagged."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def hashes(self, seed: int = 0, lower: bool = False) -> np.ndarray:
        return self.spans(self.starts, self.ends, seed, lower)

    def spans(self, starts: np.ndarray, ends: np.ndarray, seed: int = 0, lower: bool = False) -> np.ndarray:
        """Hashes of ascending, disjoint byte ranges; works on a bounded stretch of bytes at a time."""
        values, out, i = _byte_values(seed, lower), np.empty(len(starts), np.uint64), 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, side="right")))
            first, last = starts[i], ends[j - 1]
            up, down = _powers(last - first)
            sums = np.zeros(last - first + 1, np.uint64)
            np.cumsum(values[self.data[first:last]] * up[:last - first], out=sums[1:])
            out[i:j] = (sums[ends[i:j] - first] - sums[starts[i:j] - first]) * down[starts[i:j] - first]
            i = j
        return finished(out)


def texts_column(batch: pa.RecordBatch, name: str = "text") -> Texts:
    return Texts(batch.column(batch.schema.get_field_index(name)))


def ragged(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches pool[start:start + length], one after the other."""
    ends = np.cumsum(lengths)
    shift = starts - (ends - lengths)
    return pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, lengths)]


def remainder(doc_id, modulus: int) -> int:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def remainder_column(column: str, modulus: int):
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


class IdSet:
    """A sorted array of ids, for membership of whole columns."""

    def __init__(self, ids: np.ndarray):
        self.ids = np.unique(ids)

    def has(self, column: pa.Array) -> np.ndarray:
        values = np.array([-1 if v is None else v for v in column.to_pylist()], np.int64) if column.null_count else column.to_numpy(zero_copy_only=False)
        if not len(self.ids):
            return np.zeros(len(values), bool)
        at = np.minimum(np.searchsorted(self.ids, values), len(self.ids) - 1)
        found = self.ids[at] == values
        return found & ~np.asarray(column.is_null()) if column.null_count else found


def marked(docs: DataFrame, ids: DataFrame, limit: int, name: str) -> tuple[DataFrame, IdSet | None]:
    """Which documents are among ``ids`` (one column doc_id).

    Up to ``limit`` ids travel as one sorted array (8 bytes each); beyond it the documents are joined
    and carry the answer in a column ``name``.
    """
    ids = ids.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    few = ids.limit(limit + 1).toArrow().column(0).to_numpy()
    if len(few) <= limit:
        return docs, IdSet(few)
    return docs.join(ids.withColumn(name, F.lit(True)), "doc_id", "left"), None
