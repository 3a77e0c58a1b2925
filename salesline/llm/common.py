"""Small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BATCH_BYTES = 1 << 19
BITMAP = 1 << 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a fixed bijection, wrapping arithmetic)."""
    x = (x ^ (x >> U64(30))) * MIX1
    x = (x ^ (x >> U64(27))) * MIX2
    return x ^ (x >> U64(31))


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch so that each piece holds about ``limit`` bytes of ``column``, one row at least."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start, total = np.cumsum(sizes.astype(np.int64)), 0, 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(ends, total + limit, side="right")))
        yield batch.slice(start, stop - start)
        start, total = stop, int(ends[stop - 1])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows end to end, and len + 1 offsets; a null is empty."""
    rows = pa.compute.fill_null(column.cast(pa.large_string()), "")
    if isinstance(rows, pa.ChunkedArray):
        rows = rows.combine_chunks()
    _, offsets, data = rows.buffers()
    at = np.frombuffer(offsets, np.int64, len(rows) + 1, rows.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def _table(self, base: int, n: int) -> np.ndarray:
        out = np.full(n, base & ((1 << 64) - 1), U64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = self._table(self.base, n), self._table(self.inverse, n)
        return self.up, self.down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, equal for equal bytes wherever they stand."""
    up, down = powers.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


def words_of(data: np.ndarray, offsets: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the index of the first word of each row.

    ``letter`` tells for each byte value whether it belongs to words. Words never cross rows.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = letter[data]
    before = np.concatenate(([False], inside[:-1]))
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins = inside & ~before
    begins[cuts] = inside[cuts]
    after = np.concatenate((inside[1:], [False]))
    stops = inside & ~after
    stops[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lower_table() -> np.ndarray:
    """Maps the bytes A-Z to a-z and every other byte to itself."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def trimmed(work):
    """``work`` over Arrow batches, giving unused memory back at its end: idle workers are kept and share the machine."""

    def run(batches):
        import ctypes

        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):
                pass  # another C library

    return run


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns, whatever their case, that an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def bit_table(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which of the numbers below ``2 ** bits`` occur in a column, eight to a byte: its size is fixed by ``bits``."""
    n = F.col(column) + 1
    rows = keys.groupBy(F.bitmap_bucket_number(n).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("m"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows.toLocalIterator():
        part = np.frombuffer(bytes(r.m), np.uint8)
        out[(r.b - 1) * 4096 : (r.b - 1) * 4096 + len(part)] = part
    return out


def bit_test(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each number is in a table of ``bit_table``."""
    return (packed[(keys >> keys.dtype.type(3)).astype(np.int64)] >> (keys & keys.dtype.type(7)).astype(np.uint8)) & 1 == 1


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Which of the numbers 0 to ``BITMAP - 1`` occur in a column, as booleans."""
    return np.unpackbits(bit_table(keys, column, BITMAP.bit_length() - 1), bitorder="little").astype(bool)


def text_key(name: str = "doc_id"):
    """crc32 of the id written as text, as the folds of the labelled rows are defined."""
    return F.crc32(F.col(name).cast("string"))
