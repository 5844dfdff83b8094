"""Text columns as flat byte arrays, for operators that run over Arrow batches.

An Arrow string column is one UTF-8 buffer plus offsets. The helpers here view
it as numpy arrays, so that words, lines and hashes of a whole batch are found
by array operations instead of a Python loop over documents. Work is cut into
slices of bounded size: a batch of long documents never needs more than a few
times ``SLICE_BYTES`` (or the longest single document) of working memory.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from .shipping import ship_package

SLICE_BYTES = 1 << 20
#: Rows in one Arrow batch between the JVM and a Python worker.
BATCH_ROWS = 512
#: Words longer than this are hashed one by one instead of by the power table.
LONG_WORD = 1 << 16

WHITESPACE = np.zeros(256, bool)
WHITESPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

U64 = np.uint64
_MIX1, _MIX2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15  # odd, so it is invertible modulo 2**64
_BYTE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)


def limit_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Rows of one Arrow batch for the operator that is about to run: a batch
    of long rows then stays within a few MB on either side. Also sees to it
    that Python workers find the package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> U64(33))
    x = x * _MIX1
    x = x ^ (x >> U64(29))
    x = x * _MIX2
    return x ^ (x >> U64(32))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n, by doubling."""
    out = np.ones(max(n, 1), U64)
    done = 1
    step = base & (2**64 - 1)
    while done < n:
        take = min(done, n - done)
        out[done:done + take] = out[:take] * U64(step)
        done += take
        step = step * step & (2**64 - 1)
    return out


_POWERS = powers(LONG_WORD)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or
                              pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows of about ``limit`` text bytes (one row at least)."""
    if not batch.num_rows:
        return
    _, off = flat(batch.column(text))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte as it is."""
    return raw + (((raw >= 65) & (raw <= 90)).astype(np.uint8) << 5)


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` (documents cut
    words), and the first word of each document (one entry more than documents).
    All white space is ASCII, so bytes suffice."""
    solid = ~WHITESPACE[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[off] = True
    first = first[:-1]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1] | first[1:]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:] | first[1:]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; the spans ascend and don't overlap."""
    if not len(starts):
        return np.empty(0, U64)
    size = ends - starts
    # Two indices for each span: the second one drops what lies between spans.
    edges = np.empty(2 * len(starts), np.int64)
    edges[0::2], edges[1::2] = starts, ends
    place = np.arange(len(raw) + 1)
    place[:-1] -= np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(raw)]))
    np.minimum(place, LONG_WORD - 1, out=place)
    value = np.zeros(len(raw) + 1, U64)
    value[:-1] = _BYTE[raw] * _POWERS[place[:-1]]
    out = mix(np.add.reduceat(value, edges)[0::2] + size.astype(U64) * U64(_BASE))
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def per_row(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive ``edges``."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``values[start:start + size]``, one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])]


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys as one table each.

    For a partition that is sorted by ``keys``: a group is held only while it
    is read, and costs no Spark task or query plan of its own.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            col = batch.column(k)
            if batch.num_rows > 1:
                a, b = col.slice(0, len(col) - 1), col.slice(1)
                differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
                nulls = col.is_null().to_numpy(zero_copy_only=False)
                change[1:] |= differ | (nulls[1:] != nulls[:-1])
        head = tuple(batch.column(k)[0].as_py() for k in keys)
        if last is not None and head != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(change), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
    if held:
        yield pa.Table.from_batches(held)
