"""Blocks of documents: what one Python call takes at a time, stored as one packed row each."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from termlode.llm.fingerprints import byte_lengths

_OPTIONS = pa.ipc.IpcWriteOptions(compression="zstd")


def text_blocks(
    batches: Iterator[pa.RecordBatch], block_bytes: int
) -> Iterator[tuple[int, pa.Table]]:
    """``(block, rows)``: about ``block_bytes`` of text each, at least one row.

    Rows stay in their order and a document is never cut. Block numbers hold the number of
    the task, so they are unique as soon as they are stored.
    """
    first = TaskContext.get().partitionId() << 32
    waiting: list[pa.RecordBatch] = []
    size = number = 0
    for batch in batches:
        ends = np.cumsum(byte_lengths(batch.column("text")))
        low = 0
        while low < batch.num_rows:
            before = ends[low - 1] if low else 0
            high = int(np.searchsorted(ends, before + block_bytes - size, "right"))
            high = max(high, low + (not waiting))
            if high > low:
                waiting.append(batch.slice(low, high - low))
                size += int(ends[high - 1] - before)
            if high < batch.num_rows:
                yield first + number, pa.Table.from_batches(waiting)
                waiting, size, number = [], 0, number + 1
            low = high
    if waiting:
        yield first + number, pa.Table.from_batches(waiting)


def pack(**columns) -> bytes:
    """Arrays of one length as compressed bytes."""
    batch = pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns)
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=_OPTIONS) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each of several runs of values that lie one after the other."""
    ends = np.cumsum(counts)
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[ends] - total[ends - counts]


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


_ZSTD = pa.Codec("zstd", compression_level=3)


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers from 0 on, each in its narrowest type, compressed.

    The first bytes of all numbers come first, then all second bytes: most are alike.
    """
    parts = [np.array([len(arrays), *map(len, arrays)], "<i8").tobytes()]
    for array in arrays:
        largest = int(array.max()) if len(array) else 0
        size = max(1, -(-largest.bit_length() // 8))
        planes = np.ascontiguousarray(array).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]
        parts += [bytes([size]), planes.T.tobytes()]
    data = b"".join(parts)
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def expand(data: bytes) -> list[np.ndarray]:
    """The arrays of :func:`squeeze`, as 64-bit numbers."""
    length = int.from_bytes(data[:8], "little")
    data = _ZSTD.decompress(data[8:], decompressed_size=length, asbytes=True)
    number = int(np.frombuffer(data, "<i8", 1)[0])
    at, arrays = 8 * (number + 1), []
    for n in np.frombuffer(data, "<i8", number, 8).tolist():
        size = data[at]
        values = np.zeros((n, 8), np.uint8)
        values[:, :size] = np.frombuffer(data, np.uint8, n * size, at + 1).reshape(size, n).T
        arrays.append(values.view("<i8").ravel())
        at += 1 + n * size
    return arrays


def give_back() -> None:
    """Hand free memory of a Python worker, which lives on between tasks, to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return None


_TRIM = _trim()
