"""Large shuffles of numbers in packed blocks.

Operators on all word windows move one number per word of the corpus. As rows that would be many
times the input; here a task packs the numbers for one bucket into one binary value, Spark
shuffles those, and the bucket's task unpacks them. The number of buckets follows the bytes of
input, so a bucket holds the same amount at any size, and what is frequent is reduced to one
entry per block before it is sent, so a frequent window fills no bucket.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archiveloom.operators.batches import small_batches  # noqa: F401, used as packing.small_batches

BLOCK_BYTES = 4 << 20  # text handled at a time; a longer text is a block of its own
BUCKET_BYTES = 16 << 20  # text whose windows meet in one bucket, on average

_Out = TypeVar("_Out")


def trimmed(out: _Out) -> _Out:
    """``out``, after the allocators have given back what they keep of freed memory.

    A Python worker outlives its tasks; what numpy and Arrow freed would stay with it, beside the
    heap of the executor, through steps that need no Python at all.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None  # glibc has it
    if trim is not None:
        trim(0)
    return out


def trimming(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` on the batches of a task, whose worker is trimmed when the task ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            trimmed(None)

    return run


def bucket_bits(docs: DataFrame, text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> int:
    """Log2 of the number of buckets for all texts of ``docs``."""
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(2, int(np.ceil(np.log2(max(1, total / bucket_bytes)))))


def blocks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.Table]:
    """Record batches cut and joined to tables of about ``BLOCK_BYTES`` of text, whole rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        upto, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < len(sizes):
            done = upto[at - 1] if at else 0
            stop = min(len(sizes), int(np.searchsorted(upto, done + BLOCK_BYTES - size, "left")) + 1)
            held.append(batch.slice(at, stop - at))
            size += int(upto[stop - 1] - done)
            at = stop
            if size >= BLOCK_BYTES:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def low_bytes(x: np.ndarray, n: int) -> bytes:
    """The ``n`` low bytes of each 64-bit number."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def from_low_bytes(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(data) // n, 8), np.uint8)
    out[:, :n] = np.frombuffer(data, np.uint8).reshape(-1, n)
    return out.reshape(-1).view("<u8")


def runs(*steps: tuple[np.ndarray, int]) -> np.ndarray:
    """Where a new run starts: (values, step) keep a run if each value is the last plus step."""
    n = len(steps[0][0])
    new = np.zeros(n, bool)
    new[:1] = True
    for values, step in steps:
        new[1:] |= values[1:] != values[:-1] + values.dtype.type(step)
    return np.flatnonzero(new)


def run_lengths(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one after another."""
    first = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)


def split_by(bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by bucket, and where each of the ``n`` buckets begins in it."""
    kind = np.uint16 if n <= 1 << 16 else np.uint32
    order = np.argsort(bucket.astype(kind), kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))
