"""Words of whole texts as arrays, and the plumbing of operators that work on Arrow batches.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and
carriage return; A-Z are lowered. Words are handled as 64-bit hashes: the sum of one random
odd number per byte times a power of an odd base, mixed at the end, all modulo 2**64. Such a
hash of any stretch of bytes comes from two prefix sums, so there is no loop over words.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SLICE_BYTES = 1_000_000
BATCH_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

BYTE_KEYS = np.random.default_rng(20_240_607).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which every bit depends on every other."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse, as many as were asked for so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = (n // 262_144 + 1) * 262_144
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up, self.down


_POWERS = _Powers()


class Stretches:
    """Hashes of any stretch [start, end) of a buffer of bytes."""

    def __init__(self, data: np.ndarray) -> None:
        up, self._down = _POWERS.upto(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_KEYS[data] * up[: len(data)], out=self._sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start])


def string_hashes(strings: pa.Array) -> np.ndarray:
    """A hash per entry of a text or binary array without nulls."""
    strings = strings.cast(pa.binary())
    n, data = len(strings), strings.buffers()[2]
    edges = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + n + 1]
    if data is None or not n:
        return mix(np.zeros(n, np.uint64))
    edges = edges.astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    return Stretches(raw).hash(edges[:-1], edges[1:])


def spans(first: np.ndarray, n: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches of ``n`` things that begin at ``first``; none if there is no thing."""
    return list(zip(first.tolist(), [*first[1:].tolist(), n][: len(first)], strict=True))


class Words:
    """The words of several texts at once, parted by the bytes that ``breaks`` marks.

    ``starts``/``ends`` are byte positions in ``data``, the texts with a line feed after
    each; ``first[i]:first[i + 1]`` are the words of text i.
    """

    def __init__(
        self, texts: list[bytes], lower: bool = True, breaks: np.ndarray = IS_SPACE
    ) -> None:
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.data = LOWER[raw] if lower else raw
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(lengths + 1, out=self.offsets[1:])
        edges = np.flatnonzero(np.diff(breaks[self.data], prepend=True))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        return Stretches(self.data).hash(self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in order; of a shorter sequence, one of the whole."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        factor = np.uint64(pow(_BASE, 2 * k + 1, 1 << 64))
        total += words[k : len(words) - size + 1 + k] * factor
    return mix(total + np.uint64(size))


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct shingles of one text, sorted."""
    return np.unique(shingle_hashes(words, size))


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def slices(
    batch: pa.RecordBatch, text: str = "text", size: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``size`` (SLICE_BYTES) of text, so that arrays stay small."""
    if not batch.num_rows:
        return
    sizes = pc.binary_length(batch.column(text).cast(pa.binary()))
    lengths = sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(lengths + 64) // (size or SLICE_BYTES)
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(start, end - start)


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``df.mapInArrow`` with batches of about ``batch_bytes``, a setting of the session.

    By default a batch has 10,000 rows, whatever their size. Workers outlive their tasks, so at its end a task
    gives back the memory that it has freed.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Freed memory to the system, where the C library can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_slices(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """``map_batches`` with one call per piece of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text):
                yield function(piece)

    return map_batches(df, run, schema)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the folder that all executors share."""
    from starcart.plans.session import scratch_root

    return f"{scratch_root(spark)}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage, survives executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
