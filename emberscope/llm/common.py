"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope.session import scratch_dir

#: Bytes of text that one step of a task holds in numpy arrays; a longer text is a step of its own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, whatever executors are lost later."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_HELD: dict = {}


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """The one large object that this worker keeps from task to task; another key takes its place."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def drop_held() -> None:
    _HELD.clear()


def give_back() -> None:
    """Return the free memory of this process to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], holds: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task`` of mapInArrow, in a worker that keeps no more memory than it needs.

    As it begins, what other tasks held is dropped, unless it ``holds`` an object itself. As it ends, freed memory goes back
    to the system: workers wait beside their executor for a minute, while joins and sorts of the next stages need the room.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not holds:
            drop_held()
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_fold(doc_id: str = "doc_id") -> Column:
    """Remainder by four of the crc32 of an id written as text; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes together, or one longer text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, nulls being empty, and where each row begins (one more offset than rows)."""
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_CODES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER] | np.uint64(1)
_CODES[_SPACE] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all input bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_spans(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and the row it lies in; words are runs of anything but ASCII white space."""
    solid = ~_SPACE[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    rows = bounds[:-1][bounds[:-1] < bounds[1:]]
    first[rows] = solid[rows]
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(bounds, starts, side="right") - 1


def word_hashes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, upper-case A-Z being read as lower case."""
    if not len(starts):
        return np.empty(0, np.uint64)
    gaps = np.diff(starts, append=len(raw))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, gaps)
    powers = np.full(int(gaps.max()), _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    return mix(np.add.reduceat(_CODES[raw[starts[0] :]] * powers[place], starts - starts[0]))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words of one text; all its words as one run if fewer."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(width, n)
    total = np.full(n - width + 1, np.uint64(width))
    for i in range(width):
        total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[i : n - width + 1 + i]
    return np.unique(mix(total))
