"""Vectorised work on columns of text inside Arrow tasks.

A batch of texts is cut into slices of whole documents of about ``SLICE_BYTES`` (a
longer document is a slice of its own), and words, lines and n-grams of a slice are
hashed with numpy at once.  Hashes are 64-bit fingerprints: a word's is a polynomial
over its bytes, mixed; an n-gram's is a polynomial over its words' hashes, mixed.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.session import tune

# what one Arrow batch brings into a task's Python process
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}
SLICE_BYTES = 1 << 18
FILTER_BITS = 24
U64 = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = 0xD6E8FEB86659FD93

# U+0020 and U+0009..U+000D
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# everything in ASCII but letters and digits
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[128:] = False
for _a, _z in (("0", "9"), ("a", "z"), ("A", "Z")):
    NOT_ALNUM[ord(_a) : ord(_z) + 1] = False
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True


def prepare(spark: SparkSession) -> None:
    """Skew settings of the library, and Arrow batches that keep tasks small."""
    tune(spark)
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser that spreads every input bit over the output."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *caches: Callable) -> Callable:
    """``work`` for ``mapInArrow``, after which the Python process gives its unused memory
    back: it lives on for the next tasks, beside others and the JVM.  ``caches`` are
    functions with a cache that is emptied as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            for cached in caches:
                cached.cache_clear()
            if caches:
                gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value of each byte, powers of the base and of its inverse."""
    return (
        mix(np.arange(1, 257, dtype=U64) * U64(_STEP)),
        _powers(_BASE, 2 * SLICE_BYTES),
        _powers(_BASE_INVERSE, 2 * SLICE_BYTES),
    )


@lru_cache(maxsize=1)
def lower_table() -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


@dataclass
class Slice:
    """Documents ``first .. first + len(offsets) - 2`` of a batch as one byte array."""

    first: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than documents

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Pieces:
    """Words or lines of a slice: byte ranges, hashes, and where documents begin."""

    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # int64, piece index at which each document starts, and the end


def slices(text: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Whole documents in slices of about ``limit`` bytes; null text counts as empty."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = pc.fill_null(text, "").cast(pa.large_string())
    if len(text) == 0:
        return
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(text):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(text))
        own = offsets[first : last + 1]
        yield Slice(first, data[own[0] : own[-1]], own - own[0])
        first = last


def pieces(part: Slice, separators: np.ndarray, lower: bool) -> Pieces:
    """Maximal runs of bytes that are no separators, never across documents."""
    data, offsets = part.data, part.offsets
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Pieces(none, none, none.astype(U64), np.zeros(len(offsets), np.int64))
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    begins[edges] = inside[edges]
    start = np.flatnonzero(begins)
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    stops[lasts] = inside[lasts]
    end = np.flatnonzero(stops) + 1
    value, power, inverse = _tables()
    if n > len(power):
        power, inverse = _powers(_BASE, n), _powers(_BASE_INVERSE, n)
    if len(start) == 0:
        hashes = np.zeros(0, U64)
    else:
        terms = value[lower_table()[data] if lower else data]
        terms *= power[:n]
        terms[~inside] = 0
        hashes = mix(np.add.reduceat(terms, start) * inverse[start] + (end - start).astype(U64))
    return Pieces(start, end, hashes, np.searchsorted(start, offsets).astype(np.int64))


def strings(part: Slice, start: np.ndarray, end: np.ndarray, lower: bool = True) -> pa.StringArray:
    """The byte ranges of a slice as text, A-Z lower-cased on request; the ranges begin
    and end at characters."""
    sizes = end - start
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    data = part.data[np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], sizes)]
    if lower:
        data = lower_table()[data]
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def words(part: Slice, separators: np.ndarray = WHITE, lower: bool = True) -> Pieces:
    return pieces(part, separators, lower)


def lines(part: Slice) -> Pieces:
    """Lines that are not empty, as they stand."""
    return pieces(part, NEWLINE, False)


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Fingerprint of every n consecutive hashes (fewer than n: none)."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    total = np.zeros(len(hashes) - n + 1, U64)
    for k in range(n):
        total *= U64(_STEP)
        total += hashes[k : k + len(total)]
    return mix(total + U64(n))


def grams(found: Pieces, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-grams inside documents: fingerprints, first piece of each, bounds by document."""
    sizes = np.diff(found.bounds)
    keep = np.maximum(sizes - n + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(keep)]).astype(np.int64)
    first = np.arange(bounds[-1]) + np.repeat(found.bounds[:-1] - bounds[:-1], keep)
    everything = combine(found.hashes, n)
    return everything[first], first, bounds


def bitmap(values: DataFrame) -> np.ndarray:
    """Bitmap of the low ends of a column of fingerprints, of ``FILTER_BITS`` bits
    whatever their number; what reaches the driver is bounded by it."""
    (name,) = values.columns
    slot = F.col(name).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(31)).cast("int"))
    table = values.groupBy(F.shiftright(slot, 5).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[table["at"].to_numpy()] = table["bits"].to_numpy()
    return out


def in_bitmap(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether each unsigned fingerprint may be in the bitmap."""
    slot = values & U64((1 << FILTER_BITS) - 1)
    return (bits[slot >> U64(5)] >> (slot & U64(31)).astype(np.uint32)) & np.uint32(1) != 0


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte position, one more than bytes."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
