"""Text columns of Arrow batches as byte arrays, word hashes, and small helpers shared by the operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Bytes of text worked on at a time inside a task; bounds the temporaries, not the texts.
PART_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: each input bit reaches each output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, dtype=np.uint64)
        p[0] = 1
        both.append(np.cumprod(p, dtype=np.uint64))
    return both[0], both[1]


_POWER, _INVERSE = _powers(PART_BYTES + 1)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def give_back() -> None:
    """Return freed memory to the system at the end of a task: workers live on, and later stages need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def as_text(column: pa.Array) -> pa.Array:
    """The column as non-null strings; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def text_parts(column: pa.Array, limit: int = PART_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about `limit` bytes; a longer text is a part of its own."""
    column = as_text(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(codes[data] * _POWER[: len(data)], out=total[1:])
    return mix64((total[ends] - total[starts]) * _INVERSE[starts])


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    words, row, _, _ = located_words(data, offsets, lower)
    return words, row


def located_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs of bytes other than ASCII white space, A-Z lower-cased), each word's row, start and end.

    Any length of text: work goes in pieces cut at white space. A single word longer than a piece is hashed as the
    sum of its pieces, so equal words always get equal hashes.
    """
    codes = _BYTE[LOWER] if lower else _BYTE
    solid = ~SPACE[data]
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = solid[:-1]
    inner = offsets[:-1]
    before[inner[inner < len(data)]] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(solid & ~after) + 1
    out = np.empty(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = int(np.searchsorted(ends, base + PART_BYTES, side="right"))
        if hi <= lo:
            pieces = range(base, int(ends[lo]), PART_BYTES)
            cut = [data[p : min(p + PART_BYTES, int(ends[lo]))] for p in pieces]
            one = [_span_hashes(c, np.array([0]), np.array([len(c)]), codes)[0] for c in cut]
            out[lo] = mix64(np.cumsum(np.array(one, np.uint64) * _POWER[: len(one)], dtype=np.uint64)[-1:])[0]
            lo += 1
            continue
        out[lo:hi] = _span_hashes(data[base : int(ends[hi - 1])], starts[lo:hi] - base, ends[lo:hi] - base, codes)
        lo = hi
    return out, np.searchsorted(offsets[1:], starts, side="right"), starts, ends


class HashIndex:
    """Place of 64-bit keys in an array of distinct keys: an open-addressed table, looked up many keys at a time."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(np.uint64)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, dtype=np.int32)
        todo, place = np.arange(len(keys)), self._slot(self.keys)
        while len(todo):
            free = self.slots[place] < 0
            self.slots[place[free]] = todo[free]
            lost = self.slots[place] != todo
            todo, place = todo[lost], (place[lost] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places, -1 for keys that aren't there."""
        out = np.full(len(keys), -1, dtype=np.int64)
        if not len(self.keys):
            return out
        open_, place = np.arange(len(keys)), self._slot(keys)
        while len(open_):
            got = self.slots[place]
            real = got >= 0
            hit = real & (self.keys[got] == keys[open_])
            out[open_[hit]] = got[hit]
            go = real & ~hit
            open_, place = open_[go], (place[go] + 1) & self.mask
        return out


def shingles_of(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words of one text; fewer words make one, no word makes none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    k = min(size, len(words))
    total = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[j : len(words) - k + 1 + j]
        total ^= total >> np.uint64(29)
    return np.unique(mix64(total))
