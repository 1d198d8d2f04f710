"""Columnar word splitting and hashing over Arrow text columns.

A chunk of texts is split by Arrow's C++ kernel and dictionary-encoded, so the
work per *distinct* word (hashing, tokenising, n-gram scoring) is paid once per
chunk and the work per word occurrence is a numpy gather.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 8 << 20
#: Parameters of glibc's mallopt.
_M_TRIM_THRESHOLD, _M_MMAP_THRESHOLD = -1, -3

#: Multiplier of the window polynomial (odd, so it has an inverse modulo 2**64).
_Q = 0x9E3779B97F4A7C15
_Q_INVERSE = pow(_Q, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


@dataclass
class Words:
    """Words of a chunk: those of text i are ``codes[offsets[i]:offsets[i + 1]]``."""

    offsets: np.ndarray
    codes: np.ndarray
    uniques: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1, dtype=np.int32), self.counts)

    def keep(self, wanted: np.ndarray) -> Words:
        """Only the words whose code is marked in ``wanted``."""
        mask = wanted[self.codes]
        before = np.concatenate([[0], np.cumsum(mask)])
        return Words(before[self.offsets], self.codes[mask], self.uniques)


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text each; a longer text stands alone.

    ``text`` may also name an integer column that holds the sizes.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        sizes = pc.fill_null(column if pa.types.is_integer(column.type) else pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        first = 0
        while first < batch.num_rows:
            base = ends[first] - sizes[first]
            last = max(first + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(first, last - first)
            first = last


def releasing(run: Callable[[Iterator], Iterator], mapped: int = 1 << 20) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow in a worker that gives free memory back, within a task and at its end.

    Arrow allocates with malloc then, and arrays of ``mapped`` bytes or more are mapped on their own, so
    they leave the process when they are dropped (glibc only; elsewhere nothing changes).  Mapping
    costs time, so operators that make many large arrays set it higher.
    """

    def task(batches):
        libc = ctypes.CDLL(None)
        if hasattr(libc, "mallopt"):
            libc.mallopt(_M_MMAP_THRESHOLD, mapped)
            libc.mallopt(_M_TRIM_THRESHOLD, 4 << 20)
            pa.set_memory_pool(pa.system_memory_pool())
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)

    return task


def released(give: Callable[..., pa.Table], mapped: int = 1 << 20) -> Callable[..., pa.Table]:
    """As :func:`releasing`, for functions of groups."""

    def run(*tables):
        return list(releasing(lambda _: [give(*tables)], mapped)(None))[0]

    # Spark reads off the arguments whether it is given one group or two.
    return (lambda rows: run(rows)) if give.__code__.co_argcount == 1 else (lambda left, right: run(left, right))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The text column without nulls."""
    return pc.fill_null(batch.column(name), "")


def split(texts: pa.Array) -> Words:
    """Words of every text; ASCII white space separates them."""
    if not len(texts):
        return Words(np.zeros(1, np.int64), np.zeros(0, np.int32), pa.array([], pa.string()))
    lists = pc.ascii_split_whitespace(texts)
    encoded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = Words(offsets - offsets[0], encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary)
    return words.keep(pc.binary_length(words.uniques).to_numpy(zero_copy_only=False) > 0)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def string_hashes(strings: pa.Array) -> np.ndarray:
    """A stable 64-bit hash of every string."""
    if not len(strings):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(strings.to_pylist(), dtype=object), categorize=False)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for k, base in enumerate((_Q, _Q_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries; windows that cross texts are included."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _powers(n)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up)])
    return mix((prefix[k:] - prefix[:-k]) * down[: n - k + 1])


def span_hashes(text: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A stable 64-bit hash of the bytes text[starts[i]:stops[i]] for every i."""
    up, down = _powers(len(text) + 1)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[:-1])])
    return mix(mix((prefix[stops] - prefix[starts]) * down[starts]) ^ (stops - starts).astype(np.uint64))


def window_starts(offsets: np.ndarray, k: int) -> np.ndarray:
    """Positions at which a whole window of k words of one text starts."""
    room = np.maximum(np.diff(offsets) - k + 1, 0)
    total = int(room.sum())
    base = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(room)[:-1]]), room)
    return base + np.arange(total)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i + 1]] for every i."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.float64 if values.dtype.kind == "f" else np.int64), np.cumsum(values, axis=0, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def lowered(texts: pa.Array) -> pa.Array:
    """A-Z in lower case, all else as it is."""
    return pc.ascii_lower(texts)
