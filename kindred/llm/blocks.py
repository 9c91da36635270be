"""Whole texts of Arrow batches as flat byte arrays, and their words as number arrays.

Python workers get batches of rows; these helpers cut them into slices of bounded
bytes (a longer text is a slice of its own) and find and hash all words of a slice
with array operations, so that no word is touched by an interpreter loop.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text handled at once.
SLICE_BYTES = 2 << 20

_space = np.ones(256, bool)
_space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Bytes of words that white space separates; bytes of words of letters and digits.
#: UTF-8 bytes above 0x7F belong to both.
UNSPACED = _space
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = True
ALPHANUMERIC[0x80:] = True

EXACT = np.arange(256, dtype=np.uint8)
#: Lower-cases A-Z alone.
LOWER = EXACT.copy()
LOWER[0x41:0x5B] += 32

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, SLICE_BYTES)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known[:n]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows, their bytes end to end, and where each row's bytes begin (and the last end).

    A null counts as empty.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, first = np.cumsum(sizes, dtype=np.int64), 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
            part = batch.slice(first, last - first)
            yield part, *flat(part.column(column))
            first = last


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, of_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row where its words begin in them."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = of_words[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    bounds = offsets[(offsets > 0) & (offsets < len(data))]
    before[bounds] = False
    after[bounds - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = EXACT) -> np.ndarray:
    """64-bit hash of each word, equal exactly for equal bytes (after ``fold``) but for chance."""
    out, values, first = np.empty(len(starts), np.uint64), _BYTE_VALUES[fold], 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + SLICE_BYTES, "right")))
        base = starts[first]
        size = int(ends[last - 1] - base)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values[data[base:base + size]] * _power_table(_BASE, size), out=sums[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = mix((sums[e] - sums[s]) * _power_table(_BASE_INVERSE, size)[s] + (e - s).astype(np.uint64))
        first = last
    return out


#: Odd multipliers of the two hashes of a run.
_RUN_BASES = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the values in each [start, end), from prefix sums, whatever the lengths."""
    out = []
    for base in _RUN_BASES:
        n = len(hashes) + 1
        sums = np.zeros(n, np.uint64)
        np.cumsum(mix(hashes ^ _U(base)) * _power_table(base, n - 1), out=sums[1:])
        back = _power_table(pow(base, -1, 1 << 64), n)
        out.append(mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64)))
    return out[0], out[1]


def joined(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray,
           kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``kept`` words (numbers, ascending) of each row with one blank between them, end
    to end, and the bytes of each row. ``starts``, ``ends``, ``first`` as ``spans`` gives them."""
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts[kept]] += 1
    edges[ends[kept]] -= 1
    take = np.cumsum(edges[:-1], dtype=np.int8).view(bool)
    row = np.searchsorted(first, kept, "right") - 1
    # The byte after a word that is not the last kept one of its row is white space.
    blanks = ends[kept[:-1][row[1:] == row[:-1]]]
    take[blanks] = True
    data = data.copy()
    data[blanks] = 0x20
    return data[take], np.diff(np.concatenate([[0], np.cumsum(take)])[offsets])


def as_strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Strings of the given numbers of bytes, cut from UTF-8 bytes that stand end to end."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.string())


def window_hashes(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` consecutive values."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, seed, np.uint64)
    for j in range(width):
        total = (total ^ hashes[j:j + n]) * _U(0xD6E8FEB86659FD93)
        total ^= total >> _U(32)
    return mix(total)


def add_columns(docs: DataFrame, columns: str,
                of: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], list[pa.Array]],
                text: str = "text") -> DataFrame:
    """``docs`` with columns (DDL ``columns``) that ``of`` computes from the texts of a
    slice. Input columns of the same names are replaced."""
    fresh = T.StructType.fromDDL(columns)
    kept = docs.drop(*fresh.names)
    added = fresh.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, text):
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *of(part, data, offsets)], names=[*part.schema.names, *added])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *fresh.fields]))
