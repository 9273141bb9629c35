"""Texts as arrays of words, one slice of an Arrow batch at a time.

A slice holds at most ``SLICE_BYTES`` of text (a longer text is a slice of its own), so what a task keeps in
memory does not depend on how many rows a batch or a partition has.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4 << 20


class Rule(NamedTuple):
    """Which bytes belong to words, and what each byte counts as."""

    table: bytes
    inside: np.ndarray


def _rule(inside: Iterable[int], lower: bool) -> Rule:
    member = np.zeros(256, bool)
    member[list(inside)] = True
    table = bytes(b + 32 if lower and 0x41 <= b <= 0x5A else b for b in range(256))
    return Rule(table, member)


_SPACE = {0x20, *range(0x09, 0x0E)}
_FOLDED_OUTSIDE = {*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)}
#: Words [^\x20\x09-\x0D]+ as they stand, the same with A-Z lowered, and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ with A-Z lowered.
PLAIN = _rule(set(range(256)) - _SPACE, lower=False)
LOWERED = _rule(set(range(256)) - _SPACE, lower=True)
FOLDED = _rule({*range(0x41, 0x5B)} | set(range(256)) - _FOLDED_OUTSIDE, lower=True)


class Words(NamedTuple):
    """Words of a slice in order: those of row ``i`` are ``first[i]`` to ``first[i + 1]``."""

    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    codes: np.ndarray
    vocabulary: pa.Array

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts of a column as one byte string, and where each begins; null counts as empty."""
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return b"", np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = held.slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if held is not None else b""
    return data, offsets - offsets[0]


def _hand_back() -> None:
    """Return freed memory to the system: unused Arrow pools, and what the C library keeps of freed arrays."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; others keep less
    if trim is not None:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES, *more: str) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each part holds about ``limit`` bytes of text, one row at least.

    Texts of the columns ``more`` count as well, so a pair of texts is bounded on both sides.
    """
    for batch in batches:
        ends = np.zeros(batch.num_rows, np.int64)
        for name in (text, *more):
            sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0)
            ends += sizes.to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(ends, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
    # Python workers are reused by later tasks and stages: hand back what this task's batches held.
    _hand_back()


def packed(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive stretches of ``data`` as an Arrow array."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def encoded(array: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A code for each value, and the distinct values by code."""
    out = array.dictionary_encode()
    return out.indices.to_numpy(), out.dictionary


def split(column: pa.Array, rule: Rule) -> Words:
    """Words of every text of a slice; no word crosses from one text into the next."""
    raw, offsets = text_bytes(column)
    data = np.frombuffer(raw.translate(rule.table), np.uint8)
    inside = rule.inside[data]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[heads] = inside[heads]
    closes[:-1] &= ~inside[1:]
    closes[heads[1:] - 1] = inside[heads[1:] - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    codes, vocabulary = encoded(packed(data[inside], end - start))
    return Words(np.searchsorted(start, offsets), start, end, codes, vocabulary)


def once(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each text stands among the distinct ones, and these; null counts as empty."""
    codes, texts = encoded(pc.fill_null(column, ""))
    return codes, texts


def as_bytes(values: pa.LargeBinaryArray) -> list[bytes]:
    """The values as bytes, cut from the buffer: a tenth of the time of ``to_pylist``, which makes a scalar of each."""
    if not len(values):
        return []
    _, places, data = values.buffers()
    at = np.frombuffer(places, np.int64)[values.offset:values.offset + len(values) + 1]
    raw = data[int(at[0]):int(at[-1])].to_pybytes() if data is not None else b""
    at = (at - at[0]).tolist()
    return [raw[a:b] for a, b in zip(at, at[1:])]


def hashes(vocabulary: pa.Array) -> np.ndarray:
    """A 64-bit hash of every distinct word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, as_bytes(vocabulary)), np.uint64, len(vocabulary))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of a public mixing function)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(word_hash: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` words from each word on; shorter by ``k - 1`` than the input."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out ^ word_hash[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return mixed(out)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def within(first: np.ndarray, k: int) -> np.ndarray:
    """Positions at which ``k`` words of one row stand."""
    counts = np.maximum(np.diff(first) - k + 1, 0)
    return spread(first[:-1], counts)


def minimisers(first: np.ndarray, hashed: np.ndarray, k: int, w: int) -> np.ndarray:
    """Positions of the least of every ``w`` consecutive ``k``-word hashes; equal stretches have equal ones.

    Any ``w + k - 1`` words of one text hold a position. Windows that reach into the next text only add some.
    """
    at = within(first, k)
    if not len(at):
        return at
    value = np.full(len(hashed) + 2 * w, np.iinfo(np.uint64).max, np.uint64)
    value[at] = runs(hashed, k)[at]
    least = _sliding(value, w, np.minimum)
    # The windows over a position begin up to w - 1 places before it; the greatest of their minima tells whether it is one.
    padded = np.concatenate([np.zeros(w - 1, np.uint64), least])
    return at[_sliding(padded, w, np.maximum)[at] == value[at]]


def _sliding(value: np.ndarray, w: int, pick) -> np.ndarray:
    """``pick`` over ``w`` values from each place on; places near the end see fewer."""
    out, span = value.copy(), 1
    while span < w:
        step = min(span, w - span)
        out[:-step] = pick(out[:-step], out[step:])
        span += step
    return out


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, …`` for every start, as many as its count."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


def per_row(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``marks`` between consecutive bounds."""
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def named(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
