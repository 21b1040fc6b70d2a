"""Vectorised word hashing over Arrow text columns (runs inside tasks).

Texts are UTF-8 bytes, A-Z lower-cased, split at the six ASCII white-space
bytes. Work goes in segments of about ``SEGMENT`` bytes cut at white space, so
memory does not follow the length of a text (a single longer word is one
segment).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20
U = np.uint64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D
_powers = [np.ones(1, U), np.ones(1, U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, U(base))
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of each text) of a string column; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As ``raw_bytes``, with A-Z lower-cased."""
    data, offsets = raw_bytes(column)
    return _LOWER[data], offsets


def _cuts(space: np.ndarray) -> Iterator[tuple[int, int]]:
    """Segments that end at white space or at the end of the data."""
    at, n = 0, len(space)
    while at < n:
        end = min(at + SEGMENT, n)
        if end < n and not space[end - 1]:
            back = np.flatnonzero(space[at:end])
            if len(back):
                end = at + int(back[-1]) + 1
            else:
                while end < n and not space[end]:
                    end += 1
        yield at, end
        at = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a word never reaches over the end of a text."""
    space = _SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = ~space
    start[1:] &= space[:-1] | first[1:-1]
    end = ~space
    end[:-1] &= space[1:] | first[1:-1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def hash_words(data: np.ndarray, offsets: np.ndarray, spans: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, text number) of every word, in order; ``spans`` as ``word_spans`` gives them, if known."""
    starts, ends = spans or word_spans(data, offsets)
    out = np.empty(len(starts), U)
    # a text's end separates words as white space does
    space = _SPACE[data]
    at = 0
    for lo, hi in _cuts(space):
        upto = int(np.searchsorted(starts, hi))
        if upto > at:
            power, inverse = _power_tables(max(SEGMENT, hi - lo) + 1)
            sums = np.zeros(hi - lo + 1, U)
            np.cumsum(_BYTE[data[lo:hi]] * power[: hi - lo], out=sums[1:])
            s, e = starts[at:upto] - lo, ends[at:upto] - lo
            out[at:upto] = mix((sums[e] - sums[s]) * inverse[s])
            at = upto
    return out, np.searchsorted(offsets, starts, side="right") - 1


def text_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 * SEGMENT) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text (or a single longer text) each."""
    for batch in batches:
        lengths = np.cumsum(np.nan_to_num(np.array(
            pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), np.float64)))
        at = 0
        while at < batch.num_rows:
            base = lengths[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(lengths, base + most, side="right")))
            yield batch.slice(at, upto - at)
            at = upto
