"""Words of many texts at once, as numbers, inside Python tasks.

A word is a run of bytes other than blanks (space, tab to carriage return) in the UTF-8 form of
a text. The functions work on a slice of an Arrow batch as one run of bytes, so their cost is
that of a few passes over the bytes, and their memory is bounded by ``SLICE_BYTES`` or by the
longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        base = 0xD6E8FEB86659FD93
        inverse = pow(base, -1, 1 << 64)
        for name, r in (("up", base), ("down", inverse)):
            steps = np.full(size, np.uint64(r & _MASK))
            steps[0] = 1
            with np.errstate(over="ignore"):
                _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``values[start:end]`` of 64-bit numbers."""
    up, down = _power_tables(len(values) + 1)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _STEP)


class Words:
    """The words of a slice of texts: ``hash``, and ``first`` such that text i has the words
    first[i] to first[i + 1]. ``bytes`` holds all words, each followed by one space; word w is
    bytes[start[w]:end[w]]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        n = len(data)
        held = ~_BLANK[data]
        new_text = np.zeros(n + 1, bool)
        new_text[offsets] = True
        before = np.empty(n, bool)
        before[1:] = held[:-1]
        before[:1] = False
        starts = np.flatnonzero(held & (~before | new_text[:n]))
        after = np.empty(n, bool)
        after[:-1] = held[1:]
        after[-1:] = False
        ends = np.flatnonzero(held & (~after | new_text[1:])) + 1
        self.first = np.searchsorted(starts, offsets)
        self.hash = run_hashes(byte_values()[data], starts, ends)
        self._data, self._starts, self._ends = data, starts, ends
        self._packed: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def packed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self._packed is None:
            lengths = self._ends - self._starts
            start = np.zeros(len(lengths) + 1, np.int64)
            np.cumsum(lengths + 1, out=start[1:])
            out = np.full(int(start[-1]), 0x20, np.uint8)
            out[spans(start[:-1], lengths)] = self._data[spans(self._starts, lengths)]
            self._packed = out, start[:-1], start[:-1] + lengths
        return self._packed

    def text_of(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of every span, one span after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    held = lengths > 0
    starts, lengths = starts[held], lengths[held]
    steps = np.ones(total, np.int64)
    at = np.cumsum(lengths)[:-1]
    steps[0] = starts[0]
    steps[at] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(steps)


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of few enough text bytes, with these bytes and their offsets. NULL counts as empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return
    offsets = np.frombuffer(offsets, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1
        high = min(max(high, low + 1), len(texts))
        yield batch.slice(low, high - low), data[offsets[low]: offsets[high]], offsets[low: high + 1] - offsets[low]
        low = high


def run_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Words at which a run of ``width`` words of one text begins."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    return spans(first[:-1], counts)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of ``width`` words from each word on that can begin such a run, and these words."""
    starts = run_starts(words.first, width)
    values = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            values = (values + words.hash[starts + k]) * np.uint64(0xF1357AEA2E62A9C5)
    return mix(values), starts
