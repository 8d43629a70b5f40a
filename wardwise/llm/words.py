"""Words of Arrow text batches as numpy arrays: byte spans, 64-bit hashes and hashes of word runs.

Work goes over pieces of about a megabyte (or one text), so memory stays bounded for any batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_FOLD = np.arange(256)
_FOLD[65:91] += 32

#: Bytes of words: not ASCII white space; or only digits, letters and bytes of longer code points.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_VALUES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A random odd number per byte, as it is or with A-Z read as a-z.
EXACT, FOLDED = _VALUES, _VALUES[_FOLD]
_BASE, _RUN = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_powers = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or have.size < n:
        size = max(64, 1 << (n - 1).bit_length())
        have = np.concatenate([[np.uint64(1)], np.full(size - 1, base, np.uint64)]).cumprod(dtype=np.uint64)
        _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = PIECE) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets of their texts); null texts are empty."""
    for batch in batches:
        texts = batch.column(column)
        if texts.null_count:
            texts = texts.fill_null("")
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        n, at = len(texts), texts.offset
        offsets = np.frombuffer(texts.buffers()[1], kind)[at:at + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
            yield batch.slice(lo, hi - lo), data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            lo = hi


class Words:
    """Words of some texts: byte spans, hashes, and `first`, each text's first word (one more at the end)."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray, values: np.ndarray):
        n, within = buf.size, inside[buf]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = within[:-1], within[1:]
        before[offsets[:-1][offsets[:-1] < n]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(within & ~before)
        self.ends = np.flatnonzero(within & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        lengths = self.ends - self.starts
        off = np.cumsum(lengths) - lengths
        if off.size:
            place = np.arange(int(lengths.sum())) - np.repeat(off, lengths)
            value = values[buf[within]] * powers(_BASE, int(lengths.max()))[place]
            self.hashes = mix(np.add.reduceat(value, off))
        else:
            self.hashes = np.zeros(0, np.uint64)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def places(self) -> np.ndarray:
        """Each word's place in its text."""
        return np.arange(self.starts.size) - np.repeat(self.first[:-1], self.counts)

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of all runs of k words within a text."""
        n = self.hashes.size - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out += self.hashes[j:j + n] * powers(_RUN, k)[j]
        at = np.flatnonzero(np.arange(k, n + k) <= np.repeat(self.first[1:], self.counts)[:n])
        return at, mix(out[at] + np.uint64(k))

    def text_hashes(self) -> np.ndarray:
        """A hash of each text's words in order."""
        return mix(self.sums(mix(self.hashes ^ mix(self.places().astype(np.uint64)))) + self.counts.astype(np.uint64))

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of the words' values by text."""
        total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
        return total[self.first[1:]] - total[self.first[:-1]]


def listed(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """One list per pair of neighbouring bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
