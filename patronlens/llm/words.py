"""Words of whole Arrow columns and their 64-bit hashes, computed with numpy inside tasks.

Words are the runs of bytes other than 0x20 and 0x09 to 0x0D; in UTF-8 these bytes never
occur inside a character. Hashes are equal in every task and every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

SLICE_BYTES = 4_000_000  # text handled at once; a longer document is a slice of its own
SEGMENT_BYTES = 1_000_000

_RANDOM = np.random.default_rng(20_240_501)
_BYTES = _RANDOM.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWERED = _BYTES.copy()
_LOWERED[:, 65:91] = _BYTES[:, 97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        grown = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        grown[0] = 1
        known = np.cumprod(grown, dtype=np.uint64)
        if len(known) <= 8 * SEGMENT_BYTES:
            _POWERS[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run ``values[start:end]``, from one pass of prefix sums; runs must not be empty."""
    prefix = np.cumsum(values * _powers(_BASE, len(values)), dtype=np.uint64)
    total = prefix[ends - 1] - np.where(starts > 0, prefix[starts - 1], np.uint64(0))
    return mix(total * _powers(_INVERSE, len(values))[starts] + (ends - starts).astype(np.uint64))


def windows_hash(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every ``length`` consecutive entries."""
    starts = np.arange(max(0, len(hashes) - length + 1))
    return runs_hash(hashes, starts, starts + length) if len(starts) else np.empty(0, dtype=np.uint64)


class Words:
    """Words of consecutive texts: byte ranges in ``data``, hashes, and where each text's words begin.

    ``family`` 0 and 1 are independent hashes.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, family: int = 0):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
        self.data = raw[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        word = ~_BLANK[self.data]
        before = np.concatenate([[False], word[:-1]]) if len(word) else word
        before[bounds[:-1][bounds[:-1] < len(word)]] = False
        after = np.concatenate([word[1:], [False]]) if len(word) else word
        after[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.bounds = np.searchsorted(self.starts, bounds)
        table, parts, a = (_LOWERED if lower else _BYTES)[family], [], 0
        while a < len(self.starts):
            first = self.starts[a]
            b = max(a + 1, int(np.searchsorted(self.starts, first + SEGMENT_BYTES)))
            piece = table[self.data[first : self.ends[b - 1]]]
            parts.append(runs_hash(piece, self.starts[a:b] - first, self.ends[a:b] - first))
            a = b
        self.hashes = np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)

    def of(self, i: int) -> slice:
        return slice(int(self.bounds[i]), int(self.bounds[i + 1]))

    def text(self, a: int, b: int) -> bytes:
        """Words ``a`` to ``b``, end exclusive, joined by one space."""
        data, starts, ends = self.data, self.starts, self.ends
        raw = data[starts[a] : ends[b - 1]].tobytes()
        if len(raw) == int((ends[a:b] - starts[a:b]).sum()) + b - a - 1:
            return raw.translate(_SPACES)  # every gap is one blank
        return b" ".join(raw.split())


_SPACES = bytes(0x20 if blank else i for i, blank in enumerate(_BLANK))


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with some ``SLICE_BYTES`` of text each."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        floor = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, floor + SLICE_BYTES, side="right")))
        yield a, b
        a = b
