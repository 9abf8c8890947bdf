"""Words of whole texts as numpy arrays, a chunk of documents at a time.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z in lower case. These separators
are single bytes in UTF-8, so nothing has to be decoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BYTE = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the hash's base and of its inverse, below ``n``."""
    out = []
    for base in (_BASE, _INVERSE):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of ``rows`` documents: 64-bit hashes, byte ranges, and each document's part."""

    rows: int
    data: np.ndarray  # lower-cased bytes of all texts, one after the other
    bounds: np.ndarray  # of texts in data, rows + 1
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each document's words, rows + 1
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and their bounds; a null is an empty text."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    bounds = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def _cut(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of more than ``longest`` bytes in pieces of at most as many, cut between characters."""
    step = longest - 3  # a character has up to four bytes
    lengths = ends - starts
    parts = np.where(lengths > longest, -(-lengths // step), 1)
    number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    pieces = np.repeat(starts, parts) + number * step
    for _ in range(3):
        pieces -= (number > 0) & ((low[pieces] & 0xC0) == 0x80)
    until = np.append(pieces[1:], 0)
    last = np.cumsum(parts) - 1
    until[last] = ends
    return pieces, until


def words(texts: pa.Array, longest: int | None = None) -> Words:
    """The words of ``texts``; with ``longest``, those of more bytes in pieces of at most as many."""
    data, bounds = text_bytes(texts)
    n = len(data)
    if n == 0:
        none = np.empty(0, np.int64)
        return Words(len(texts), data, bounds, none, none, np.zeros(len(texts) + 1, np.int64), none.astype(np.uint64))
    low = LOWER[data]
    space = IS_SPACE[data]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    before[inner] = True
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    after[inner - 1] = True
    filled = ~space
    starts = np.flatnonzero(filled & before)
    ends = np.flatnonzero(filled & after) + 1
    if longest and len(starts) and (ends - starts).max() > longest:
        starts, ends = _cut(low, starts, ends, longest)
    size = 1 << 18
    while size < n:
        size *= 2
    powers, inverse = _powers(size)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[low] * powers[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)
    return Words(len(texts), low, bounds, starts, ends, np.searchsorted(starts, bounds), mix(hashes))


class Index:
    """Places of 64-bit hashes among distinct sorted ones, by their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.uint64(0))
        self.n = len(keys)
        bits = max(1, int(self.n).bit_length())
        self.shift = np.uint64(64 - bits)
        counts = np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits)
        self.starts = np.concatenate([[0], np.cumsum(counts)])

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each of ``wanted``; n where there is none."""
        bucket = (wanted >> self.shift).astype(np.int64)
        at, end = self.starts[bucket], self.starts[bucket + 1]
        open_ = np.flatnonzero((at < end) & (self.keys[at] != wanted))
        at[at == end] = self.n
        while len(open_):
            at[open_] += 1
            over = at[open_] >= end[open_]
            at[open_[over]] = self.n
            open_ = open_[~over]
            open_ = open_[self.keys[at[open_]] != wanted[open_]]
        return at


def chunks(
    batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch whose texts have about ``size`` bytes; a longer text stands alone."""
    texts = batch.column(batch.schema.get_field_index(column))
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        to = min(to, len(texts))
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        at = to
