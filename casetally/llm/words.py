"""Words of whole Arrow batches as 64-bit hashes, by array operations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)
LONG_WORD = 1024
SLICE_BYTES = 4 << 20

#: Bytes that end a word where the contracts speak of white space.
BLANKS = np.zeros(256, bool)
BLANKS[[32, *range(9, 14)]] = True
#: The same and all other ASCII but letters and digits.
NOT_ALPHANUMERIC = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on all others."""
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of some documents in order: byte ranges, hashes, and each document's range."""

    data: np.ndarray  # bytes, lower-cased if asked for
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # words of document d are bounds[d]:bounds[d + 1]

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes a step for all ranges at once."""
    import xxhash

    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), 0, (1,))
    length = ends - starts
    h = mixed(length.astype(np.uint64) * _A)
    at, left, index = starts.copy(), length.copy(), np.arange(len(starts))
    long = length > LONG_WORD
    if long.any():
        for i in np.flatnonzero(long):
            h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
        index = index[~long]
        at, left = at[~long], left[~long]
    while len(index):
        value = eight[at]
        short = left < 8
        if short.any():
            bits = (np.uint64(8) * np.minimum(left, 8).astype(np.uint64))
            mask = np.where(short, (np.uint64(1) << (bits & np.uint64(63))) - np.uint64(1), ~np.uint64(0))
            value = value & mask
        h[index] = mixed((h[index] ^ value) * _A + _C)
        more = left > 8
        index, at, left = index[more], at[more] + 8, left[more] - 8
    return h


def split_words(texts: pa.Array, blanks: np.ndarray = BLANKS, lower: bool = False) -> Words:
    """Maximal runs of bytes that are not ``blanks``; NULL texts have none."""
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, content = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize)
    first, end = int(offsets[0]), int(offsets[-1])
    offsets = offsets.astype(np.int64) - first
    n = end - first
    data = np.frombuffer(content, np.uint8, n, first) if n else np.empty(0, np.uint8)
    inside = ~blanks[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    ends = np.flatnonzero(inside & (~after | border[1:])) + 1
    if lower:
        data = LOWER[data]
    bounds = np.searchsorted(starts, offsets)
    return Words(data, starts, ends, hash_ranges(data, starts, ends), bounds)


def slices(batch: pa.RecordBatch, column: int, most_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most_bytes`` of text; a longer text is a run."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = (np.cumsum(sizes, dtype=np.int64) - sizes) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` words in a row, and each document's bounds in them.

    A document of fewer words, but at least one, has a single shingle of all its words.
    """
    n = np.diff(words.bounds)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(count)])
    h = words.hashes
    rolled = np.full(len(h), _A, np.uint64)
    for k in range(size):
        rolled[: max(0, len(h) - k)] = mixed(rolled[: max(0, len(h) - k)] * _B + h[k:])
    out = np.empty(bounds[-1], np.uint64)
    full = n >= size
    place = np.repeat(words.bounds[:-1] - bounds[:-1], count) + np.arange(bounds[-1])
    out[:] = rolled[place] if len(place) else 0
    for d in np.flatnonzero(~full & (n > 0)):
        x = np.uint64(n[d])
        for v in h[words.bounds[d] : words.bounds[d + 1]]:
            x = mixed(np.array([x], np.uint64) * _B + v)[0]
        out[bounds[d]] = x
    return out, bounds
