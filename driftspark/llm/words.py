"""Words of many texts at once: positions and 64-bit hashes by numpy.

Both word rules of the package are rules on bytes of UTF-8, since every byte of a
character beyond ASCII is above 0x7F. ASCII capitals are lowered.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lowering: digits, letters and all beyond ASCII.
ALPHANUMERIC = ((_LOWER >= 48) & (_LOWER <= 57)) | ((_LOWER >= 97) & (_LOWER <= 122)) | (_LOWER >= 128)
#: ``[^\x20\x09-\x0D]+``: everything but blanks.
UNBLANK = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))

_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit numbers (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """lowered bytes; first byte and length of each word; words of text i are
    ``offsets[i]:offsets[i + 1]``; hashes."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pa.compute.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words_of(column: pa.Array, rule: np.ndarray, lower: bool = True, hashed: bool = True) -> Words:
    data, offsets = text_bytes(column)
    n = len(data)
    lowered = np.zeros(n + 8, np.uint8)
    if lower:
        np.take(_LOWER, data, out=lowered[:n])
    else:
        lowered[:n] = data
    inside = rule[data]
    edges = offsets[1:-1]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[edges[edges < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    hashes = hash_spans(lowered, starts, lengths) if hashed else np.zeros(0, np.uint64)
    return Words(lowered, starts, lengths, np.searchsorted(starts, offsets), hashes)


def hash_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; the data end with 8 spare bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    eights = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    h = mix((eights[starts] & _MASKS[np.minimum(lengths, 8)]) + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    rest, at = np.flatnonzero(lengths > 8), 8
    while len(rest):
        part = eights[starts[rest] + at] & _MASKS[np.minimum(lengths[rest] - at, 8)]
        h[rest] = mix(h[rest] * np.uint64(0xD6E8FEB86659FD93) + part)
        at += 8
        rest = rest[lengths[rest] > at]
    return h


def rolling(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text in order, and their offsets. A text
    of fewer words, but not none, has its whole sequence as its one shingle."""
    counts = np.diff(words.offsets)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    offsets = np.concatenate(([0], np.cumsum(n)))
    text = np.repeat(np.arange(len(counts)), n)
    first = np.arange(offsets[-1]) - offsets[text] + words.offsets[text]
    size = np.minimum(counts[text], k)
    h = size.astype(np.uint64)
    for j in range(k):
        grown = size > j
        if grown.all():
            h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words.hashes[first + j])
        else:
            h[grown] = mix(h[grown] * np.uint64(0xD6E8FEB86659FD93) + words.hashes[first[grown] + j])
    return h, offsets
