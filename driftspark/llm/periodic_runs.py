"""Maximal periodic runs of words by block convolution at dyadic scales.

A run is a stretch of words with smallest period q, as long as possible, of at least three
periods and ``SHORTEST`` words. Let B be the largest power of two up to q, at least ``LEAST``. Every run holds a block of
B words that starts at a multiple of B and occurs again q words later inside the run. So:

1. At scale B each block is compared with the words that follow it at distances below 2B
   (from B on; from 1 on at the least scale). The sum of squared differences of word codes is
   two sums of squares less twice a correlation, which a number-theoretic transform gives exactly; it
   is zero where the block occurs again. Codes are so small that no sum reaches the modulus.
2. Each zero's distance is a seed: the stretch around the block whose words equal those at that distance
   is extended to both sides, and kept if it is long enough and has no smaller period.

Blocks that can give nothing new are left out before the transform: those with a word that does not
occur again within 2B words, and those that lie, with all that follows them at this scale, in a run found
before (there all distances are multiples of its period). Words are known by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftspark.llm.common import chunks
from driftspark.llm.words import UNBLANK, words_of

PERIODS = 3  # a run has at least so many
SHORTEST = 24  # words
LEAST = 8  # words of the smallest blocks; a run of 24 words with a period below 8 holds such a block and its copy
BATCH = 1 << 20  # words transformed at once
MODULUS = 2013265921  # 15 * 2^27 + 1, with primitive root 31: texts of up to 200 million words
ROOT = 31
RUNS = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


@cache
def _twiddles(size: int, inverse: bool) -> list[np.ndarray]:
    """The powers of a root of unity that each level of a transform needs."""
    out, half = [], size // 2
    while half:
        root = pow(ROOT, (MODULUS - 1) // (2 * half), MODULUS)
        root = pow(root, MODULUS - 2, MODULUS) if inverse else root
        powers = np.ones(half, np.int64)
        step = 1
        while step < half:  # doubles the powers known
            powers[step : 2 * step] = powers[:step] * pow(root, step, MODULUS) % MODULUS
            step *= 2
        out.append(powers)
        half //= 2
    return out


def transform(rows: np.ndarray) -> np.ndarray:
    """The number-theoretic transform of each row, in bit-reversed order."""
    n, size = rows.shape
    x = rows
    for powers in _twiddles(size, False):
        half = len(powers)
        x = x.reshape(n, -1, 2, half)
        low, high = x[:, :, 0], x[:, :, 1]
        x = np.stack(((low + high) % MODULUS, (low - high) % MODULUS * powers % MODULUS), 2)
    return x.reshape(n, size)


def inverse_transform(rows: np.ndarray) -> np.ndarray:
    """Back from bit-reversed order."""
    n, size = rows.shape
    x = rows
    for powers in reversed(_twiddles(size, True)):
        half = len(powers)
        x = x.reshape(n, -1, 2, half)
        low, high = x[:, :, 0], x[:, :, 1] * powers % MODULUS
        x = np.stack(((low + high) % MODULUS, (low - high) % MODULUS), 2)
    return x.reshape(n, size) * pow(size, MODULUS - 2, MODULUS) % MODULUS


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each block of B codes and its window of 2B codes: the sums of squared differences
    at the B places of the window where the whole block fits before the last word."""
    b = blocks.shape[1]
    turned = np.zeros_like(windows)
    turned[:, 0], turned[:, b + 1 :] = blocks[:, 0], blocks[:, :0:-1]  # the block read backwards, from 0 on
    product = inverse_transform(transform(turned) * transform(windows) % MODULUS)[:, :b]
    squares = np.cumsum(np.hstack((np.zeros((len(windows), 1), np.int64), windows**2)), 1)
    return ((blocks**2).sum(1)[:, None] + squares[:, b : 2 * b] - squares[:, :b] - 2 * product) % MODULUS


def _next_same(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Small numbers of the words, and how many words later each occurs again in its text."""
    _, number = np.unique(words, return_inverse=True)
    order = np.argsort(text * (int(number.max(initial=0)) + 1) + number, kind="stable")
    gap = np.full(len(words), len(words) + 1)
    same = (number[order][1:] == number[order][:-1]) & (text[order][1:] == text[order][:-1])
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return number, gap


class _Found:
    """The runs of a chunk of texts. Places count through the chunk; a text is ``first:last``."""

    def __init__(self, number: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.number, self.first, self.last = number, first, last
        self.runs: list[set[tuple[int, int, int]]] = [set() for _ in first]  # (start, end, period)

    def snapshot(self) -> None:
        """Let ``covered`` know the runs found so far."""
        spans = np.array(sorted((s, e) for runs in self.runs for s, e, _ in runs), np.int64).reshape(-1, 2)
        self.starts, self.reach = spans[:, 0], np.concatenate(([-1], np.maximum.accumulate(spans[:, 1])))

    def covered(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each ``low:high`` lies in a run found before the snapshot. Texts lie apart, so the
        furthest end of the runs that start up to ``low`` decides."""
        return self.reach[np.searchsorted(self.starts, low, "right")] >= high

    def extend(self, text: int, at: int, distance: int) -> None:
        """Take in the run with this period around a place whose word occurs again at the distance."""
        words, low, high = self.number, int(self.first[text]), int(self.last[text])
        start = at - _agree(words, at - 1, distance, -1, low)
        end = at + _agree(words, at, distance, 1, high - distance) + distance
        if end - start < max(SHORTEST, PERIODS * distance):
            return
        for smaller in _largest_divisors(distance):
            if (words[start : start + distance] == words[start + smaller : start + smaller + distance]).all():
                return
        self.runs[text].add((start, end, distance))


def _agree(words: np.ndarray, at: int, distance: int, step: int, end: int) -> int:
    """How many words on from ``at`` equal the ones at the distance, in blocks that grow."""
    total, size = 0, 64
    while True:
        if step > 0:
            n = min(size, end - at)
            equal = words[at : at + n] == words[at + distance : at + distance + n] if n > 0 else None
        else:
            n = min(size, at + 1 - end)
            low = at + 1 - n
            equal = (words[low : at + 1] == words[low + distance : at + 1 + distance])[::-1] if n > 0 else None
        if equal is None:
            return total
        if not equal.all():
            return total + int(equal.argmin())
        total, at, size = total + n, at + step * n, 2 * size


def _largest_divisors(n: int) -> list[int]:
    """n over each of its prime factors: a smaller period that divides n divides one of these."""
    out, rest, factor = [], n, 2
    while factor * factor <= rest:
        if rest % factor == 0:
            out.append(n // factor)
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return out + ([n // rest] if rest > 1 else [])


def find_runs(words: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start, then period. ``words`` are hashes of
    all texts' words; those of text i are ``offsets[i]:offsets[i + 1]``."""
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(len(sizes)), sizes)
    number, gap = _next_same(words, text)
    found = _Found(number, offsets[:-1], offsets[1:])
    scale = LEAST
    while scale == LEAST or (sizes >= PERIODS * scale).any():
        near = np.concatenate(([0], np.cumsum(gap < 2 * scale)))  # words before a place that occur again soon enough
        per_text = np.where(sizes >= max(SHORTEST, PERIODS * scale), sizes // scale, 0)
        owner = np.repeat(np.arange(len(sizes)), per_text)
        block = offsets[owner] + scale * (np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text))
        left = near[block + scale] - near[block] == scale
        _search_scale(found, number, owner[left], block[left], scale)
        scale *= 2
    return [sorted((s - int(offsets[i]), e - s, q) for s, e, q in runs) for i, runs in enumerate(found.runs)]


def _search_scale(found: _Found, number: np.ndarray, owner: np.ndarray, block: np.ndarray, scale: int) -> None:
    """Find the runs with periods from ``scale`` (1 at the least scale) to below ``2 * scale``."""
    found.snapshot()
    new = ~found.covered(block, np.minimum(block + 3 * scale, found.last[owner]))
    owner, block = owner[new], block[new]
    codes = number % max(2, int(np.sqrt((MODULUS - 1) / scale)))
    codes = np.concatenate((codes, np.zeros(3 * scale, np.int64)))
    at_once = max(1, BATCH // (2 * scale))
    seen: dict[tuple[int, int], int] = {}  # up to where the stretch with this distance has been looked at
    for i in range(0, len(block), at_once):
        starts, owners = block[i : i + at_once], owner[i : i + at_once]
        inside = codes[starts[:, None] + np.arange(scale)]
        for after in (0, scale) if scale == LEAST else (scale,):
            windows = codes[starts[:, None] + after + np.arange(2 * scale)]
            which, place = np.nonzero(squared_differences(inside, windows) == 0)
            distance = place + after
            end = starts[which] + distance + scale
            # inside a run of a smaller period the distance is a multiple of that
            fits = (distance > 0) & (end <= found.last[owners[which]]) & ~found.covered(starts[which], end)
            for k, d in zip(which[fits].tolist(), distance[fits].tolist(), strict=True):
                t, at = int(owners[k]), int(starts[k])
                if at < seen.get((t, d), -1):
                    continue  # in a stretch that this distance has been extended over
                if (number[at : at + scale] != number[at + d : at + d + scale]).any():
                    continue  # equal codes of different words
                seen[t, d] = at + _agree(number, at, d, 1, int(found.last[t]) - d)
                found.extend(t, at, d)


def plant(words: list, doc_id: int) -> list:
    """The words with a periodic tail, in every tenth document by the crc32 of its id."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def _digests(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    best = None
    for s, n, q in runs:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = words
    if runs:
        drop = np.zeros(len(words) + 1, np.int64)
        for s, n, q in runs:
            drop[s + q] += 1
            drop[s + n] -= 1
        stays = np.cumsum(drop[:-1]) == 0
        kept = [w for w, stay in zip(words, stays.tolist(), strict=True) if stay]
    start, length, period = best or (None, None, None)
    milli = 1000 * length // period if best else None
    return (
        len(runs), start, length, period, milli,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", planted: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id and the columns of ``RUNS``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0; capitals count. ``start``, ``length``, ``period``
    and ``exponent_milli`` (1000 * length / period, rounded down) describe the run with the greatest
    length / period; ties go to the smallest start, then period; without a run they are null.
    ``runs_sha256`` is over the lines ``start,length,period`` of all runs by start, then period.
    ``collapsed_sha256`` is over the words, joined by one space, that are left when each run keeps its
    first period. With ``planted`` some documents first get a periodic tail (see ``plant``; the id null gets none).
    Null and empty texts have no words and no runs. Repeated rows count each on their own. Other
    columns are left out. An empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text", 2 << 20):
                ids = chunk.column("doc_id").to_pylist()
                found = words_of(chunk.column("text"), UNBLANK, lower=False)
                offsets, hashes = found.offsets, found.hashes
                texts = [(x or "").encode().split() for x in chunk.column("text").to_pylist()]
                if planted:
                    for i, doc in enumerate(ids):
                        if doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0:
                            low, high = offsets[i], offsets[i + 1]
                            hashes[low:high] = hashes[low + np.array(plant(list(range(high - low)), doc), np.int64)]
                            texts[i] = plant(texts[i], doc)
                runs = find_runs(hashes, offsets)
                facts = list(zip(*map(_digests, texts, runs), strict=True))
                arrays = [pa.array(x, pa.int64()) for x in facts[:5]] + [pa.array(x, pa.string()) for x in facts[5:]]
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc_id"), *arrays],
                    names=["doc_id", *[f.strip().split()[0] for f in RUNS.split(",")]],
                )

    return rows.mapInArrow(search, f"doc_id bigint, {RUNS}")


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    return periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), planted=True)
