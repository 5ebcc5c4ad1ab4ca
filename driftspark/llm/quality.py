"""Quality classifier with hierarchical empirical Bayes.

1. A logistic model is fitted on a bounded sample of labelled documents: the shares of
   character kinds, repeated lines and words, and the presence of the words that tell
   rejected from accepted documents best. It gives each document's evidence, a log
   likelihood ratio for rejection.
2. The evidence of all documents is summed by host and by path. A host's rate of rejected
   documents is shrunk towards the global rate, a path's rate towards its host's. How
   strongly is estimated from the spread of the groups, so that sparse groups fall back to
   what stands above them. A document is left out of its own groups' rates.
3. The posterior of a document combines its evidence with its path's rate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftspark.llm.common import chunks, extended, free_name, stored, with_columns
from driftspark.llm.words import UNBLANK, hash_spans, mix, text_bytes, words_of

SAMPLE = 20_000
VOCABULARY = 512
LEAST_DOCS = 8
REJECT_ABOVE = 0.5
SHAPES = 12

_KIND = np.zeros(256, np.int64)  # other letters and bytes
_KIND[[32, *range(9, 14)]] = 1
_KIND[48:58] = 2
_KIND[65:91] = 3
_KIND[97:123] = 4
for _c in b"!#$%&*|<>{}[]=~^_@+\\":
    _KIND[_c] = 5
for _c in b".,;:?'\"()-/":
    _KIND[_c] = 6


def shapes(column: pa.Array) -> np.ndarray:
    """``SHAPES`` numbers per text on its form; all are 0 for an empty text."""
    words = words_of(column, UNBLANK)
    data, offsets = text_bytes(column)
    n = len(column)
    out = np.zeros((n, SHAPES))
    text = np.repeat(np.arange(n), np.diff(offsets))
    kinds = np.bincount(text * 7 + _KIND[data], minlength=7 * n).reshape(n, 7)
    total = np.maximum(1, kinds.sum(1))
    out[:, :7] = kinds / total[:, None]
    counts = np.diff(words.offsets)
    of_word = np.repeat(np.arange(n), counts)
    some = np.maximum(1, counts)
    out[:, 7] = np.log1p(counts) / 10
    out[:, 8] = np.bincount(of_word, words.lengths, minlength=n) / some / 10
    out[:, 9] = 1 - _distinct(of_word, words.hashes, n) / some
    # lines: spans between line feeds
    ends = np.unique(np.concatenate((np.flatnonzero(data == 10) + 1, offsets[1:])))
    ends = ends[ends > 0]
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    line_text = np.searchsorted(offsets, starts, side="right") - 1
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    hashes = _line_hashes(padded, starts, ends - starts)
    lines = np.bincount(line_text, minlength=n) if len(starts) else np.zeros(n)
    out[:, 10] = 1 - _distinct(line_text, hashes, n) / np.maximum(1, lines)
    out[:, 11] = lines / some
    out[counts == 0] = 0
    return out


def _line_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each whole line, as the sum of hashes of its 64-byte blocks and their numbers."""
    blocks = (lengths + 63) // 64
    first = np.cumsum(blocks) - blocks
    nth = np.arange(blocks.sum()) - np.repeat(first, blocks)
    at, size = np.repeat(starts, blocks) + 64 * nth, np.minimum(np.repeat(lengths, blocks) - 64 * nth, 64)
    mixed = mix(hash_spans(data, at, size) ^ mix(nth.astype(np.uint64) + np.uint64(1)))
    return np.add.reduceat(mixed, first) if len(first) else mixed


def _distinct(group: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many different hashes each group has."""
    order = np.lexsort((hashes, group))
    g, h = group[order], hashes[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])
    return np.bincount(g[new], minlength=n) if len(g) else np.zeros(n)


def _present(column: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, vocabulary number) of each vocabulary word that a text has, once."""
    words = words_of(column, UNBLANK)
    if not len(vocabulary) or not len(words.hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, words.hashes), len(vocabulary) - 1)
    hit = vocabulary[at] == words.hashes
    text = np.repeat(np.arange(len(column)), np.diff(words.offsets))[hit]
    pair = np.unique(text * len(vocabulary) + at[hit])
    return pair // len(vocabulary), pair % len(vocabulary)


@dataclass
class Model:
    vocabulary: np.ndarray  # sorted word hashes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # shapes, then words
    bias: float  # of the evidence: the rate of the sample is taken off
    rate: float

    def evidence(self, column: pa.Array) -> np.ndarray:
        out = (shapes(column) - self.mean) / self.scale @ self.weights[:SHAPES] + self.bias
        text, word = _present(column, self.vocabulary)
        return out + np.bincount(text, self.weights[SHAPES + word], minlength=len(column))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 25) -> np.ndarray:
    """Weights by Newton steps; the last column of ``x`` is the free intercept."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], penalty)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def rejected_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, bad): rejected where any label calls the document toxic or of low quality."""
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(bad).alias("bad")).where("bad IS NOT NULL")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` labelled documents, taken by a hash of the id. ``labels`` has
    (doc_id, bad). None without labelled documents of both kinds."""
    chosen = labels.select(F.col("doc_id").alias("label_id"), "bad").orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    rows = docs.join(F.broadcast(chosen), F.col(f"`{doc_id}`") == F.col("label_id"))
    rows = stored(rows.select("bad", F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text"):
                words = words_of(chunk.column("text"), UNBLANK)
                of_word = np.repeat(np.arange(len(chunk)), np.diff(words.offsets))
                order = np.lexsort((words.hashes, of_word))
                d, h = of_word[order], words.hashes[order]
                new = np.ones(len(d), bool)
                new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
                d, h = d[new], h[new]
                bad = chunk.column("bad").to_numpy(zero_copy_only=False)[d]
                words_, inverse = np.unique(h, return_inverse=True)
                n_bad = np.bincount(inverse, bad, minlength=len(words_)).astype(np.int64)
                n = np.bincount(inverse, minlength=len(words_))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words_.view(np.int64)), pa.array(n_bad), pa.array(n - n_bad)], names=["hash", "n_bad", "n_good"]
                )

    totals = rows.agg(F.sum("bad"), F.sum(1 - F.col("bad"))).first()
    if not totals[0] or not totals[1]:
        return None
    counts = rows.mapInArrow(count, "hash bigint, n_bad bigint, n_good bigint").groupBy("hash").agg(
        F.sum("n_bad").alias("b"), F.sum("n_good").alias("g")
    )
    all_bad, all_good = (float(t) for t in totals)
    gap = F.col("b") * all_good - F.col("g") * all_bad
    chi = gap * gap / ((F.col("b") + F.col("g")) * (all_bad + all_good - F.col("b") - F.col("g") + 1))
    best = counts.where(F.col("b") + F.col("g") >= LEAST_DOCS).orderBy(chi.desc(), "hash").limit(VOCABULARY)
    vocabulary = np.sort(np.array([r.hash for r in best.select("hash").collect()], np.int64).view(np.uint64))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text"):
                form = shapes(chunk.column("text"))
                doc, word = _present(chunk.column("text"), vocabulary)
                offsets = np.searchsorted(doc, np.arange(len(chunk) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column("bad"),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, len(form) * SHAPES + 1, SHAPES, dtype=np.int32)), pa.array(form.ravel())),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(word.astype(np.int32))),
                    ],
                    names=["bad", "form", "words"],
                )

    table = rows.mapInArrow(features, "bad int, form array<double>, words array<int>").toPandas()  # at most ``sample`` rows
    form = np.stack(table["form"].to_numpy())
    mean, scale = form.mean(0), np.maximum(form.std(0), 1e-6)
    x = np.zeros((len(table), SHAPES + len(vocabulary) + 1), np.float32)
    x[:, :SHAPES] = (form - mean) / scale
    x[np.repeat(np.arange(len(table)), table["words"].map(len)), SHAPES + np.concatenate(table["words"].to_list()).astype(np.int64)] = 1
    x[:, -1] = 1
    y = table["bad"].to_numpy(np.float64)
    w = _logistic(x, y, penalty=1.0)
    rate = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
    return Model(vocabulary, mean, scale, w[:-1], float(w[-1] - np.log(rate / (1 - rate))), rate)


def with_evidence(docs: DataFrame, model: Model | None, text: str = "text") -> tuple[DataFrame, str]:
    """The documents with one more column, the log likelihood ratio for rejection; 0 without a model
    and for texts without words."""
    name = free_name(docs, "evidence")
    if model is None:
        return docs.withColumn(name, F.lit(0.0)), name
    known = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, text):
                column = chunk.column(text)
                value = np.clip(known.value.evidence(column), -20, 20)
                value[np.diff(words_of(column, UNBLANK).offsets) == 0] = 0
                yield with_columns(chunk, [name], [pa.array(value, pa.float64())])

    return docs.mapInArrow(score, extended(docs, **{name: "double"})), name


@dataclass
class Rates:
    """The global rate of rejected documents and the strengths of the shrinkage."""

    overall: float
    host_strength: float
    path_strength: float
    groups: DataFrame  # (host, path, n, s, host_n, host_s)


def _strength(means: DataFrame) -> float:
    """How many documents the group above counts for, by the method of moments. ``means`` has
    a group's count ``n``, its rate ``r``, the rate above it ``above``."""
    noise = F.col("above") * (1 - F.col("above")) / F.col("n")
    row = means.where("n > 1").agg(
        F.sum(F.col("n") * (F.pow(F.col("r") - F.col("above"), 2) - noise)),
        F.sum("n"),
        F.sum(F.col("n") * F.col("above") * (1 - F.col("above"))),
    ).first()
    if not row[1] or row[0] <= 0:
        return 1e6  # the groups differ no more than by chance
    return float(np.clip(row[2] / row[0] - 1, 1.0, 1e6))


def rates(scored: DataFrame, host: Column, path: Column, evidence: str, prior: float) -> Rates:
    """Sums of soft rejections by path and host. Null hosts and paths are groups of their own."""
    odds = float(np.log(prior / (1 - prior)))
    p = 1 / (1 + F.exp(-(F.col(f"`{evidence}`") + odds)))
    soft = scored.select(F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"), p.alias("p"))
    paths = stored(soft.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    n, s = hosts.agg(F.sum("host_n"), F.sum("host_s")).first()
    overall = float(np.clip((s or 0) / max(1, n or 0), 1e-4, 1 - 1e-4))
    host_strength = _strength(hosts.select(F.col("host_n").alias("n"), (F.col("host_s") / F.col("host_n")).alias("r"), F.lit(overall).alias("above")))
    joined = paths.join(hosts, "host")
    shrunk = (F.col("host_s") + host_strength * overall) / (F.col("host_n") + host_strength)
    path_strength = _strength(joined.select("n", (F.col("s") / F.col("n")).alias("r"), shrunk.alias("above")))
    return Rates(overall, host_strength, path_strength, joined)


def with_posteriors(scored: DataFrame, host: Column, path: Column, evidence: str, prior: float) -> tuple[DataFrame, dict[str, str]]:
    """Adds ``host_rate``, ``path_rate`` (without the document itself) and ``p_reject``."""
    found = rates(scored, host, path, evidence, prior)
    odds = float(np.log(prior / (1 - prior)))
    names = {n: free_name(scored, n) for n in ("host_rate", "path_rate", "p_reject")}
    groups = found.groups.select(F.struct("*").alias(g := free_name(scored, "group")))
    own = 1 / (1 + F.exp(-(F.col(f"`{evidence}`") + odds)))
    same = (F.col(f"{g}.host") == F.coalesce(host.cast("string"), F.lit(""))) & (F.col(f"{g}.path") == F.coalesce(path.cast("string"), F.lit("")))
    joined = scored.join(groups, same)
    host_rate = (F.col(f"{g}.host_s") - own + found.host_strength * found.overall) / (F.col(f"{g}.host_n") - 1 + found.host_strength)
    joined = joined.withColumn(names["host_rate"], F.least(F.greatest(host_rate, F.lit(1e-4)), F.lit(1 - 1e-4)))
    path_rate = (F.col(f"{g}.s") - own + found.path_strength * F.col(names["host_rate"])) / (F.col(f"{g}.n") - 1 + found.path_strength)
    joined = joined.withColumn(names["path_rate"], F.least(F.greatest(path_rate, F.lit(1e-4)), F.lit(1 - 1e-4)))
    logit = F.col(f"`{evidence}`") + F.log(F.col(names["path_rate"]) / (1 - F.col(names["path_rate"])))
    return joined.withColumn(names["p_reject"], 1 / (1 + F.exp(-logit))).drop(g), names


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, doc_id: str = "doc_id", text: str = "text", **options) -> tuple[DataFrame, dict[str, str]]:
    """The documents with ``evidence``, ``host_rate``, ``path_rate`` and ``p_reject`` (names that are
    free; the second value tells them). Without a model nothing is rejected: ``p_reject`` is then
    0. Null and empty texts have no evidence and get their path's rate. Repeated rows are scored
    each. ``labels`` has (doc_id, bad)."""
    model = fit(docs, labels, doc_id, text, **options)
    scored, evidence = with_evidence(docs, model, text)
    out, names = with_posteriors(scored, host, path, evidence, model.rate if model else 0.5)
    if model is None:
        out = out.withColumn(names["p_reject"], F.lit(0.0))
    return out, {**names, "evidence": evidence}


def drop_rejected(docs: DataFrame, labels: DataFrame, host: Column, path: Column, **options) -> DataFrame:
    """The documents whose posterior of rejection is at most ``REJECT_ABOVE``, with their own columns."""
    judged, names = classify(docs, labels, host, path, **options)
    return judged.where(F.col(names["p_reject"]) <= REJECT_ABOVE).select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = rejected_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged, names = classify(docs.select("doc_id", "text", "source", "lang"), labels, F.col("source"), F.col("lang"))
    return judged.select(
        "doc_id",
        *[F.round(F.col(names[c]), 6).alias(c) for c in ("evidence", "host_rate", "path_rate", "p_reject")],
        (F.col(names["p_reject"]) <= REJECT_ABOVE).alias("kept"),
    )
