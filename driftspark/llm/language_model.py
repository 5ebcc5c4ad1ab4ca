"""Language-model scores by a log-bilinear neural model.

1. All training words are counted. The most frequent ones are the classes of the model,
   with one class for all other words and one for the end of a text.
2. The model predicts a vector from the vectors of the two words before, and scores a class
   by its product with the class's vector plus a bias. It is trained in numpy by noise-
   contrastive estimation: each task takes its share of the training texts through the
   current weights, and the weights of all tasks are averaged by their token counts.
3. Scores are normalised over all classes by batched matrix products, once per different
   context of a chunk. A word outside the classes gets the probability of their common class
   times its share of the smoothed counts there.

Counts of frequent words go to the tasks as a table of fixed size; those of all other words
are joined by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftspark.llm.common import chunks, most_frequent, stored
from driftspark.llm.words import UNBLANK, words_of

CLASSES = 1024
WIDTH = 24
FREQUENT = 1 << 18  # words whose counts the tasks hold
ROUNDS = 2
BATCH = 8192
NOISE = 64
RATE = 0.1
OTHER, END = 0, 1  # class numbers; words follow
END_HASH = 0x454E44  # stands for the end of a text among the word hashes
BLOCK = 4096


def _lookup(table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each hash whether it is in the sorted table, and where."""
    if not len(table):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return table[at] == hashes, at


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(hash, n): how often each word occurs in the texts, ends of texts included; stored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, text):
                hashes, n = np.unique(words_of(chunk.column(text), UNBLANK).hashes, return_counts=True)
                hashes = np.append(hashes, np.uint64(END_HASH)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(np.append(n, len(chunk)))], names=["hash", "n"])

    counted = docs.select(text).mapInArrow(count, "hash bigint, n bigint")
    return stored(counted.groupBy("hash").agg(F.sum("n").alias("n")), "counts")


@dataclass
class Vocabulary:
    frequent: np.ndarray  # sorted hashes and their counts
    counts: np.ndarray
    words: np.ndarray  # sorted hashes of the classes from 2 on
    noise: np.ndarray  # share of each class among the training tokens
    tokens: int
    types: int
    other: int  # smoothed count of all words outside the classes

    def classes(self, hashes: np.ndarray) -> np.ndarray:
        known, at = _lookup(self.words, hashes)
        return np.where(known, at + 2, OTHER)


def vocabulary(counts: DataFrame, classes: int = CLASSES, frequent: int = FREQUENT) -> Vocabulary:
    total = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, types = int(total[0] or 0), int(total[1] or 0)
    top = most_frequent(counts.where(F.col("hash") != END_HASH), frequent).toPandas().sort_values(["n", "hash"], ascending=[False, True])
    end = counts.where(F.col("hash") == END_HASH).first()
    hashes, n = top["hash"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    words, of_words = hashes[: max(0, classes - 2)], n[: max(0, classes - 2)]
    order = np.argsort(words)
    n_end = int(end["n"]) if end else 0
    outside = tokens - n_end - int(of_words.sum())
    mass = np.concatenate(([outside, n_end], of_words[order])).astype(float) + 1
    every = np.argsort(hashes)
    types_outside = max(0, types - len(words) - (1 if end else 0))
    return Vocabulary(hashes[every], n[every], words[order], mass / mass.sum(), tokens, types, outside + types_outside + 1)


@dataclass
class Model:
    """Vectors of context and predicted classes, a matrix for each place before, biases."""

    context: np.ndarray
    target: np.ndarray
    places: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, noise: np.ndarray, width: int = WIDTH) -> Model:
        random = np.random.default_rng(7)
        small = lambda *shape: random.normal(0, 0.1, shape).astype(np.float32)
        places = np.stack([np.eye(width, dtype=np.float32) * 0.5] * 2)
        return cls(small(len(noise), width), small(len(noise), width), places, np.log(noise).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.places, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def filled(self, flat: np.ndarray) -> Model:
        ends = np.cumsum([p.size for p in self.parts()])[:-1]
        return Model(*[x.reshape(p.shape).astype(np.float32) for x, p in zip(np.split(flat, ends), self.parts(), strict=True)])

    def predicted(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        return self.context[near] @ self.places[0] + self.context[far] @ self.places[1]

    def log_norms(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Log of the sum over all classes, for each context."""
        out = np.empty(len(near))
        for i in range(0, len(near), BLOCK):
            scores = self.predicted(near[i : i + BLOCK], far[i : i + BLOCK]) @ self.target.T
            scores += self.bias
            top = scores.max(1, keepdims=True)
            scores -= top
            out[i : i + BLOCK] = np.log(np.exp(scores, out=scores).sum(1)) + top[:, 0]
        return out

    def log_probabilities(self, near: np.ndarray, far: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural log probability of each class in its context."""
        pairs, inverse = np.unique(near * len(self.bias) + far, return_inverse=True)
        norms = self.log_norms(pairs // len(self.bias), pairs % len(self.bias))
        out = np.empty(len(word))
        for i in range(0, len(word), 1 << 17):
            part = slice(i, i + (1 << 17))
            scores = np.einsum("ij,ij->i", self.predicted(near[part], far[part]), self.target[word[part]])
            out[part] = scores + self.bias[word[part]]
        return out - norms[inverse]


def _add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add each row to the table's row that it belongs to; rows of one place are summed first."""
    order = np.argsort(at.astype(np.uint32), kind="stable")
    places = at[order]
    first = np.flatnonzero(np.diff(places, prepend=-1))
    table[places[first]] += np.add.reduceat(rows[order], first, axis=0)


class _Trainer:
    """Noise-contrastive estimation with Adagrad steps."""

    def __init__(self, model: Model, noise: np.ndarray, seed: int):
        self.m = Model(*[p.copy() for p in model.parts()])
        self.seen = [np.full_like(p, 1e-2) for p in self.m.parts()]
        self.noise, self.cumulated = np.log(noise).astype(np.float32), np.cumsum(noise)
        self.random, self.tokens = np.random.default_rng(seed), 0

    def step(self, near: np.ndarray, far: np.ndarray, word: np.ndarray, samples: int = NOISE) -> None:
        m, n = self.m, len(word)
        self.tokens += n
        drawn = np.minimum(np.searchsorted(self.cumulated, self.random.random(samples)), len(self.noise) - 1)
        r_near, r_far = m.context[near], m.context[far]
        predicted = r_near @ m.places[0] + r_far @ m.places[1]
        k = np.log(np.float32(samples))
        vectors = m.target[word]
        data = np.einsum("ij,ij->i", predicted, vectors) + m.bias[word] - self.noise[word] - k
        push = 1 / (1 + np.exp(np.clip(data, -30, 30)))  # 1 - P(data)
        fake = predicted @ m.target[drawn].T + (m.bias[drawn] - self.noise[drawn] - k)
        pull = 1 / (1 + np.exp(-np.clip(fake, -30, 30)))  # P(data) of noise
        back = push[:, None] * vectors - pull @ m.target[drawn]
        target, bias, context = np.zeros_like(m.target), np.zeros_like(m.bias), np.zeros_like(m.context)
        _add_rows(target, word, push[:, None] * predicted)
        np.subtract.at(target, drawn, pull.T @ predicted)
        bias += np.bincount(word, push, minlength=len(bias)).astype(np.float32)
        np.subtract.at(bias, drawn, pull.sum(0))
        _add_rows(context, near, back @ m.places[0].T)
        _add_rows(context, far, back @ m.places[1].T)
        places = np.stack((r_near.T @ back, r_far.T @ back))
        for part, grown, seen in zip(m.parts(), (context, target, places, bias), self.seen, strict=True):
            grown /= np.float32(n)
            seen += grown * grown
            part += np.float32(RATE) * grown / np.sqrt(seen)


def _sequences(column: pa.Array, known: Vocabulary) -> tuple[np.ndarray, ...]:
    """Texts as classes with an end each: word before, the one before that, class, text, hash."""
    words = words_of(column, UNBLANK)
    counts = np.diff(words.offsets)
    text = np.repeat(np.arange(len(counts)), counts + 1)
    ends = np.cumsum(counts + 1) - 1
    hashes = np.full(len(text), END_HASH, np.uint64)
    is_word = np.ones(len(text), bool)
    is_word[ends] = False
    hashes[is_word] = words.hashes
    classes = np.full(len(text), END, np.int64)
    classes[is_word] = known.classes(words.hashes)
    near, far = np.full(len(text), END, np.int64), np.full(len(text), END, np.int64)
    near[1:], far[2:] = classes[:-1], classes[:-2]
    far[1:][text[1:] != text[:-1]] = END
    starts = ends - counts
    near[starts] = END
    far[starts] = END
    second = starts[counts > 0] + 1
    far[second] = END
    return near, far, classes, text, hashes


def train(docs: DataFrame, text: str, known: Vocabulary, rounds: int = ROUNDS) -> Model:
    """The model after some rounds over all training texts."""
    spark = docs.sparkSession
    model = Model.start(known.noise)
    known_of = spark.sparkContext.broadcast(known)
    for number in range(rounds):
        current = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], current=current, number=number) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            known = known_of.value
            trainer = _Trainer(current.value, known.noise, 1000 * number + TaskContext.get().partitionId())
            for batch in batches:
                for chunk in chunks(batch, text):
                    near, far, word, _, _ = _sequences(chunk.column(text), known)
                    order = trainer.random.permutation(len(word))
                    for i in range(0, len(word), BATCH):
                        part = order[i : i + BATCH]
                        trainer.step(near[part], far[part], word[part])
            flat = trainer.m.flat().astype(np.float64) * trainer.tokens
            blocks = range(0, len(flat), BLOCK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(range(len(blocks))), pa.int32()),
                    pa.array([float(trainer.tokens)] * len(blocks)),
                    pa.array([flat[b : b + BLOCK].tobytes() for b in blocks], pa.binary()),
                ],
                names=["block", "weight", "values"],
            )

        def add(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(v.as_buffer()) for v in table.column("values"))
            weight = pa.compute.sum(table.column("weight")).as_py()
            mean = total / weight if weight else total
            return pa.table({"block": [table.column("block")[0].as_py()], "weight": [weight], "values": [mean.tobytes()]}, schema=table.schema)

        schema = "block int, weight double, values binary"
        # one row per task and block comes in, one row per block goes to the driver
        averaged = docs.select(text).mapInArrow(run, schema).groupBy("block").applyInArrow(add, schema).collect()
        if averaged and averaged[0]["weight"]:
            model = model.filled(np.concatenate([np.frombuffer(r["values"]) for r in sorted(averaged, key=lambda r: r["block"])]))
    return model


def score(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, classes: int = CLASSES, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    ``training`` says which rows the counts and the model learn from; null counts as true. A
    null or empty text has its end only. Without training texts the model is uniform over
    what it starts with. Other columns are left out.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.coalesce(training, F.lit(True)).alias("training"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    learnt = rows.where("training").select("text")
    counts = word_counts(learnt, "text")
    known = vocabulary(counts, classes, frequent)
    model = train(learnt, "text", known, rounds)
    spark = docs.sparkSession
    known_of, model_of = spark.sparkContext.broadcast(known), spark.sparkContext.broadcast(model)
    n_end = 0 if not known.tokens else int((counts.where(F.col("hash") == END_HASH).first() or {"n": 0})["n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = known_of.value, model_of.value
        for batch in batches:
            for chunk in chunks(batch, "text"):
                near, far, word, doc, hashes = _sequences(chunk.column("text"), known)
                found, at = _lookup(known.frequent, hashes)
                is_end = hashes == np.uint64(END_HASH)
                n = np.where(found, known.counts[at] if len(known.counts) else 0, 0)
                n[is_end] = n_end
                local = found | is_end
                total = lambda x, doc=doc, size=len(chunk): np.bincount(doc, x, minlength=size)
                grown = np.log10(n + 1.0)
                other = (word == OTHER) & local
                lm = total(model.log_probabilities(near, far, word) / np.log(10))
                lm += total(np.where(other, grown, 0)) - total(word == OTHER) * np.log10(known.other)
                # words without a local count, once per text
                rest = np.flatnonzero(~local)
                order = rest[np.lexsort((hashes[rest], doc[rest]))]
                d, h = doc[order], hashes[order]
                new = np.ones(len(d), bool)
                new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(d)))
                row = chunk.column("row")
                size, more = len(chunk), len(first)
                none = lambda k, t: pa.nulls(k, t)
                both = lambda a, b: pa.concat_arrays([a, b])
                yield pa.RecordBatch.from_arrays(
                    [
                        both(row, row.take(pa.array(d[first]))),
                        both(chunk.column("doc_id"), none(more, pa.int64())),
                        both(chunk.column("training"), none(more, pa.bool_())),
                        both(none(size, pa.int64()), pa.array(h[first].view(np.int64))),
                        both(pa.array(total(np.ones(len(doc))).astype(np.int64)), pa.array(times, pa.int64())),
                        both(pa.array(total((n > 0).astype(float)).astype(np.int64)), none(more, pa.int64())),
                        both(pa.array(total(np.where(local, grown, 0))), none(more, pa.float64())),
                        both(pa.array(lm), none(more, pa.float64())),
                    ],
                    names=["row", "doc_id", "training", "hash", "n", "known", "base", "lm"],
                )

    schema = "row bigint, doc_id bigint, training boolean, hash bigint, n bigint, known bigint, base double, lm double"
    scored = stored(rows.mapInArrow(run, schema), "scored")
    rare = scored.where("hash IS NOT NULL").select("row", "hash", F.col("n").alias("times"))
    grown = F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)
    rare = rare.join(counts, "hash", "left").groupBy("row").agg(
        F.sum(grown).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known")
    )
    bottom = float(np.log10(known.tokens + known.types + 1.0))
    more = F.coalesce("more", F.lit(0.0))
    return scored.where("hash IS NULL").join(rare, "row", "left").select(
        "doc_id",
        (~F.col("training")).alias("held_out"),
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + more - F.col("n") * bottom).alias("base_score"),
        (F.col("lm") + more).alias("score"),
    )


def op10_language_model(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, F.crc32(F.col("doc_id").cast("string")) % 7 != 2)
