"""Centroid clustering of integer vectors with PCA-rotated filtering.

1. Every component becomes an integer; all distances and means that decide anything are
   computed in integers.
2. The covariance of all vectors gives a rotation. Each vector is stored with its ``LEAD``
   leading rotated coordinates and the norm of the rest.
3. In a round the centroids are rotated likewise. A rotation keeps distances, and the rests
   of two vectors lie at least the difference of their norms apart, so
   ``|lead - lead'|^2 + (rest - rest')^2`` bounds the squared distance from below. The
   centroid with the least bound is measured in integers; of the others only those whose bound,
   less what rounding may have added, does not exceed that distance.
4. Each task sums its vectors by centroid; the sums meet in one grouped aggregation of
   ``k x dims`` rows, which is all that reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftspark.llm.common import stored

LEAD = 16  # rotated coordinates stored for each vector
LARGEST = 1 << 27  # of a component: squared distances of 64 of them fit 64 bits
SLACK = 1e-9  # of the squared norms, more than rounding can add to a bound
STORED = "vec_id bigint, whole binary, lead binary, rest double"


def _kept(vectors: DataFrame, dims: int, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, embedding) of the vectors with ``dims`` finite components."""
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("embedding")
    )
    # NaN is larger than infinity here, so one comparison finds both
    bad = F.exists("embedding", lambda x: x.isNull() | (F.abs(x) >= float("inf")))
    return rows.where((F.size("embedding") == dims) & ~bad)


def _integers(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """The vectors of a list column as rows of integers."""
    floats = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, dims)
    if floats.size and np.abs(floats).max() > LARGEST:
        raise ValueError(f"a component lies beyond {LARGEST}: squared distances would not fit 64 bits")
    return floats.astype(np.int64)


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    raw = np.ascontiguousarray(rows)
    width = raw.shape[1] * raw.itemsize
    offsets = width * np.arange(len(raw) + 1, dtype=np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())]
    ).cast(pa.binary())


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_buffer() for x in column), kind).reshape(len(column), width)


def rotation(kept: DataFrame, dims: int, scale: int) -> np.ndarray:
    """An orthonormal matrix whose first columns carry most of the vectors' variance."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            x = _integers(batch.column(0), dims, scale).astype(np.float64)
            x = np.hstack((x, np.ones((len(x), 1))))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "total"])

    cells = kept.select("embedding").mapInArrow(moments, "cell bigint, total double").groupBy("cell").agg(F.sum("total").alias("total"))
    total = np.zeros((dims + 1) ** 2)
    for cell, value in cells.collect():  # (dims + 1) squared rows
        total[cell] = value
    total = total.reshape(dims + 1, dims + 1)
    n = max(1.0, total[dims, dims])
    mean = total[dims, :dims] / n
    _, axes = np.linalg.eigh(total[:dims, :dims] / n - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1])


def rotated(kept: DataFrame, axes: np.ndarray, dims: int, scale: int, lead: int) -> DataFrame:
    """The stored vectors: integers, leading rotated coordinates, norm of the rest."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _integers(batch.column("embedding"), dims, scale)
            turned = whole @ axes
            rest = np.sqrt((turned[:, lead:] ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), _binary(whole.astype("<i4")), _binary(turned[:, :lead].astype("<f8")), pa.array(rest)],
                names=["vec_id", "whole", "lead", "rest"],
            )

    return stored(kept.mapInArrow(turn, STORED), "vectors")


class Nearest:
    """Finds the nearest centroid (ties: the first) of rotated vectors. ``measured`` counts exact distances."""

    def __init__(self, centroids: np.ndarray, axes: np.ndarray, lead: int):
        turned = centroids @ axes
        self.centroids, self.lead = centroids, turned[:, :lead]
        self.rest = np.sqrt((turned[:, lead:] ** 2).sum(1))
        self.measured = 0

    def _measure(self, whole: np.ndarray, number: np.ndarray | int) -> np.ndarray:
        self.measured += len(whole)
        return ((whole - self.centroids[number]) ** 2).sum(1)

    def find(self, whole: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each vector."""
        norms = (lead**2).sum(1)[:, None] + (self.lead**2).sum(1) + rest[:, None] ** 2 + self.rest**2
        apart = (lead**2).sum(1)[:, None] + (self.lead**2).sum(1) - 2 * lead @ self.lead.T
        bound = apart + (rest[:, None] - self.rest) ** 2 - SLACK * (norms + 1)
        first = bound.argmin(1)
        best, distance = first.copy(), self._measure(whole, first)
        for number in range(len(self.centroids)):
            left = np.flatnonzero((first != number) & (bound[:, number] <= distance))
            found = self._measure(whole[left], number)
            nearer = (found < distance[left]) | ((found == distance[left]) & (number < best[left]))
            best[left[nearer]], distance[left[nearer]] = number, found[nearer]
        return best, distance


def _batches(batches: Iterator[pa.RecordBatch], dims: int, lead: int) -> Iterator[tuple]:
    for batch in batches:
        if len(batch):
            yield (
                batch,
                _matrix(batch.column("whole"), "<i4", dims).astype(np.int64),
                _matrix(batch.column("lead"), "<f8", lead),
                batch.column("rest").to_numpy(zero_copy_only=False),
            )


def _moved(vectors: DataFrame, centroids: np.ndarray, axes: np.ndarray, lead: int) -> np.ndarray:
    """The centroids after one round; one without vectors stays."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(centroids, axes, lead)
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, whole, leads, rest in _batches(batches, dims, lead):
            number, _ = nearest.find(whole, leads, rest)
            for c in range(k):
                total[c] += whole[number == c].sum(0)
            n += np.bincount(number, minlength=k)
        cells = np.arange(k * dims)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(total.ravel()), pa.array(np.repeat(n, dims))], names=["cell", "total", "n"]
        )

    sums = vectors.select("whole", "lead", "rest").mapInArrow(add, "cell bigint, total bigint, n bigint")
    sums = sums.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for cell, value, n in sums.collect():  # k x dims rows
        if n:
            moved[cell // dims, cell % dims] = int(value) // n  # rounds down, as integers do here
    return moved


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
    lead: int = LEAD,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """One row per kept vector: (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256).

    Kept are vectors of exactly ``dims`` components, none of them null, NaN or infinite; a
    component x is floor(scale * x). Other columns are left out, whatever their names. The first
    centroids are the k kept vectors whose ``seed:vec_id`` has the smallest SHA-256; rows with one id are
    ordered by their components, and a null id comes last. Every round assigns each vector to
    the nearest centroid (ties: the smaller number) and moves each centroid that has vectors to their
    mean, rounded down. Repeated rows count each on their own. Fewer vectors than k give as many
    centroids as there are vectors; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    kept = _kept(vectors, dims, vec_id, embedding)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(name.asc_nulls_last(), "embedding").select("embedding").limit(k).collect()
    centroids = np.floor(scale * np.array([r[0] for r in first], np.float64).reshape(-1, dims)).astype(np.int64)
    schema = "vec_id bigint, cluster int, distance bigint"
    if not len(centroids):
        assigned = spark.createDataFrame([], schema)
    else:
        axes = rotation(kept, dims, scale)
        table = rotated(kept, axes, dims, scale, lead)
        for _ in range(rounds):
            centroids = _moved(table, centroids, axes, lead)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nearest = Nearest(centroids, axes, lead)
            for batch, whole, leads, rest in _batches(batches, dims, lead):
                number, distance = nearest.find(whole, leads, rest)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"],
                )

        assigned = stored(table.mapInArrow(assign, schema), "assigned")
    sums = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())  # k rows
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = [(c, total, sum(sums.values()), digests[c]) for c, total in sums.items()]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(rounds: int = 10) -> str:
    """The same clustering in plain SQL, round by round."""
    steps = [
        """v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        """c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR))) - 1 AS c, e AS ce FROM v
  QUALIFY c < 8)""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, e, c, list_sum(list_transform(list_zip(e, ce), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{i}
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(m, ce) AS ce FROM c{i} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM (
      SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{i})
      GROUP BY c, i) GROUP BY c) USING (c))""")
    return f"""WITH {', '.join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(ce, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)"""


OP12_SQL = _sql()
