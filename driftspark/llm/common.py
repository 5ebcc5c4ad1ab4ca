"""Helpers that several training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BYTES = 8 << 20


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="driftspark-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables below ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a temporary folder for its
    life; a cluster has no folder that all machines see, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: cuts the lineage and
    keeps one version of the rows, which survives lost executors."""
    path = shared_folder(frame.sparkSession, name)
    frame.write.options(**{"compression": "zstd", **options}).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def stored_in_groups(frame: DataFrame, name: str, size: int) -> DataFrame:
    """:func:`stored` with row groups of about ``size`` bytes: a task that reads the rows holds one of them."""
    return stored(frame, name, **{"parquet.block.size": str(size)})


def most_frequent(counts: DataFrame, limit: int, n: str = "n") -> DataFrame:
    """The rows with the largest counts, at most ``limit`` of them: whole classes of counts that
    differ by less than a twentieth. No task and no driver sees more than the classes' sizes."""
    size_class = F.floor(F.log2(F.col(n)) * 16).cast("int")
    sizes = {r["class"]: r["count"] for r in counts.groupBy(size_class.alias("class")).count().collect()}
    total, last = 0, None
    for found in sorted(sizes, reverse=True):
        total += sizes[found]
        if total > limit:
            break
        last = found
    return counts.where(F.lit(False) if last is None else size_class >= last)


def free_name(frame: DataFrame, wanted: str) -> str:
    """The wanted column name, lengthened until no column of the frame has it."""
    taken = {c.lower() for c in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each; a longer text stands alone."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if len(sizes) > start:
        yield batch.slice(start)


def with_columns(batch: pa.RecordBatch, names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])


def extended(frame: DataFrame, **fields: str) -> T.StructType:
    """The schema of the frame and further columns, given as DDL types."""
    return T.StructType([*frame.schema.fields, *(T.StructField(n, T.DataType.fromDDL(t)) for n, t in fields.items())])
