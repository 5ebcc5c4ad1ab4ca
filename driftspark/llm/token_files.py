"""Token ids as Parquet list columns.

One row per document, in ascending id order over all files: ``place`` (ascending over
the files), ``doc_id``, ``n_tokens`` and ``ids``. The ids are dictionary-encoded, the
other columns delta-encoded; row groups and pages have set sizes, and the files carry
page indexes. So a range of documents, or the columns without ids, are read without
touching the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftspark.llm.common import chunks, shared_folder
from driftspark.llm.tokens import shared_encoder

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 1000
SCHEMA = "place bigint, doc_id bigint, n_tokens bigint, ids array<int>"


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    spaces: bool,
    doc_id: str = "doc_id",
    text: str = "text",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Encode every text (null: empty) and write the token files.

    Null ids come first; rows with one id are ordered by a hash of the text. An empty
    text has only the end id. Other columns are left out.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    placed = ordered.select(F.monotonically_increasing_id().alias("place"), "doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer, end_id, spaces)
        for batch in batches:
            for chunk in chunks(batch, "text", 4 << 20):
                ids, offsets = encoder.encode(chunk.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("place"), chunk.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), lists],
                    names=["place", "doc_id", "n_tokens", "ids"],
                )

    options = {
        "compression": "zstd",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(PAGE_ROWS),
        "parquet.writer.version": "PARQUET_2_0",
        **{f"parquet.enable.dictionary#{c}": "false" for c in ("place", "doc_id", "n_tokens")},
    }
    placed.mapInArrow(encode, SCHEMA).write.options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The token files; select columns and filter on doc_id to read only those pages."""
    return spark.read.schema(SCHEMA).parquet(path)


def token_digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each row: the count of all ids before it in
    file order, its ids, and their crc32 as little-endian 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = lists.flatten().to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            crcs = [zlib.crc32(values[e - n : e].tobytes()) for e, n in zip(ends, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())],
                names=["place", "doc_id", "n_tokens", "ids_crc32"],
            )

    rows = tokens.select("place", "doc_id", "ids").mapInArrow(digest, "place bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint")
    rows = rows.withColumn("part", F.shiftright("place", 33))  # the file's number, as place counts up in each file
    before = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    # one row per file: small enough for one sorted running sum
    parts = tokens.groupBy(F.shiftright("place", 33).alias("part")).agg(F.sum("n_tokens").alias("part_tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("part_tokens").over(earlier), F.lit(0)).alias("part_start"))
    return rows.join(starts, "part").select("doc_id", (F.col("part_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def op2_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_folder(spark, "tokens")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, spaces=True)
    return token_digests(read_tokens(spark, path))
