"""Exact dedup by deterministic block naming, with DataFrame functions only.

A normalised text is cut into blocks of fixed size. Equal blocks get one name and
different blocks get different names; then adjacent pairs of names are named the same
way, again and again, until each document has one name. Two documents have the same
(level, name) exactly when their texts are equal.

A name is two integers: the 64-bit hash of the block, and its place among the sorted
different blocks with that hash. So each bucket is sorted on its own and no name needs
a global order. Nearly all buckets hold one block; those with more are kept in a table,
and a block takes its place from there. Names are never trusted to the hash alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftspark.llm.common import free_name, stored

BLANKS = r"[\x20\x09-\x0D]+"
BLOCK_CHARS = 4096


def _crowded(blocks: DataFrame, *value: str) -> DataFrame:
    """The different values that share a hash with others, with their places from 0 on."""
    several = (
        blocks.groupBy("hash")
        .agg(F.array_sort(F.collect_set(F.struct(*value))).alias("values"))
        .where(F.size("values") > 1)
    )
    exploded = several.select("hash", F.posexplode("values").alias("place", "value"))
    return stored(exploded.select("hash", *[F.col(f"value.{v}").alias(v) for v in value], F.col("place").cast("int")), "names")


def _named(blocks: DataFrame, crowded: DataFrame, *value: str) -> DataFrame:
    """Blocks with their places; the compared values go."""
    known = crowded.select("hash", "place", *[F.col(v).alias(f"known_{v}") for v in value])
    same = [blocks["hash"] == known["hash"], *[blocks[v].eqNullSafe(known[f"known_{v}"]) for v in value]]
    joined = blocks.join(known, same, "left").drop(known["hash"], *[f"known_{v}" for v in value], *value)
    return joined.withColumn("place", F.coalesce("place", F.lit(0)))


def normalised(text: Column) -> Column:
    """The text without blanks; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def named_documents(docs: DataFrame, keep: list[str], text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs`` with its identity: the columns ``keep`` (any names),
    ``n_points`` (code points of the original text), ``text_sha256`` (of the normalised
    text), and (``level``, ``hash``, ``place``), equal exactly for equal normalised texts.
    Null texts are empty; empty texts are equal to each other; repeated rows stay rows.
    """
    spark = docs.sparkSession
    kept = F.struct(*[F.col(f"`{c}`").alias(c) for c in keep])
    blocks_of = F.regexp_extract_all("normal", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    cut = docs.select(kept.alias("kept"), F.col(f"`{text}`").alias("text")).withColumn("normal", normalised(F.col("text")))
    blocks = F.when(F.col("normal") == "", F.array(F.lit(""))).otherwise(blocks_of)
    contents = cut.select(F.explode(blocks).alias("content")).select(F.xxhash64("content").alias("hash"), "content")
    crowded = _crowded(contents, "content")
    rows = cut.select(
        F.monotonically_increasing_id().alias("row"),
        "kept",
        F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("n_points"),
        F.sha2("normal", 256).alias("text_sha256"),
        blocks.alias("blocks"),
    ).select("row", "kept", "n_points", "text_sha256", F.size("blocks").alias("n"), F.posexplode("blocks").alias("at", "content"))
    first = F.col("at") == 0  # what belongs to the document stands at its first block only
    rows = rows.select(
        "row", "n", "at", "content", F.xxhash64("content").alias("hash"),
        *[F.when(first, F.col(c)).alias(c) for c in ("kept", "n_points", "text_sha256")],
    )
    level = stored(_named(rows, crowded, "content"), "blocks")
    heads = level.where("at = 0").select("row", "kept", "n_points", "text_sha256")
    parts = level.select("row", "n", "at", "hash", "place")
    whole, names, depth = [], parts, 0
    longest = parts.agg(F.max("n")).first()[0] or 1
    while True:
        whole.append(names.where("n = 1").select("row", F.lit(depth).alias("level"), "hash", "place"))
        if longest == 1:
            break
        depth, longest = depth + 1, (longest + 1) // 2
        side = F.col("at") % 2
        pairs = (
            names.where("n > 1")
            .groupBy("row", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.floor(F.col("at") / 2).cast("int").alias("at"))
            .agg(*[F.max(F.when(side == s, F.col(c))).alias(f"{c}{s}") for s in (0, 1) for c in ("hash", "place")])
        )
        value = ("hash0", "place0", "hash1", "place1")
        pairs = stored(pairs.withColumn("hash", F.xxhash64(*value)), "pairs")
        names = stored(_named(pairs, _crowded(pairs, *value), *value), "names")
    identity = whole[0]
    for more in whole[1:]:
        identity = identity.unionByName(more)
    return heads.join(identity, "row").select("kept.*", "n_points", "text_sha256", "level", "hash", "place")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, keep_id, group_size, kept, text_sha256, n_points).

    Of equal texts the row with the most code points, then the smallest id (null last)
    stays. Of repeated rows with one id all carry the same ``kept``. Other columns are
    left out, so their names cannot clash.
    """
    name = ["level", "hash", "place"]
    rows = named_documents(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), ["doc_id"])
    order = F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id"))
    rows = stored(rows, "identities")
    # stored, so that a hot group of the join below can be split
    best = rows.groupBy(*name).agg(F.min_by(F.col("doc_id"), order).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    best = stored(best, "best")
    return rows.join(best, name).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "n_points"
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns. Rows that repeat an id together
    with an equal text are one document, of which any one row stays."""
    kept = stored(exact_groups(docs, doc_id, text).where("kept").groupBy("doc_id", "text_sha256").count(), "kept")
    sha, times = free_name(docs, "text_sha256"), free_name(docs, "times")
    known = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"), F.col("count").alias(times))
    marked = docs.withColumn(sha, F.sha2(normalised(F.col(f"`{text}`")), 256))
    joined = marked.join(known, marked[doc_id].eqNullSafe(known["kept_id"]) & (marked[sha] == known["kept_sha"]))
    out = joined.where(F.col(times) == 1)
    if not kept.where("count > 1").isEmpty():
        out = out.unionByName(joined.where(F.col(times) > 1).dropDuplicates([doc_id, sha]))
    return out.select(*[marked[c] for c in docs.columns])


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_groups(docs).drop("n_points")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT norm, arg_min(doc_id, (-n, doc_id)) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM d JOIN g USING (norm)
"""
