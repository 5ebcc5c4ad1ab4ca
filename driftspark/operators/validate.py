"""Validation of documentation updates (V1-V3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftspark.functions import patterns as P
from driftspark.functions.markdown import headers, is_valid_fence, raw_fences
from driftspark.functions.text import matches, texts_where, trim_all


def _text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def content_errors(updated: Column, fences: Column | None = None) -> Column:
    """Errors of an updated text: empty, or a fence that is not well formed."""
    empty = F.when(trim_all(_text(updated)) == "", F.lit("Updated content is empty"))
    blocks = raw_fences(_text(updated)) if fences is None else fences
    malformed = F.transform(
        F.filter(blocks, lambda block: ~is_valid_fence(block)),
        lambda block: F.concat(
            F.lit("Code block has malformed markdown: "), F.left(block, F.lit(50)), F.lit("...")
        ),
    )
    return F.concat(texts_where([(empty.isNotNull(), empty)]), malformed)


def _features(name: str, text: Column) -> Column:
    """What the warnings compare, found once per text."""
    return F.struct(
        raw_fences(text).alias("fences"),
        (F.size(headers(text)) > 0).alias("headers"),
        matches(text, P.LIST_ITEM).alias("items"),
    ).alias(name)


def _warnings(same: Column, old: Column, new: Column) -> Column:
    old_blocks, new_blocks = F.size(old["fences"]), F.size(new["fences"])
    fewer = F.concat(
        F.lit("Number of code blocks decreased from "),
        old_blocks.cast("string"),
        F.lit(" to "),
        new_blocks.cast("string"),
    )
    return texts_where(
        [
            (same, "Updated content is identical to original"),
            (old["headers"] & ~new["headers"], "All markdown headers were removed"),
            (old["items"] & ~new["items"], "List formatting may have been removed"),
            ((old_blocks > 0) & (new_blocks == 0), "All code examples were removed"),
            ((new_blocks > 0) & (old_blocks > new_blocks + 1), fewer),
        ]
    )


def validate_updates(updates: DataFrame) -> DataFrame:
    """Adds ``is_valid``, ``errors`` and ``warnings``; nothing is shuffled."""
    original, updated = F.col("original_content"), F.col("updated_content")
    found = updates.select(
        "*", _features("_old", _text(original)), _features("_new", _text(updated))
    )
    return (
        found.withColumn("errors", content_errors(updated, F.col("_new.fences")))
        .withColumn(
            "warnings", _warnings(updated.eqNullSafe(original), F.col("_old"), F.col("_new"))
        )
        .withColumn("is_valid", F.size("errors") == 0)
        .drop("_old", "_new")
    )
