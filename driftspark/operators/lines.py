"""Line deltas and changed sections of document pairs (L1, L2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftspark.functions.alignment import line_edits, line_sections

KEYS = ("repo", "path")


def line_delta(
    pairs: DataFrame,
    keys: Sequence[str] = KEYS,
    old: str = "original_content",
    new: str = "updated_content",
) -> DataFrame:
    """Ordered lines of an update: ``+`` added, ``-`` removed, ``=`` kept.

    A last line without a line end differs from the same line with one.
    """
    edits = pairs.select(*keys, F.posexplode(line_edits(F.col(old), F.col(new))).alias("seq", "e"))
    return edits.select(*keys, "seq", F.col("e.op").alias("op"), F.col("e.line").alias("line"))


def section_type(old_text: Column, new_text: Column, n_old: Column) -> Column:
    """Kind of a changed section from its text."""

    def either(mark: str) -> Column:
        return old_text.contains(mark) | new_text.contains(mark)

    return (
        F.when(either("```"), "example")
        .when(either("(") & either(")"), "signature")
        .when(n_old == 0, "addition")
        .otherwise("description")
    )


def change_hunks(
    pairs: DataFrame,
    keys: Sequence[str] = KEYS,
    old: str = "original_content",
    new: str = "updated_content",
) -> DataFrame:
    """Changed sections of each pair; identical pairs are dropped up front."""
    changed = pairs.filter(~F.col(old).eqNullSafe(F.col(new)))
    sections = changed.select(
        *keys, F.posexplode(line_sections(F.col(old), F.col(new))).alias("seq", "s")
    )
    old_text = F.array_join("s.old_lines", "\n")
    new_text = F.array_join("s.new_lines", "\n")
    n_old, n_new = F.size("s.old_lines"), F.size("s.new_lines")
    return sections.select(
        *keys,
        "seq",
        section_type(old_text, new_text, n_old).alias("type"),
        F.col("s.start_line").alias("start_line"),
        (F.col("s.start_line") - 1 + F.greatest(n_old, n_new)).alias("end_line"),
        old_text.alias("old_content"),
        new_text.alias("new_content"),
    )
