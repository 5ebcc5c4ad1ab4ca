"""Markdown features of a text column (H1-H4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftspark.functions import patterns as P
from driftspark.functions.text import gaps, newline_count, trim_all

BLOCK_TYPE = "array<struct<language:string,start_line:int,end_line:int,code:string>>"


def fenced_blocks(content: Column) -> Column:
    """Closed fenced blocks with language and 1-based line range of the body.

    The blocks and the text between them come from one pattern, so the line of
    a block is a running sum over both. An empty block ends before it starts.
    """
    blocks = F.regexp_extract_all(content, F.lit(P.FENCED_BLOCK), F.lit(0))
    sized = F.zip_with(
        gaps(content, P.FENCED_BLOCK),
        blocks,
        lambda gap, block: F.struct(
            newline_count(gap).alias("gap"),
            block.alias("block"),
            newline_count(block).alias("rows"),
            F.length(F.substring_index(block, "\n", 1)).alias("opener"),
        ),
    )

    def add(state: Column, item: Column) -> Column:
        opener = state["line"] + item["gap"]
        rows = item["rows"]
        # Without the opener line, its line end, and the closing line.
        size = F.length(item["block"]) - item["opener"] - 5
        entry = F.struct(
            F.regexp_extract(item["block"], r"^```(\w*)", 1).alias("language"),
            (opener + 1).alias("start_line"),
            (opener + rows - 1).alias("end_line"),
            F.when(size > 0, F.substring(item["block"], item["opener"] + 2, size))
            .otherwise("")
            .alias("code"),
        )
        return F.struct(
            (opener + rows).alias("line"),
            F.array_append(state["found"], entry).alias("found"),
        )

    start = F.struct(F.lit(1).alias("line"), F.array().cast(BLOCK_TYPE).alias("found"))
    # The text after the last block has no block of its own.
    with_block = F.filter(sized, lambda item: item["block"].isNotNull())
    return F.aggregate(with_block, start, add, lambda state: state["found"])


def raw_fences(content: Column) -> Column:
    """Every span between two triple backticks, also inside a line."""
    return F.regexp_extract_all(content, F.lit(P.RAW_FENCE), F.lit(0))


def headers(content: Column) -> Column:
    return F.regexp_extract_all(content, F.lit(P.HEADER), F.lit(0))


def is_valid_fence(block: Column) -> Column:
    """At least two lines, fence opener first, a bare closing fence last."""
    lines = F.split(block, "\n", -1)
    return (
        (F.size(lines) >= 2)
        & trim_all(F.get(lines, F.lit(0))).startswith("```")
        & (trim_all(F.element_at(lines, -1)) == "```")
    )
