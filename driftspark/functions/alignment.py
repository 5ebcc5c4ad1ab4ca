"""Order-preserving comparison of two line lists, one document pair at a time.

An alignment carries state from line to line, which built-in expressions cannot
do in linear memory; Spark partitions the pairs and these helpers see one pair.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Workers get these functions by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def line_tokens(text: str) -> list[str]:
    """Lines with their line end; a last line without one is its own token."""
    tokens = text.split("\n")
    return [t + "\n" for t in tokens[:-1]] + ([tokens[-1]] if tokens[-1] else [])


def _last_row(a: list[int], b: list[int]) -> np.ndarray:
    """For each j the length of a longest common run of ``a`` and ``b[:j]``.

    One row of the table of lengths is one integer with a bit per line of ``b`` (Hyyro 2004): a line of ``a``
    costs a few operations on it, however often both sides repeat a line.
    """
    places: dict[int, int] = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << j
    whole = (1 << len(b)) - 1
    row = whole
    for line in a:
        hits = row & places.get(line, 0)
        row = (row + hits | row - hits) & whole
    steps = np.unpackbits(np.frombuffer((row ^ whole).to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.concatenate(([0], np.cumsum(steps[: len(b)], dtype=np.int64)))


def kept_pairs(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Positions of a longest common run of lines, in linear space (Hirschberg 1975).

    Equal ends are set aside. Half of what is left of ``a`` goes with that part of ``b`` where both
    halves keep most lines, and so on with the halves.
    """
    number: dict[str, int] = {}
    left, right = ([number.setdefault(line, len(number)) for line in lines] for lines in (a, b))
    found: list[tuple[int, int]] = []
    waiting = [(0, len(left), 0, len(right))]
    while waiting:
        i, i_end, j, j_end = waiting.pop()
        while i < i_end and j < j_end and left[i] == right[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and left[i_end - 1] == right[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            found.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        if i_end - i == 1:
            if left[i] in right[j:j_end]:
                found.append((i, right.index(left[i], j)))
            continue
        half = (i + i_end) // 2
        above = _last_row(left[i:half], right[j:j_end])
        below = _last_row(left[half:i_end][::-1], right[j:j_end][::-1])[::-1]
        cut = j + int((above + below).argmax())
        waiting += [(i, half, j, cut), (half, i_end, cut, j_end)]
    return sorted(found)


def shortest_edits(old: list[str], new: list[str]) -> list[tuple[str, str]]:
    """Minimal edit script; in each changed section removed lines come first."""
    script = []
    i = j = 0
    for next_i, next_j in [*kept_pairs(old, new), (len(old), len(new))]:
        script += [("-", line) for line in old[i:next_i]] + [("+", line) for line in new[j:next_j]]
        script += [("=", line) for line in old[next_i : next_i + 1]]
        i, j = next_i + 1, next_j + 1
    return script


def changed_sections(old: list[str], new: list[str]) -> list[tuple[int, list[str], list[str]]]:
    """Runs between kept lines as (1-based old line, old lines, new lines)."""
    sections = []
    i = j = 0
    for next_i, next_j in [*kept_pairs(old, new), (len(old), len(new))]:
        if i < next_i or j < next_j:
            sections.append((i + 1, old[i:next_i], new[j:next_j]))
        i, j = next_i + 1, next_j + 1
    return sections


_DELTA = T.ArrayType(
    T.StructType([T.StructField("op", T.StringType()), T.StructField("line", T.StringType())])
)
_SECTIONS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start_line", T.IntegerType()),
            T.StructField("old_lines", T.ArrayType(T.StringType())),
            T.StructField("new_lines", T.ArrayType(T.StringType())),
        ]
    )
)


@F.pandas_udf(_DELTA)
def line_edits(old: pd.Series, new: pd.Series) -> pd.Series:
    return pd.Series(
        [
            [
                {"op": op, "line": line.removesuffix("\n")}
                for op, line in shortest_edits(line_tokens(a or ""), line_tokens(b or ""))
            ]
            for a, b in zip(old, new)
        ]
    )


@F.pandas_udf(_SECTIONS)
def line_sections(old: pd.Series, new: pd.Series) -> pd.Series:
    return pd.Series(
        [
            [
                {"start_line": start, "old_lines": gone, "new_lines": fresh}
                for start, gone, fresh in changed_sections(
                    (a or "").split("\n"), (b or "").split("\n")
                )
            ]
            for a, b in zip(old, new)
        ]
    )
