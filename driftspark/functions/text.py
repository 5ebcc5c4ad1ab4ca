"""Text helpers: trimming, line handling, word matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftspark.functions import patterns as P


def trim_all(text: Column) -> Column:
    """Trim every kind of whitespace (``F.trim`` only removes blanks)."""
    return F.regexp_replace(text, rf"^{P.SPACE}+|{P.SPACE}+\z", "")


def lines_of(text: Column) -> Column:
    """Lines of a text; trailing empty lines are kept."""
    return F.split(text, "\n", -1)


def newline_count(text: Column) -> Column:
    return F.size(F.split(text, "\n", -1)) - 1


def matches(text: Column, pattern: str, needs: str = "") -> Column:
    """Pattern test, false for null.

    ``needs`` is a literal that every match contains: looking for it first spares
    most texts the regular expression.
    """
    found = text.contains(needs) & text.rlike(pattern) if needs else text.rlike(pattern)
    return F.coalesce(found, F.lit(False))


def tokens_of(text: Column) -> Column:
    """Distinct search tokens of a text (see ``patterns.TOKEN``)."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(P.TOKEN), F.lit(0)))


def name_key(name: Column) -> Column:
    """The token any text naming ``name`` must contain: the equi-join key.

    A name made of word characters is its own key. Other names use their first
    word run or, when they have none, their first character.
    """
    run = F.regexp_extract(name, rf"[{P.WORD}]+", 0)
    return F.when(run != "", run).otherwise(F.left(name, F.lit(1)))


def is_plain_name(name: Column) -> Column:
    """True when token equality alone proves a whole-word match."""
    return name.rlike(rf"^[{P.WORD}]+$")


def names_whole_word(text: Column, name: Column) -> Column:
    """Whole-word containment; borders are only demanded at word-character ends."""
    pattern = F.concat(
        F.when(name.rlike(rf"^[{P.WORD}]"), F.lit(P.WORD_START)).otherwise(F.lit("")),
        F.lit(r"\Q"),
        name,
        F.lit(r"\E"),
        F.when(name.rlike(rf"[{P.WORD}]\z"), F.lit(P.WORD_END)).otherwise(F.lit("")),
    )
    return F.regexp_like(text, pattern)


def texts_where(cases: list[tuple[Column, str | Column]]) -> Column:
    """Array of the texts whose condition holds, in the given order."""
    picked = F.array(
        *[F.when(cond, text if isinstance(text, Column) else F.lit(text)) for cond, text in cases]
    )
    return F.filter(picked, lambda item: item.isNotNull())


SPAN_TYPE = "array<struct<text:string,pos:int>>"
CUT = "\ufdd0"  # a noncharacter: never part of interchanged text


def gaps(text: Column, pattern: str) -> Column:
    """The text between the matches of a pattern.

    Matches are replaced by one character to split on: a replace keeps its
    compiled pattern from row to row, a split by pattern compiles it every time.
    """
    return F.split(F.regexp_replace(text, pattern, CUT), CUT, -1)


def raw(pattern: str) -> str:
    """A regular expression as an SQL literal."""
    return "r'" + pattern.replace("'", r"\x27") + "'"


def spans(text: str, pattern: str) -> str:
    """SQL of the matches of a pattern in an SQL text, with their 0-based character positions.

    Positions are a running sum over the matches and the gaps between them. As the extraction
    nests many of these, they are SQL text: one call to the JVM parses a whole column.
    """
    return f"""aggregate(
      filter(
        zip_with(
          split(regexp_replace({text}, {raw(pattern)}, '{CUT}'), '{CUT}', -1),
          regexp_extract_all({text}, {raw(pattern)}, 0),
          (gap, hit) -> struct(gap, hit)),
        both -> both.hit IS NOT NULL),
      struct(0 AS pos, CAST(array() AS {SPAN_TYPE}) AS found),
      (so_far, both) -> struct(
        so_far.pos + length(both.gap) + length(both.hit) AS pos,
        array_append(so_far.found, struct(both.hit AS text, so_far.pos + length(both.gap) AS pos)) AS found),
      so_far -> so_far.found)"""
