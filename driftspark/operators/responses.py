"""Recorded answers: parsing, choice of the first valid one, new documents
(H9, H10, E4, P1, V4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftspark.functions.patterns import SPACE
from driftspark.functions.text import trim_all
from driftspark.operators.lines import change_hunks
from driftspark.operators.validate import content_errors

KEYS = ("repo", "path")

# Fixed values.
UNSTRUCTURED = "Parsed from unstructured response"
NO_REASON = "No reasoning provided"


def _fence_body(tag: str) -> str:
    return rf"```{tag}{SPACE}*([\s\S]*?){SPACE}*```"


def _strict_json(text: Column) -> Column:
    """Variant of a text that is one JSON value and nothing else, else null.

    The parser ignores what follows a value, so the text is closed off by a
    marker that must come out as the second and last element.
    """
    mark = "-end-"
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{mark}"]')))
    whole = (F.try_variant_get(listed, "$[1]", "string") == mark) & F.try_variant_get(
        listed, "$[2]", "variant"
    ).isNull()
    return F.when(whole, F.try_variant_get(listed, "$[0]", "variant"))


def parse_update_answers(answers: DataFrame, response: str = "response") -> DataFrame:
    """Adds ``updated_content``, ``reasoning`` and ``is_structured``.

    JSON in a json fence, else the whole text as JSON, with a non-empty text
    ``updatedContent``. Anything else is taken as the content itself: the body
    of a markdown fence or the whole text. A code fence inside fenced JSON cuts
    it short, so such an answer is unstructured too.
    """
    text = F.col(response)
    fenced = text.rlike(_fence_body("json"))
    body = F.when(fenced, F.regexp_extract(text, _fence_body("json"), 1)).otherwise(text)
    json = _strict_json(body)
    content = F.try_variant_get(json, "$.updatedContent", "variant")
    is_text = F.schema_of_variant(content) == "STRING"
    parsed = answers.withColumn(
        "_new", F.when(is_text, F.try_variant_get(content, "$", "string"))
    ).withColumn("_why", F.try_variant_get(json, "$.reasoning", "string"))
    structured = F.coalesce(F.length("_new") > 0, F.lit(False))
    markdown = _fence_body("markdown")
    plain = F.when(text.rlike(markdown), F.regexp_extract(text, markdown, 1)).otherwise(text)
    why = F.when(F.length("_why") > 0, F.col("_why")).otherwise(NO_REASON)
    return (
        parsed.withColumn("is_structured", structured)
        .withColumn(
            "updated_content",
            F.when(F.col("is_structured"), F.col("_new")).otherwise(trim_all(plain)),
        )
        .withColumn("reasoning", F.when(F.col("is_structured"), why).otherwise(UNSTRUCTURED))
        .drop("_new", "_why")
    )


def attach_changes(
    updates: DataFrame, originals: DataFrame, keys: Sequence[str] = (*KEYS, "attempt")
) -> DataFrame:
    """Parsed updates with ``changes``: the changed sections against the original text, in order.

    ``originals`` has ``keys`` and ``original_content``. The list is bounded by the
    two texts of its update; it is empty where they are equal.
    """
    pairs = updates.select(*keys, "updated_content").join(originals, list(keys))
    section = F.struct("seq", "type", "start_line", "end_line", "old_content", "new_content")
    found = change_hunks(pairs, keys).groupBy(*keys).agg(
        F.array_sort(F.collect_list(section)).alias("changes")
    )
    listed = F.transform(F.coalesce("changes", F.expr("array()")), lambda c: c.dropFields("seq"))
    return updates.join(found, list(keys), "left").withColumn("changes", listed)


def new_doc_text(response: Column) -> Column:
    """Text of a new document: markdown fence, else any fence, else everything.

    The language tag of another fence stays in the text.
    """
    markdown, any_fence = _fence_body("markdown"), _fence_body("")
    body = (
        F.when(response.rlike(markdown), F.regexp_extract(response, markdown, 1))
        .when(response.rlike(any_fence), F.regexp_extract(response, any_fence, 1))
        .otherwise(response)
    )
    return trim_all(body)


def parse_new_doc_answers(answers: DataFrame, response: str = "response") -> DataFrame:
    return answers.withColumn("updated_content", new_doc_text(F.col(response)))


def judged_answers(answers: DataFrame, validated: bool = True) -> DataFrame:
    """Answers with ``problem``: the call's error or the validation errors."""
    invalid = F.lit(None).cast("string")
    if validated:
        found = content_errors(F.col("updated_content"))
        invalid = F.when(
            F.size(found) > 0, F.concat(F.lit("Validation failed: "), F.array_join(found, ", "))
        )
    return answers.withColumn("problem", F.coalesce(F.col("error"), invalid))


def first_valid(
    answers: DataFrame,
    limit: int = 3,
    keys: Sequence[str] = KEYS,
    what: str = "update",
    validated: bool = True,
) -> DataFrame:
    """One row per key: the first valid of the first ``limit`` attempts.

    Without one the row has ``failure`` set, with the last attempt's problem. One
    aggregation combines attempts on the map side, so a key with any number of
    attempts is fine. For new documents pass ``validated=False``: every answer
    without a call error counts.
    """
    tried = judged_answers(answers.filter(F.col("attempt") <= limit), validated)
    good = F.col("problem").isNull()
    carried = [c for c in ("attempt", "updated_content", "reasoning") if c in answers.columns]
    picked = F.struct(*carried)
    grouped = tried.groupBy(*keys).agg(
        F.min_by(F.when(good, picked), F.when(good, F.col("attempt"))).alias("chosen"),
        F.max_by("problem", "attempt").alias("last_problem"),
    )
    failure = F.format_string(
        f"Failed to generate {what} after {limit} attempts: %s", F.col("last_problem")
    )
    return grouped.select(
        *keys, "chosen.*", F.when(F.col("chosen").isNull(), failure).alias("failure")
    )


def split_failures(rows: DataFrame, stage: str, keys: Sequence[str] = KEYS) -> tuple[DataFrame, DataFrame]:
    """Good rows, and error rows (keys, stage, message); one bad row stops nothing."""
    good = rows.filter(F.col("failure").isNull()).drop("failure")
    bad = rows.filter(F.col("failure").isNotNull())
    what = F.concat(F.lit(f"Failed to {stage} for "), "path", F.lit(": "), "failure")
    return good, bad.select(*keys, F.lit(stage).alias("stage"), what.alias("message"))


def new_doc_path(name: Column, doc_globs: Sequence[str]) -> Column:
    """Path of a new document: first documentation glob's directory and the name."""
    base = F.regexp_replace(F.lit(doc_globs[0]), r"/?\*\*/?\*\.\w+\z", "")
    joined = F.regexp_replace(F.concat(base, F.lit("/"), F.lower(name), F.lit(".md")), "/+", "/")
    return F.when(base == "", F.concat(F.lower(name), F.lit(".md"))).otherwise(
        F.regexp_replace(joined, r"^(\./)+", "")
    )


def new_doc_updates(
    missing: DataFrame,
    texts: DataFrame,
    doc_globs: Sequence[str],
    scope: Sequence[str] = ("repo",),
) -> DataFrame:
    """Update rows that create documents for undocumented APIs.

    ``texts`` has one ``updated_content`` per ``scope`` and API ``name``.
    """
    rows = missing.join(texts.select(*scope, "name", "updated_content"), [*scope, "name"])
    return rows.select(
        *scope,
        new_doc_path(F.col("name"), doc_globs).alias("path"),
        F.lit("").alias("original_content"),
        "updated_content",
        F.concat(
            F.lit("Generated new documentation for undocumented API: "), F.col("name")
        ).alias("reasoning"),
    )
