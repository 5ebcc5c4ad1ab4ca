import json

import pytest

from driftspark.operators import responses
from driftspark.schemas import ANSWERS

DOC = "# New\nwith \"quotes\""
FENCED_JSON = "```json\n" + json.dumps({"updatedContent": DOC, "reasoning": "why"}) + "\n```"
UNSTRUCTURED = "Parsed from unstructured response"
CASES = {
    json.dumps({"updatedContent": DOC}): (DOC, "No reasoning provided"),
    "Here it is:\n" + FENCED_JSON + "\nDone": (DOC, "why"),
    "```markdown\n# Doc\n```": ("# Doc", UNSTRUCTURED),
    "  plain text  \n": ("plain text", UNSTRUCTURED),
    '{"updatedContent": ""}': ('{"updatedContent": ""}', UNSTRUCTURED),
    '{"updatedContent": 5}': ('{"updatedContent": 5}', UNSTRUCTURED),
    '{"updatedContent": "a"} trailing': ('{"updatedContent": "a"} trailing', UNSTRUCTURED),
    '{"updatedContent": "a"}, {"b": 1}': ('{"updatedContent": "a"}, {"b": 1}', UNSTRUCTURED),
    '{"updatedContent": "a"}] x': ('{"updatedContent": "a"}] x', UNSTRUCTURED),
    '[1]': ("[1]", UNSTRUCTURED),
    "null": ("null", UNSTRUCTURED),
    "": ("", UNSTRUCTURED),
    # A fence inside the fenced JSON cuts it short.
    '```json\n{"updatedContent": "```js x```"}\n```': (
        '```json\n{"updatedContent": "```js x```"}\n```', UNSTRUCTURED),
}


def test_update_answers(spark):
    rows = [("r", str(i), 1, text, None) for i, text in enumerate(CASES)]
    parsed = responses.parse_update_answers(spark.createDataFrame(rows, ANSWERS)).collect()
    for row in parsed:
        assert (row.updated_content, row.reasoning) == CASES[row.response], row.response
        assert row.is_structured == (row.reasoning != UNSTRUCTURED)


def test_new_doc_answers(spark):
    cases = {
        "Sure:\n```markdown\n# A\n\ntext\n```": "# A\n\ntext",
        "```\n# B\n```": "# B",
        "```js\ncode\n```": "js\ncode",
        "\n # C \n": "# C",
    }
    rows = [("r", str(i), 1, text, None) for i, text in enumerate(cases)]
    parsed = responses.parse_new_doc_answers(spark.createDataFrame(rows, ANSWERS)).collect()
    assert {r.response: r.updated_content for r in parsed} == cases


def test_first_valid(spark):
    rows = [
        ("r", "third", 1, None, "e1"), ("r", "third", 2, None, "e2"), ("r", "third", 3, "# ok", None),
        ("r", "late", 4, "# ok", None), ("r", "late", 1, None, "timeout"),
        ("r", "late", 2, "   ", None), ("r", "late", 3, "```x```", None),
        ("r", "two", 2, "b", None), ("r", "two", 1, "a", None),
    ]
    parsed = responses.parse_update_answers(spark.createDataFrame(rows, ANSWERS))
    found = {r.path: r for r in responses.first_valid(parsed, 3).collect()}
    assert found["third"].attempt == 3
    assert found["two"].updated_content == "a"
    assert found["late"].failure == (
        "Failed to generate update after 3 attempts: Validation failed: "
        "Code block has malformed markdown: ```x```..."
    )
    good, bad = responses.split_failures(responses.first_valid(parsed, 3), "generate update")
    assert sorted(r.path for r in good.collect()) == ["third", "two"]
    assert [r.path for r in bad.collect()] == ["late"]


def test_new_docs_are_not_validated(spark):
    rows = [("r", "a", 1, None, "e"), ("r", "a", 2, "```x```", None)]
    parsed = responses.parse_new_doc_answers(spark.createDataFrame(rows, ANSWERS))
    row = responses.first_valid(parsed, 3, what="new documentation", validated=False).collect()[0]
    assert (row.attempt, row.updated_content, row.failure) == (2, "x", None)


@pytest.mark.parametrize(
    "glob, path",
    [("docs/**/*.md", "docs/mkuser.md"), ("docs/api/**/*.mdx", "docs/api/mkuser.md"),
     ("README.md", "README.md/mkuser.md"), ("**/*.md", "mkuser.md"), ("./docs/**/*.md", "docs/mkuser.md")],
)
def test_new_doc_path(spark, glob, path):
    from pyspark.sql import functions as F

    row = spark.range(1).select(responses.new_doc_path(F.lit("mkUser"), [glob, "x"]).alias("p"))
    assert row.collect()[0].p == path
