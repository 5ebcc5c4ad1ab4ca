import random
import time

import pytest
from pyspark.sql import functions as F

from driftspark.functions import alignment
from driftspark.functions.markdown import headers, is_valid_fence, raw_fences
from driftspark.operators import lines, style, validate
from driftspark.operators.references import code_blocks
from driftspark.schemas import FILES


def longest_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("seed", [1000, 1])
def test_edit_script_is_minimal(seed):
    rng = random.Random(seed)
    for _ in range(800):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(2))
        script = alignment.shortest_edits(a, b)
        assert [line for op, line in script if op != "+"] == a
        assert [line for op, line in script if op != "-"] == b
        assert sum(op == "=" for op, _ in script) == longest_common(a, b)


def test_many_repeated_lines_are_aligned_fast():
    rng = random.Random(5)
    a, b = (["" if rng.random() < 0.5 else f"line {rng.randrange(40_000)}" for _ in range(20_000)] for _ in range(2))
    started = time.process_time()
    pairs = alignment.kept_pairs(a, b)
    assert time.process_time() - started < 5  # about 0.7 s
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def test_sections_rebuild_the_new_text():
    rng = random.Random(3)
    for _ in range(500):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randint(1, 12))] for _ in range(2))
        rebuilt, at, gone = [], 0, 0
        for start, old, new in alignment.changed_sections(a, b):
            rebuilt += a[at : start - 1] + new
            assert a[start - 1 : start - 1 + len(old)] == old
            at = start - 1 + len(old)
        assert rebuilt + a[at:] == b, (a, b)


def test_sections_have_no_look_ahead():
    old = [f"line {i}" for i in range(40)]
    for n in (1, 9, 10, 50):
        fresh = [f"new {i}" for i in range(n)]
        assert alignment.changed_sections(old, old[:7] + fresh + old[7:]) == [(8, [], fresh)]
    assert alignment.changed_sections(old, old[:5] + old[20:25] + old[5:20] + old[25:]) == [
        (6, [], old[20:25]), (21, old[20:25], []),
    ]


def test_shuffled_lines_stay_fast():
    rng = random.Random(5)
    old = [str(i) for i in range(20000)]
    new = rng.sample(old, len(old))
    script = alignment.shortest_edits(old, new)
    assert [line for op, line in script if op != "-"] == new


def pairs(spark, rows):
    return spark.createDataFrame(
        [("r", str(i), a, b) for i, (a, b) in enumerate(rows)],
        "repo string, path string, original_content string, updated_content string",
    )


def test_line_delta(spark):
    rows = lines.line_delta(pairs(spark, [("a\nb\nc", "a\nx\nc"), ("a\n", "a\n"), ("a", "a\nb")]))
    got = {}
    for r in rows.orderBy("path", "seq").collect():
        got.setdefault(r.path, []).append(r.op + r.line)
    assert got == {"0": ["=a", "-b", "+x", "=c"], "1": ["=a"], "2": ["-a", "+a", "+b"]}


def test_hunks(spark):
    cases = [
        ("a\nb\nc", "a\nX\nY\nc"), ("a\nc", "a\nf(x)\nc"), ("a\n\nb", "a\n\nnew\n\nb"),
        ("a\nb", "a\n```\nq\n```\nb"), ("same", "same"), ("a\nb", "b\na"),
    ]
    rows = lines.change_hunks(pairs(spark, cases)).orderBy("path", "seq").collect()
    got = [(r.path, r.type, r.start_line, r.end_line, r.old_content, r.new_content) for r in rows]
    assert got[:4] == [
        ("0", "description", 2, 3, "b", "X\nY"),
        ("1", "signature", 2, 2, "", "f(x)"),
        ("2", "addition", 3, 4, "", "new\n"),
        ("3", "example", 2, 4, "", "```\nq\n```"),
    ]
    assert {r.path for r in rows} == {"0", "1", "2", "3", "5"}


def test_validation(spark):
    base = "# A\n\n- item\n\n```ts\nx\n```\n"
    cases = {
        "": ["Updated content is empty"],
        " \n ": ["Updated content is empty"],
        base: ["Updated content is identical to original"],
        "plain": ["All markdown headers were removed", "List formatting may have been removed",
                  "All code examples were removed"],
        "# A\n- b\n```ts\ny\n```\nmore": [],
        "# A\n- b\n```x```": ["Code block has malformed markdown: ```x```..."],
    }
    got = validate.validate_updates(pairs(spark, [(base, new) for new in cases])).collect()
    for row in got:
        expected = cases[row.updated_content]
        found = row.errors + row.warnings
        assert set(expected) <= set(found)
        assert row.is_valid == (not row.errors)
        if not row.updated_content.strip():
            assert not row.is_valid
        if not expected:
            assert found == []


def test_dropped_blocks_warning(spark):
    block = "```\nx\n```\n"
    rows = validate.validate_updates(pairs(spark, [(block * 3, block), (block * 2, block)]))
    warnings = {r.path: r.warnings for r in rows.collect()}
    assert warnings == {"0": ["Number of code blocks decreased from 3 to 1"], "1": []}


def test_markdown_features(spark):
    df = spark.createDataFrame([("# A\n####### no\n ## no\n## B c\n```a``` b\n```\nx\n  ```\n",)], "t string")
    row = df.select(headers(F.col("t")).alias("h"), raw_fences(F.col("t")).alias("f")).collect()[0]
    assert row.h == ["# A", "## B c"]
    assert row.f == ["```a```", "```\nx\n  ```"]
    valid = df.select(F.transform(raw_fences(F.col("t")), is_valid_fence)).collect()[0][0]
    assert valid == [False, True]


STYLE = {
    "you": ("You can use this", "Direct"), "we": ("We recommend it", "Collaborative"),
    "plain": ("It is so. The bus stops; status.", "Formal"),
    "verb": ("text\nuseful thing", "Direct"), "word": ("youth and weus", "Formal"),
}


def test_tone(spark):
    docs = spark.createDataFrame([(k, "a.md", t) for k, (t, _) in STYLE.items()], FILES)
    rows = {r.repo: r.tone.split(" ")[0] for r in style.tone(docs).collect()}
    assert rows == {k: tone for k, (_, tone) in STYLE.items()}


def test_style_guide_and_default(spark):
    text = "# T\n* item\n1. one\n**bold** `code`\n@param x\nParameters:\nReturns: {User}\nexample:\n```ts\nimport a\n// note\nfunction f() {}\n```\n"
    docs = spark.createDataFrame([("full", "a.md", text), ("full", "b.md", "x"), ("bare", "c.md", "x")], FILES)
    repos = spark.createDataFrame([("full",), ("bare",), ("none",)], "repo string")
    rows = {r.repo: r for r in style.style_guide(docs, code_blocks(docs), repos).collect()}
    assert len(rows["full"].formatting.split("; ")) == 6
    assert len(rows["full"].conventions) == 5
    assert rows["full"].example_patterns == [
        "Examples include explanatory comments", "Examples show import statements",
        "Examples demonstrate complete function implementations",
    ]
    assert rows["bare"].formatting == "Standard markdown formatting"
    assert rows["bare"].example_patterns == ["No code examples found"]
    assert rows["none"].example_patterns == ["Usage snippets with inline comments"]
    assert rows["none"].tone.startswith("Direct")


@pytest.mark.parametrize(
    "globs, language",
    [(["src/**/*.ts"], "TypeScript"), (["a/*.js"], "JavaScript"), (["a.py"], "Python"),
     (["a.rs", "b.java"], "Java"), ([], "Unknown")],
)
def test_project_language(spark, globs, language):
    guide = spark.createDataFrame([("r",)], "repo string")
    row = style.build_context(guide, globs, custom_guidelines="Active voice").collect()[0]
    assert (row.language, row.custom_guidelines) == (language, "Active voice")
