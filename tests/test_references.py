import re

import pytest
from pyspark.sql import functions as F

from driftspark.operators import references as refs
from driftspark.operators.joins import salted_lookup
from driftspark.schemas import FILES

ORBIT = (
    "# Orbit tools\n\n## planOrbit\n\nA burn plan starts here.\n\n"
    "```python\nplan = planOrbit(7)\nprint(plan.burn, planOrbit)\n```\n\n"
    "Call planOrbit once per mission, then log the burn.\n\nplanOrbit never sleeps.\n"
)
TANKS = (
    "# Tank notes\n\nRefill with fillTank() before lift-off.\n\n"
    "```rust\nuse tanks::fillTank;\n\nlet burn = fillTank(\"lox\");\n```\n"
)
INDEX = "# Index\n\nSee planOrbit, and the glossary.\n"
FENCES = "```js\na\n```ts\nb\n```\n```\n```\n ```\nx ``` y\n```go\r\nz\n```\r\n```\nlast\n```\nopen\n"
WORDS = "entré a$http x$ $ naïve\nget_user get-user user2 USER user\n"
NAMES = [
    "planOrbit", "plan", "fillTank", "abortLaunch", "privateValve",
    "entr", "$http", "x$", "$", "naïve", "get", "burn", "é", "user",
]
FILES_HERE = {"orbit.md": ORBIT, "tanks.md": TANKS, "index.md": INDEX, "w.md": WORDS}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([("r", p, c) for p, c in FILES_HERE.items()], FILES).cache()


@pytest.fixture(scope="module")
def changed(spark):
    rows = [("r", "a.ts", n, i, 1, not n.startswith("private")) for i, n in enumerate(NAMES)]
    return spark.createDataFrame(
        rows, "repo string, path string, name string, ordinal int, kind_rank int, is_public boolean"
    )


@pytest.fixture(scope="module", params=["broadcast", "merge"])
def hits(request, docs, changed):
    names = refs.search_names(changed).hint(request.param)
    return refs.find_references(docs, names).cache(), refs.find_examples(docs, names).cache()


def brute_force(name):
    head = r"(?<![A-Za-z0-9_])" if re.match(r"[A-Za-z0-9_]", name) else ""
    tail = r"(?![A-Za-z0-9_])" if re.search(r"[A-Za-z0-9_]\Z", name) else ""
    found = set()
    for path, text in FILES_HERE.items():
        for i, line in enumerate(text.split("\n")):
            if re.search(head + re.escape(name) + tail, line):
                found.add((path, i + 1))
    return found


def test_every_whole_word_is_found(hits):
    rows = hits[0].collect()
    for name in NAMES:
        assert {(r.path, r.line_no) for r in rows if r.api_name == name} == brute_force(name), name
    assert len(rows) == sum(len(brute_force(n)) for n in NAMES)


def test_known_counts_and_context(hits):
    rows = [r for r in hits[0].collect() if r.api_name == "planOrbit"]
    assert sorted((r.path, r.line_no) for r in rows) == [
        ("index.md", 3), ("orbit.md", 3), ("orbit.md", 8), ("orbit.md", 9), ("orbit.md", 12), ("orbit.md", 14),
    ]
    context = {(r.path, r.line_no): r.context for r in rows}
    assert context["orbit.md", 3] == "\n## planOrbit\n"
    assert context["orbit.md", 8] == "```python\nplan = planOrbit(7)\nprint(plan.burn, planOrbit)"
    assert context["orbit.md", 14] == "\nplanOrbit never sleeps.\n"
    assert {r.reference_type for r in rows} == {"name"}


def test_examples(hits):
    rows = {(r.path, r.api_name): r for r in hits[1].collect()}
    assert set(rows) == {
        ("orbit.md", "planOrbit"), ("orbit.md", "plan"), ("orbit.md", "burn"),
        ("tanks.md", "fillTank"), ("tanks.md", "burn"),
    }
    found = rows["orbit.md", "planOrbit"]
    assert (found.language, found.start_line, found.end_line) == ("python", 8, 9)
    assert found.code == "plan = planOrbit(7)\nprint(plan.burn, planOrbit)"
    assert rows["tanks.md", "fillTank"].language == "rust"


def test_missing_docs_are_public_and_unnamed(hits, changed):
    missing = {r.name for r in refs.missing_docs(changed, *hits).collect()}
    assert missing == {n for n in NAMES if not brute_force(n)} - {"privateValve"}


def test_affected_documents(hits, docs):
    rows = {r.path: r for r in refs.affected_docs(docs, *hits).collect()}
    assert set(rows) == set(FILES_HERE)
    orbit = rows["orbit.md"]
    assert [(r.line_no, r.api_name) for r in orbit.references][:3] == [
        (3, "planOrbit"), (8, "planOrbit"), (9, "planOrbit"),
    ]
    assert orbit.examples[0].code == "plan = planOrbit(7)\nprint(plan.burn, planOrbit)"
    long = {(r.path, r.line_no, r.context) for r in hits[0].collect()}
    assert {(p, r.line_no, r.context) for p, row in rows.items() for r in row.references} == long
    counts = {r.path: (r.n_references, r.n_examples) for r in refs.document_hits(*hits).collect()}
    assert counts == {p: (len(r.references), len(r.examples)) for p, r in rows.items()}


def test_names_of_other_corpora_do_not_match(spark, docs, changed):
    other = spark.createDataFrame([("other", "x.md", "planOrbit")], FILES)
    assert refs.find_references(other, refs.search_names(changed)).count() == 0


def as_set(rows):
    return sorted(map(str, rows.collect()))


@pytest.mark.parametrize("find", [refs.find_references, refs.find_examples])
def test_a_short_list_goes_to_the_texts(spark, docs, changed, find, capsys):
    names = refs.search_names(changed)
    found = find(docs, names)
    found.explain()
    assert "collect_list" not in capsys.readouterr().out  # no grouping by document, no second reading of the text
    two = find(docs, names, two_phase=True)
    assert found.columns == two.columns and as_set(found) == as_set(two) and found.count() > 0


@pytest.mark.parametrize("find", [refs.find_references, refs.find_examples])
def test_repeated_and_missing_paths_are_found_in_two_phases(spark, changed, find):
    names = refs.search_names(changed)
    rows = [("r", "o.md", ORBIT), ("r", "o.md", TANKS), ("r", None, ORBIT), (None, "n.md", ORBIT), ("r", "e.md", None)]
    repeated = spark.createDataFrame(rows, FILES)
    assert not refs.goes_to_the_texts(repeated, names)
    assert as_set(find(repeated, names)) == as_set(find(repeated, names, two_phase=True))
    single = spark.createDataFrame(rows[1:], FILES)
    assert refs.goes_to_the_texts(single, names)
    assert as_set(find(single, names)) == as_set(find(single, names, two_phase=True))


@pytest.mark.parametrize("limit", ["LIST_ROWS", "LIST_BYTES"])
def test_a_long_list_does_not_go_to_the_texts(docs, changed, monkeypatch, limit):
    names = refs.search_names(changed)
    assert refs.goes_to_the_texts(docs, names)
    monkeypatch.setattr(refs, limit, 5)
    assert not refs.goes_to_the_texts(docs, names)


@pytest.mark.parametrize("two_phase", [False, True])
def test_written_examples_hold_each_code_about_once(spark, tmp_path, two_phase):
    body = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda i: F.sha2(F.concat_ws("-", "id", i), 256)))
    used = F.lit(" ".join(f"api{i}" for i in range(20)))
    content = F.concat(F.lit("```\n"), used, F.lit("\n"), body, F.lit("\n```"))
    texts = spark.range(0, 100, 1, 1).select(F.lit("r").alias("repo"), F.concat("id", F.lit(".md")).alias("path"), content.alias("content"))
    rows = [("r", "a.ts", f"api{i}", i, 1) for i in range(20)]
    names = refs.search_names(spark.createDataFrame(rows, "repo string, path string, name string, ordinal int, kind_rank int"))
    found = {parts: refs.find_examples(texts, names, two_phase=two_phase, small_parts=parts) for parts in (True, False)}
    size = {}
    for parts, rows in found.items():
        out = tmp_path / str(parts)
        rows.write.parquet(str(out))
        size[parts] = sum(f.stat().st_size for f in out.glob("*.parquet"))
        assert spark.read.parquet(str(out)).distinct().count() == 2000
    assert size[True] * 3 < size[False], size


def test_written_references_hold_each_context_about_once(spark, tmp_path):
    used = F.lit(" ".join(f"api{i}" for i in range(20)))
    line = lambda i: F.concat_ws(" ", used, *[F.sha2(F.concat_ws("-", "id", i, F.lit(k)), 256) for k in range(5)])
    content = F.concat_ws("\n", F.transform(F.sequence(F.lit(1), F.lit(100)), line))
    texts = spark.range(0, 100, 1, 1).select(F.concat(F.lit("r"), F.col("id") % 2).alias("repo"), F.concat("id", F.lit(".md")).alias("path"), content.alias("content"))
    rows = [(f"r{i % 2}", "a.ts", f"api{i // 2}", i, 1) for i in range(40)]
    names = refs.search_names(spark.createDataFrame(rows, "repo string, path string, name string, ordinal int, kind_rank int"))
    size = {}
    for parts in (True, False):
        found = refs.find_references(texts, names, two_phase=True, small_parts=parts)
        found.write.parquet(str(tmp_path / str(parts)))
        size[parts] = sum(f.stat().st_size for f in (tmp_path / str(parts)).glob("*.parquet"))
        assert spark.read.parquet(str(tmp_path / str(parts))).distinct().count() == 200_000
    assert size[True] * 1.3 < size[False], size


def test_hits_of_two_phases_come_in_the_order_of_the_text(spark):
    words = ["zeta", "alpha", "mid"]
    content = "\n".join(" ".join(words[: 1 + i % 3]) for i in range(30))
    texts = spark.createDataFrame([("r", "a.md", content), ("r", "b.md", content)], FILES)
    rows = [("r", "a.ts", n, i, 1) for i, n in enumerate(words)]
    names = refs.search_names(spark.createDataFrame(rows, "repo string, path string, name string, ordinal int, kind_rank int"))
    found = refs.find_references(texts, names.hint("merge"), two_phase=True).collect()
    for path in ("a.md", "b.md"):
        numbers = [r.line_no for r in found if r.path == path]
        assert len(numbers) == 60 and numbers == sorted(numbers)  # a line's rows, which share a context, are neighbours


def fences_by_hand(text):
    found, start, language = [], None, ""
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if start is None and line.startswith("```"):
            start, language = i, re.match(r"\w*", line[3:], re.ASCII).group()
        elif start is not None and line == "```":
            found.append((language, start + 2, i, "\n".join(lines[start + 1 : i])))
            start = None
    return found


def test_fence_rules(spark):
    texts = [FENCES, ORBIT, "", "```", "```\n```", "a```\n```\nb\n```", "```x\n\n```\n\n```y\nq\n```", "````\nz\n```"]
    docs = spark.createDataFrame([("r", str(i), t) for i, t in enumerate(texts)], FILES)
    rows = refs.code_blocks(docs).collect()
    for i, text in enumerate(texts):
        got = [(r.language, r.start_line, r.end_line, r.code) for r in rows if r.path == str(i)]
        assert sorted(got) == sorted(fences_by_hand(text)), text


def test_salted_lookup_keeps_all_rows_of_a_hot_key(spark):
    left = spark.range(2000).selectExpr("if(id % 3 = 0, id, -1) k", "id v")
    right = spark.range(-1, 1000).selectExpr("id k", "id * 2 w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_lookup(left, right, ["k"], ["v"], salts=4)
        plain = left.join(right, "k")
        assert joined.exceptAll(plain.select(joined.columns)).count() == 0
        assert joined.count() == plain.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
