from pyspark.sql import functions as F

from driftspark.operators import metrics, review
from driftspark.schemas import DECISIONS, FILES, UPDATES
from driftspark.sources.files import write_decision_log, write_documents


def decisions(spark, rows):
    return spark.createDataFrame([("r", f"d{i}", i, *row) for i, row in enumerate(rows)], DECISIONS)


def updates(spark, n):
    rows = [("r", f"d{i}", i, f"old{i}", f"new{i}", "why") for i in range(n)]
    return spark.createDataFrame(rows, UPDATES)


def test_stop_skips_the_rest(spark):
    rows = [("approve", None, None, False), ("reject", None, "bad", True),
            ("approve", None, None, False), ("reject", None, None, False)]
    got = review.resolve_decisions(decisions(spark, rows)).orderBy("seq").collect()
    assert [(r.action, r.feedback) for r in got] == [
        ("approve", None), ("reject", "bad"), ("reject", "Skipped by user"), ("reject", "Skipped by user"),
    ]


def test_missing_action_and_no_stop(spark):
    rows = [(None, None, None, False), ("reject", None, "", False), ("edit", "text", None, True)]
    got = review.resolve_decisions(decisions(spark, rows)).orderBy("seq").collect()
    assert [(r.action, r.feedback) for r in got] == [
        ("reject", "Cancelled by user"), ("reject", None), ("edit", None),
    ]


def test_auto_approve(spark):
    rows = [(None, None, None, True), ("reject", None, "x", True), ("edit", "e", None, False)]
    got = review.resolve_decisions(decisions(spark, rows), auto_approve=True)
    assert {(r.action, r.feedback, r.edited_content) for r in got.collect()} == {("approve", None, None)}


def test_apply_with_backup(spark):
    rows = [("approve", None, None, False), ("edit", "mine", None, False),
            ("edit", "", None, False), ("reject", None, None, False)]
    paired = review.pair_decisions(updates(spark, 4), decisions(spark, rows))
    approved = review.approved_updates(paired)
    assert {r.path: r.final_content for r in approved.collect()} == {"d0": "new0", "d1": "mine", "d2": "new2"}
    docs = spark.createDataFrame([("r", "d0", "old0"), ("r", "d3", "old3")], FILES)
    got = {r.path: (r.content, r.backup, r.is_updated) for r in review.apply_updates(docs, approved).collect()}
    assert got == {
        "d0": ("new0", "old0", True), "d1": ("mine", None, True),
        "d2": ("new2", None, True), "d3": ("old3", None, False),
    }


def test_two_updates_of_one_path(spark):
    approved = spark.createDataFrame(
        [("r", "d", 1, "one"), ("r", "d", 2, "two"), ("r", "d", 3, "three")],
        "repo string, path string, seq int, final_content string",
    )
    docs = spark.createDataFrame([("r", "d", "zero")], FILES)
    row = review.apply_updates(docs, approved).collect()[0]
    assert (row.content, row.backup) == ("three", "two")


def test_sinks(spark, tmp_path):
    rows = [("edit", "mine", None, False), ("reject", None, "no", True), ("approve", None, None, False)]
    final = review.resolve_decisions(decisions(spark, rows))
    paired = review.pair_decisions(updates(spark, 3), final)
    log = str(tmp_path / "log")
    write_decision_log(paired, log)
    write_decision_log(paired, log)
    got = spark.read.json(log)
    assert got.count() == 4  # the skipped third review is not logged
    first = got.filter("path = 'd0'").collect()[0]
    assert (first.action, first.had_edited_content, first.reasoning) == ("edit", True, "why")
    docs = spark.createDataFrame([("r", "d0", "old0")], FILES)
    out = str(tmp_path / "docs")
    write_documents(review.apply_updates(docs, review.approved_updates(paired)), out)
    written = {(r.path, r.content) for r in spark.read.parquet(out).collect()}
    assert written == {("d0", "mine"), ("d0.backup", "old0")}


def test_metrics(spark):
    one = spark.range(3)
    graded = spark.createDataFrame([(2,), (5,)], "n_changed int")
    row = metrics.run_metrics(one, graded, spark.range(4), spark.range(1), spark.range(0)).collect()[0]
    assert row.summary == (
        "Generated 4 documentation update(s). Applied 1 update(s). "
        "Analyzed 3 file(s). Found 7 API change(s)."
    )
    empty = spark.range(0)
    row = metrics.run_metrics(
        empty, graded.filter(F.lit(False)), empty, empty, spark.range(2)
    ).collect()[0]
    assert (row.files_analyzed, row.apis_changed, row.docs_updated, row.errors) == (0, 0, 0, 2)
    assert "Encountered 2 error(s)" in row.summary
