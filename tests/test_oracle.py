import re

import pytest
from oracle_check import compare, duck

import __spark_entry__ as driver
from driftspark.plans.catalog import QUERIES
from driftspark.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
# An update list of this size has no conversation without a valid early answer.
MAY_BE_EMPTY = {"failed_answers"}


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equal_to_sql(spark, connection, name):
    problem = compare(spark, connection, name, SF)
    assert problem is None or (problem == "no rows" and name in MAY_BE_EMPTY), problem


def test_entry(spark):
    assert driver.entry(spark).columns == [
        "path", "line_no", "n_references", "n_added", "n_removed", "n_modified",
    ]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_small_search_lists_are_broadcast(spark):
    text = plan(QUERIES["line_references"](spark, SF))
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text


def test_only_tokens_travel_to_the_search_list(spark):
    text = plan(QUERIES["line_references_two_phase"](spark, SF)).split("\n")
    carried = []
    for i, line in enumerate(text):
        if re.search(r"Exchange hashpartitioning\(repo#\d+, token#", line):
            for below in text[i + 1 : i + 4]:
                found = re.search(r"Generate explode\(.*\), \[([^\]]*)\], (?:true|false), \[token#", below)
                carried += [re.sub(r"#.*", "", c.strip()) for c in found[1].split(",")] if found else []
    assert sorted(carried) == ["path", "pos", "repo"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_plans(spark, name):
    if name in ("streamed_changes", "streamed_references"):  # already stored tables
        return
    text = plan(QUERIES[name](spark, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)


def test_scans_read_only_the_needed_columns(spark):
    text = plan(QUERIES["file_languages"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("lang:string" in s and "text" not in s for s in schemas), schemas


def test_path_ranges_reach_the_scan(spark):
    text = plan(QUERIES["stored_files_in_scope"](spark, SF))
    pushed = text.partition("PushedFilters:")[2].partition("ReadSchema")[0]
    assert "GreaterThanOrEqual(path,SRC/SRC1/)" in pushed and "LessThan(path,src/src10)" in pushed


@pytest.mark.parametrize(("name", "most"), [("changed_files", 4), ("source_drift", 4), ("update_prompts", 5)])
def test_tables_are_read_few_times(spark, name, most):
    # two of changed_files' scans are the labels that decide which files each side has
    assert plan(QUERIES[name](spark, SF)).count("FileScan") <= most


def test_missing_docs_need_no_text_join(spark):
    joins = [line for line in plan(QUERIES["missing_docs"](spark, SF)).split("\n") if "Join" in line]
    assert joins and not any("content" in line or "path" in line for line in joins)
