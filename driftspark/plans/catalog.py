"""Registered queries: each runs one operator (or chain) over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftspark.functions import markdown as md
from driftspark.functions.paths import included, is_markdown, language_of, matches_any_glob
from driftspark.functions.source import function_signature
from driftspark.operators import (
    changes,
    diff,
    extract,
    index,
    lines,
    metrics,
    prompts,
    references,
    responses,
    review,
    style,
    validate,
)
from driftspark.plans import bindings as b
from driftspark.sources.files import read_decision_log, scan_files, write_decision_log, write_tree
from driftspark.sources.tables import checkpoint_root, written
from driftspark.streaming.search import found_references, search_batch
from driftspark.streaming.watch import VERSIONS, watch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

INCLUDE = ["src/**/*.ts", "**/*.py"]
IGNORE = ["**/*.test.ts", "src/src1?/**"]
DOC_GLOBS = ["docs/api/**/*.md"]
CODE_GLOBS = ["src/**/*.ts", "lib/**/*.js"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Snapshots and paths


@query
def changed_files(spark, sf_dir):
    """Files that differ between two snapshots."""
    return changes.detect_changes(*b.snapshots(spark, sf_dir))


@query
def changed_files_in_scope(spark, sf_dir):
    """B1 on both sides of A4."""
    found = changes.detect_changes(*b.snapshots(spark, sf_dir), INCLUDE, IGNORE)
    return found.select("repo", "path", "change_type", "language")


@query
def listed_files(spark, sf_dir):
    """A5: an explicit list of files, changed or not."""
    found = changes.detect_changes(
        *b.snapshots(spark, sf_dir), paths=b.listed_paths(spark, sf_dir)
    )
    return found.select("repo", "path", "change_type", F.length("content").alias("n_chars"))


@query
def glob_matches(spark, sf_dir):
    """B2: files per source that each glob matches."""
    path = F.col("path")
    globs = {"ts": ["src/**/*.ts"], "py": ["**/*.py"], "flat": ["src/*1/*"], "deep": ["SRC/**/*.JSX"]}
    hits = [
        F.count_if(matches_any_glob(path, g)).alias(f"n_{name}") for name, g in globs.items()
    ]
    kept = F.count_if(included(path, INCLUDE, IGNORE)).alias("n_included")
    return b.snapshots(spark, sf_dir)[1].groupBy("repo").agg(*hits, kept)


@query
def file_languages(spark, sf_dir):
    """Files per language."""
    old, _ = b.snapshots(spark, sf_dir)
    return old.groupBy(language_of(F.col("path")).alias("language")).agg(
        F.count(F.lit(1)).alias("n_files")
    )


@query
def diff_eligible_files(spark, sf_dir):
    """Changes that yield an API diff."""
    found = changes.detect_changes(*b.snapshots(spark, sf_dir))
    return changes.diff_eligible(found).groupBy("repo", "change_type").agg(
        F.count(F.lit(1)).alias("n_files")
    )


@query
def streamed_changes(spark, sf_dir):
    """Changes from a stream of file versions, one file per document, in three batches:
    all texts, new texts of the longer documents, the end of the shorter ones."""
    docs = b.table(spark, sf_dir, "documents")
    root = checkpoint_root(spark)
    run = uuid.uuid4().hex
    inbox, out, name = f"{root}/versions-{run}", f"{root}/changes-{run}", f"watch-{run}"
    file = [
        F.col("source").alias("repo"),
        F.concat(F.lit("src/"), "doc_id", F.lit(".ts")).alias("path"),
    ]

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    longer, shorter = F.col("n_chars") > 1500, F.col("n_chars") < 300
    revised = F.concat("text", F.lit("\nReviewed"))
    for version, (rows, content) in enumerate(
        [(F.lit(True), F.col("text")), (longer, revised), (shorter, F.lit(None).cast("string"))]
    ):
        batch = docs.filter(rows).select(
            *file, F.lit(version).cast("long").alias("version"), content.alias("content")
        )
        batch.write.mode("append").parquet(inbox)
        versions = spark.readStream.schema(VERSIONS).parquet(inbox)
        watch(versions, store, name, available_now=True).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query
def streamed_references(spark, sf_dir):
    """Documents and code files arrive in three batches; after each, the lines that
    name the APIs which it added, removed or modified."""
    root = f"{checkpoint_root(spark)}/search-{uuid.uuid4().hex}"
    inbox, name = f"{root}/inbox", f"search-{uuid.uuid4().hex}"
    for batch in b.streamed_versions(spark, sf_dir):
        batch.write.mode("append").parquet(inbox)
        versions = spark.readStream.schema(VERSIONS).parquet(inbox)
        watch(versions, search_batch(root), name, available_now=True).awaitTermination()
    return found_references(spark, root).select(
        F.col("batch").cast("int").alias("batch"), "repo", "path", "line_no", "context", "api_name", "api_path", "kind_rank"
    )


@query
def scanned_files(spark, sf_dir):
    """A1: the documents written as a tree, one file each (the writer ends it with a line end), and scanned."""
    root = f"{checkpoint_root(spark)}/tree-{uuid.uuid4().hex}"
    docs = b.table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    # no value of its own for a missing source, as in the directories of a partitioned table
    source = F.when(F.col("source") != "", F.url_encode("source")).otherwise("__HIVE_DEFAULT_PARTITION__")
    folder = F.concat(F.lit("source="), source, F.lit("/"), F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    path = F.concat(folder, F.lit("/doc_id="), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(".txt"))
    write_tree(docs.select(path.alias("path"), F.col("text").alias("content")), root)
    files = scan_files(spark, [root], "tree")
    place = r"source=([^/]*)/\d+/doc_id=(-?\d*)\.txt$"
    return files.select(
        "repo",
        F.url_decode(F.regexp_extract("path", place, 1)).alias("source"),
        F.nullif(F.regexp_extract("path", place, 2), F.lit("")).cast("long").alias("doc_id"),
        "content",
    )


@query
def added_apis(spark, sf_dir):
    """C1"""
    found = diff.added_apis(*b.part_apis(spark, sf_dir))
    return found.select("repo", "path", "name", "ordinal", "signature")


@query
def removed_apis(spark, sf_dir):
    """C2"""
    found = diff.removed_apis(*b.part_apis(spark, sf_dir))
    return found.select("repo", "path", "name", "ordinal", "signature")


@query
def matched_apis(spark, sf_dir):
    """Old rows with the last new row of their name."""
    found = diff.matched_apis(*b.part_apis(spark, sf_dir))
    return found.select(
        "repo",
        "path",
        "name",
        F.col("old.ordinal").alias("old_ordinal"),
        F.col("new.ordinal").alias("new_ordinal"),
        F.size("changes").alias("n_changes"),
    )


@query
def api_change_details(spark, sf_dir):
    """One row per difference, in order."""
    found = diff.matched_apis(*b.part_apis(spark, sf_dir))
    return found.select(
        "repo",
        "path",
        "name",
        F.col("old.ordinal").alias("ordinal"),
        F.posexplode("changes").alias("position", "detail"),
    ).select("repo", "path", "name", "ordinal", "position", "detail.type", "detail.description")


@query
def api_diff(spark, sf_dir):
    """C1-C4 as one table."""
    found = diff.diff_apis(*b.part_apis(spark, sf_dir))
    return found.select("repo", "path", "kind", "name", "ordinal", F.size("changes").alias("n_changes"))


def _part_files(spark, sf_dir):
    old, new = b.part_apis(spark, sf_dir)
    return old.select("repo", "path").unionByName(new.select("repo", "path")).distinct()


def _graded(spark, sf_dir, minimum="patch"):
    found = diff.diff_apis(*b.part_apis(spark, sf_dir))
    return diff.grade_changes(found, _part_files(spark, sf_dir), minimum)


@query
def file_severity(spark, sf_dir):
    """Severity and public flag of each file."""
    return _graded(spark, sf_dir)


@query
def files_above_threshold(spark, sf_dir):
    """Files graded at least major."""
    return _graded(spark, sf_dir, "major").select("repo", "path", "severity")


@query
def changed_api_list(spark, sf_dir):
    """Added, removed and modified APIs of the files above the threshold."""
    found = diff.diff_apis(*b.part_apis(spark, sf_dir))
    kept = diff.keep_graded(found, _graded(spark, sf_dir, "major"))
    listed = diff.changed_apis(kept)
    return listed.select("repo", "path", "kind_rank", "list_ordinal", "name", "signature")


# Extraction


def _apis_of_kind(spark, sf_dir, *kinds):
    found = extract.extract_api_elements(b.part_sources(spark, sf_dir)[1])
    place = [F.col(f"location.{c}").alias(c) for c in ("start_line", "end_line", "start_column", "end_column")]
    return found.filter(F.col("kind").isin(*kinds)).select(
        "repo", "path", "name", "signature", "is_public", "documentation", "return_type", *place
    )


@query
def extracted_functions(spark, sf_dir):
    """K1, K2, K7, H5: functions and function-valued variables."""
    return _apis_of_kind(spark, sf_dir, "function")


@query
def extracted_constants(spark, sf_dir):
    """K2"""
    return _apis_of_kind(spark, sf_dir, "constant")


@query
def extracted_classes(spark, sf_dir):
    """K4"""
    return _apis_of_kind(spark, sf_dir, "class")


@query
def extracted_interfaces(spark, sf_dir):
    """K5"""
    return _apis_of_kind(spark, sf_dir, "interface")


@query
def extracted_aliases(spark, sf_dir):
    """K6"""
    return _apis_of_kind(spark, sf_dir, "type")


@query
def extracted_parameters(spark, sf_dir):
    """K3: one row per parameter."""
    found = extract.extract_api_elements(b.part_sources(spark, sf_dir)[1])
    listed = found.select(
        "repo", "path", F.col("name").alias("api"), F.posexplode("parameters").alias("position", "p")
    )
    return listed.select("repo", "path", "api", "position", "p.*")


@query
def extracted_exports(spark, sf_dir):
    """K8"""
    found = extract.extract_exports(b.part_sources(spark, sf_dir)[1])
    return found.select("repo", "path", "name", "is_default")


@query
def extracted_imports(spark, sf_dir):
    """K9"""
    found = extract.extract_imports(b.part_sources(spark, sf_dir)[1])
    return found.select(
        "repo", "path", "source", F.array_join("specifiers", ",").alias("specifiers"), "is_default"
    )


@query
def unreadable_files(spark, sf_dir):
    """V4: error rows of files that cannot be parsed."""
    _, new = b.part_sources(spark, sf_dir)
    return extract.parse_errors(new.withColumn("language", language_of(F.col("path"))))


@query
def built_signatures(spark, sf_dir):
    """H5: signature text from parameter structs."""
    _, new = b.part_apis(spark, sf_dir)
    signature = F.expr(function_signature("name", "parameters", "return_type"))
    return new.select("repo", "path", "ordinal", signature.alias("signature"))


def _changed_sources(spark, sf_dir):
    found = changes.diff_eligible(changes.detect_changes(*b.part_sources(spark, sf_dir)))
    return extract.split_unreadable(found)


@query
def unreadable_changes(spark, sf_dir):
    """V4: error rows of changed files that cannot be read now or could not before."""
    return _changed_sources(spark, sf_dir)[1]


@query
def source_drift(spark, sf_dir):
    """Severity of every changed source file that can be read."""
    found = changes.diff_eligible(changes.detect_changes(*b.part_sources(spark, sf_dir)))
    read = written(extract.read_changes(found), "read")  # both texts of a file are read once
    graded = diff.grade_changes(diff.diff_sides(extract.apis_of_versions(read)), read.filter("problem IS NULL"))
    return graded.select("repo", "path", "severity", "n_changed")


# References


def _search(spark, sf_dir):
    listed = b.search_apis(spark, sf_dir).withColumn("kind_rank", F.lit(1))
    return listed, references.search_names(listed)


def _hits(spark, sf_dir, blocks=True):
    """Listed APIs, documents, and the places that name an API: the documents are cut once."""
    listed, names = _search(spark, sf_dir)
    docs = b.markdown_docs(spark, sf_dir).select("repo", "path", "content")
    return listed, docs, index.search(index.postings(docs, blocks=blocks), names, docs)


@query
def line_references(spark, sf_dir):
    """Every document line that names an API, with its context."""
    _, names = _search(spark, sf_dir)
    return references.find_references(b.prose_docs(spark, sf_dir), names).drop("kind_rank")


@query
def line_references_two_phase(spark, sf_dir):
    """C6 as for a search list that cannot be broadcast."""
    _, names = _search(spark, sf_dir)
    docs = b.prose_docs(spark, sf_dir)
    return references.find_references(docs, names.hint("merge"), two_phase=True, small_parts=True).drop("kind_rank")


@query
def code_examples(spark, sf_dir):
    """Fenced blocks that name an API."""
    _, names = _search(spark, sf_dir)
    docs = b.markdown_docs(spark, sf_dir).select("repo", "path", "content")
    return references.find_examples(docs, names, small_parts=True).drop("kind_rank", "repo")


@query
def missing_docs(spark, sf_dir):
    """Public APIs that nothing names."""
    listed, _, hits = _hits(spark, sf_dir, blocks=False)
    return index.missing_docs(listed, index.named_apis(hits)).select("path", "name", "signature")


@query
def document_hits(spark, sf_dir):
    """D3 as counts."""
    _, names = _search(spark, sf_dir)
    docs = b.markdown_docs(spark, sf_dir).select("repo", "path", "content")
    return references.document_hits(
        references.find_references(docs, names), references.find_examples(docs, names)
    )


@query
def affected_documents(spark, sf_dir):
    """D3: affected documents with ordered references and examples."""
    _, docs, hits = _hits(spark, sf_dir)
    rows = index.affected_docs(docs, index.document_matches(hits))

    def joined(items: str, *fields: str) -> Column:
        return F.array_join(
            F.transform(items, lambda x: F.concat_ws(":", *[x[f] for f in fields])), "|"
        )

    return rows.select(
        "path",
        joined("references", "line_no", "api_name").alias("reference_list"),
        joined("examples", "language", "start_line", "end_line", "api_name").alias("example_list"),
        F.length("content").alias("n_chars"),
    )


@query
def total_references(spark, sf_dir):
    """D4"""
    _, names = _search(spark, sf_dir)
    return references.total_references(
        references.find_references(b.prose_docs(spark, sf_dir), names)
    )


@query
def drifted_documents(spark, sf_dir):
    """Documents that mention changed names, with the lines (flagship)."""
    found = diff.diff_apis(*b.search_versions(spark, sf_dir))
    names = references.search_names(diff.changed_apis(found))
    hits = references.find_references(b.prose_docs(spark, sf_dir), names)
    return hits.groupBy("path", "line_no").agg(
        F.count(F.lit(1)).alias("n_references"),
        F.count_if(F.col("kind_rank") == 1).alias("n_added"),
        F.count_if(F.col("kind_rank") == 2).alias("n_removed"),
        F.count_if(F.col("kind_rank") == 3).alias("n_modified"),
    )


# Markdown


@query
def code_blocks(spark, sf_dir):
    """H1"""
    docs = b.markdown_docs(spark, sf_dir).select("repo", "path", "content")
    return references.code_blocks(docs).drop("repo")


@query
def raw_fences(spark, sf_dir):
    """H2, H4: fence spans and whether they are well formed."""
    updates = b.risky_updates(spark, sf_dir).select(
        "path", F.posexplode(md.raw_fences(F.col("updated_content"))).alias("position", "fence")
    )
    return updates.withColumn("is_valid", md.is_valid_fence(F.col("fence")))


@query
def document_headers(spark, sf_dir):
    """H3"""
    docs = b.markdown_docs(spark, sf_dir)
    return docs.select("path", F.posexplode(md.headers(F.col("content"))).alias("position", "header"))


@query
def markdown_paths(spark, sf_dir):
    """A1's file test: markdown files among a snapshot and the documents."""
    old, _ = b.snapshots(spark, sf_dir)
    every = old.select("path").unionByName(b.prose_docs(spark, sf_dir).select("path"))
    return every.groupBy(is_markdown(F.col("path")).alias("is_markdown")).agg(
        F.count(F.lit(1)).alias("n_files")
    )


def _style_docs(spark, sf_dir):
    docs = b.markdown_docs(spark, sf_dir, per_language=True).select("repo", "path", "content")
    return docs, references.code_blocks(docs)


@query
def corpus_tone(spark, sf_dir):
    """D7"""
    return style.tone(_style_docs(spark, sf_dir)[0])


@query
def corpus_formatting(spark, sf_dir):
    """D8"""
    return style.formatting(_style_docs(spark, sf_dir)[0])


@query
def corpus_conventions(spark, sf_dir):
    """D9"""
    found = style.conventions(_style_docs(spark, sf_dir)[0])
    return found.select("repo", F.array_join("conventions", "; ").alias("conventions"))


@query
def corpus_example_patterns(spark, sf_dir):
    """D10"""
    found = style.example_patterns(_style_docs(spark, sf_dir)[1])
    return found.select("repo", F.array_join("example_patterns", "; ").alias("example_patterns"))


def _context(spark, sf_dir):
    docs, blocks = _style_docs(spark, sf_dir)
    part = b.table(spark, sf_dir, "part").select(F.col("p_brand").alias("repo"))
    repos = docs.select("repo").unionByName(part).distinct()
    return style.build_context(style.style_guide(docs, blocks, repos), CODE_GLOBS)


@query
def project_context(spark, sf_dir):
    """Style guide (default where there are no documents) and project facts."""
    return _context(spark, sf_dir).select(
        "repo",
        "tone",
        "formatting",
        F.array_join("conventions", "; ").alias("conventions"),
        F.array_join("example_patterns", "; ").alias("example_patterns"),
        "language",
        "documentation_format",
    )


@query
def context_examples(spark, sf_dir):
    """Examples of the affected documents with their corpus' language."""
    _, names = _search(spark, sf_dir)
    docs = b.markdown_docs(spark, sf_dir).select("repo", "path", "content")
    examples = references.find_examples(docs, names)
    corpora = examples.select("repo").distinct()
    context = style.build_context(corpora, ["lib/**/*.py", "src/**/*.go"])
    found = style.context_examples(examples, context)
    return found.select("path", "start_line", "end_line", "api_name", "project_language")


# Text deltas and validation


@query
def line_deltas(spark, sf_dir):
    """L1"""
    return lines.line_delta(b.update_pairs(spark, sf_dir))


@query
def changed_hunks(spark, sf_dir):
    """L2"""
    return lines.change_hunks(b.update_pairs(spark, sf_dir))


@query
def validated_updates(spark, sf_dir):
    """V1-V3"""
    return validate.validate_updates(b.risky_updates(spark, sf_dir)).select(
        "path",
        "is_valid",
        F.array_join("errors", "|").alias("errors"),
        F.array_join("warnings", "|").alias("warnings"),
    )


# Answers


@query
def parsed_answers(spark, sf_dir):
    """H9"""
    parsed = responses.parse_update_answers(b.answers(spark, sf_dir))
    return parsed.select("path", "attempt", "is_structured", "updated_content", "reasoning")


@query
def update_changes(spark, sf_dir):
    """H9, L2: the changed sections of each parsed update."""
    parsed = responses.parse_update_answers(b.answers(spark, sf_dir))
    originals = b.table(spark, sf_dir, "conversations").filter("role = 'assistant'").select(
        F.lit("chat").alias("repo"),
        F.concat(F.lit("docs/"), "conv_id", F.lit(".md")).alias("path"),
        F.col("turn").cast("int").alias("attempt"),
        F.concat("text", F.lit("\nOld end.")).alias("original_content"),
    )
    found = responses.attach_changes(parsed, originals)
    entry = lambda c: F.concat_ws(":", *[c[f] for f in ("type", "start_line", "end_line", "old_content", "new_content")])
    return found.select("path", "attempt", F.array_join(F.transform("changes", entry), "|").alias("changes"))


@query
def parsed_new_docs(spark, sf_dir):
    """H10"""
    parsed = responses.parse_new_doc_answers(b.answers(spark, sf_dir, new_docs=True))
    return parsed.select("path", "attempt", "updated_content")


@query
def first_valid_answers(spark, sf_dir):
    """First valid answer of at most three, or the failure."""
    parsed = responses.parse_update_answers(b.answers(spark, sf_dir))
    return responses.first_valid(parsed, 3).drop("repo")


@query
def failed_answers(spark, sf_dir):
    """V4: error rows of documents without a valid answer; the rest goes on."""
    parsed = responses.parse_update_answers(b.answers(spark, sf_dir))
    _, bad = responses.split_failures(responses.first_valid(parsed, 2), "generate update")
    return bad.drop("repo")


@query
def new_doc_updates(spark, sf_dir):
    """Updates that create documents for undocumented APIs."""
    listed, _, hits = _hits(spark, sf_dir, blocks=False)
    missing = index.missing_docs(listed, index.named_apis(hits))
    texts = listed.select("repo", "name").distinct().withColumn(
        "updated_content", F.concat(F.lit("# "), "name")
    )
    return responses.new_doc_updates(missing, texts, DOC_GLOBS).drop("repo")


# Prompts


@query
def change_sections(spark, sf_dir):
    """Change list of each file's document."""
    entries = prompts.change_entries(diff.diff_apis(*b.part_apis(spark, sf_dir)))
    return prompts.change_sections(entries, entries.withColumn("path", F.col("api_path")))


def _prompt_context(spark, sf_dir):
    """One row per corpus, computed once."""
    docs = b.markdown_docs(spark, sf_dir).select("repo", "path", "content")
    guide = style.style_guide(docs, references.code_blocks(docs))
    return written(style.build_context(guide, CODE_GLOBS, "markdown", "Be brief"), "context")


@query
def reference_sections(spark, sf_dir):
    """Reference and example sections of each affected document."""
    _, docs, hits = _hits(spark, sf_dir)
    affected = index.affected_docs(docs, index.document_matches(hits))
    return affected.select(
        "path",
        prompts.reference_section(F.col("references")).alias("reference_section"),
        prompts.example_section(F.col("examples")).alias("example_section"),
    )


@query
def update_prompts(spark, sf_dir):
    """One prompt per affected document."""
    listed, docs, hits = _hits(spark, sf_dir)
    matches = written(index.document_matches(hits), "matches")
    entries = prompts.change_entries(diff.diff_apis(listed.filter(F.lit(False)), listed))
    sections = prompts.change_sections(entries, index.mentions(matches))
    # only positions meet the sections and the context; the texts are cut out where the prompt is written
    described = prompts.with_sections(matches, _prompt_context(spark, sf_dir), sections)
    built = prompts.render_prompts(index.affected_docs(docs, described))
    return built.select("path", "system", "user")


@query
def new_doc_prompts(spark, sf_dir):
    """H14 for undocumented APIs."""
    listed, _, hits = _hits(spark, sf_dir, blocks=False)
    missing = index.missing_docs(listed, index.named_apis(hits))
    return prompts.build_new_doc_prompts(missing, _prompt_context(spark, sf_dir)).drop("repo")


# Review


def _decided(spark, sf_dir, auto_approve=False):
    updates, decisions = b.reviewed_updates(spark, sf_dir)
    final = review.resolve_decisions(decisions, auto_approve=auto_approve)
    return review.pair_decisions(updates, final)


@query
def resolved_decisions(spark, sf_dir):
    """Decisions after batch stops."""
    _, decisions = b.reviewed_updates(spark, sf_dir)
    return review.resolve_decisions(decisions)


@query
def approved_updates(spark, sf_dir):
    """Approved or edited updates with the text to write."""
    approved = review.approved_updates(_decided(spark, sf_dir))
    return approved.select("repo", "path", "seq", "action", "final_content")


@query
def auto_approved_updates(spark, sf_dir):
    """B8 with auto-approve."""
    approved = review.approved_updates(_decided(spark, sf_dir, auto_approve=True))
    return approved.groupBy("repo").agg(
        F.count(F.lit(1)).alias("n_updates"), F.sum(F.length("final_content")).alias("n_chars")
    )


@query
def applied_documents(spark, sf_dir):
    """Documents after the review, with backups."""
    docs = b.table(spark, sf_dir, "documents").select(
        F.col("source").alias("repo"),
        F.concat(F.lit("docs/"), "source", F.lit("/"), "doc_id", F.lit(".md")).alias("path"),
        F.col("text").alias("content"),
    )
    return review.apply_updates(docs, review.approved_updates(_decided(spark, sf_dir)))


@query
def decision_log(spark, sf_dir):
    """A7's records (without their time of writing)."""
    return review.decision_log(_decided(spark, sf_dir)).drop("ts")


@query
def logged_decisions(spark, sf_dir):
    """The log after its sink has run, failed to report and run again."""
    log = f"{checkpoint_root(spark)}/log-{uuid.uuid4().hex}"
    for _ in range(2):
        write_decision_log(_decided(spark, sf_dir), log, run="review")
    return read_decision_log(spark, log).drop("ts", "run", "batch")


@query
def observed_run(spark, sf_dir):
    """D5 by observation: the counts of a run, taken while its tables are written."""
    run = metrics.RunObservation(spark)
    found = run.files_analyzed(changes.detect_changes(*b.part_sources(spark, sf_dir)))
    found = written(found, "changes")
    apis, errors = extract.extract_changed_apis(changes.diff_eligible(found))
    written(run.errors(errors), "errors")
    readable, _ = extract.split_unreadable(changes.diff_eligible(found))
    graded = diff.grade_changes(diff.diff_sides(apis), readable, "minor")
    written(run.apis_changed(graded), "graded")
    updates, decisions = b.reviewed_updates(spark, sf_dir)
    written(run.updates_generated(updates), "updates")
    paired = review.pair_decisions(updates, review.resolve_decisions(decisions))
    written(run.docs_updated(review.approved_updates(paired)), "approved")
    return run.metrics()


@query
def stored_files_in_scope(spark, sf_dir):
    """B1, B2 on a stored snapshot: ranges of paths reach the scan, texts elsewhere are not read."""
    _, new = b.snapshots(spark, sf_dir)
    stored = written(new.repartitionByRange("path").sortWithinPartitions("path"), "snapshot")
    kept = changes.filter_paths(stored, ["src/src1/**/*.ts", "src/src2/*"], ["**/*.test.ts"])
    return kept.select("repo", "path", F.length("content").alias("n_chars"))


@query
def run_metrics(spark, sf_dir):
    """D5"""
    updates, _ = b.reviewed_updates(spark, sf_dir)
    return metrics.run_metrics(
        changes.detect_changes(*b.snapshots(spark, sf_dir)),
        _graded(spark, sf_dir, "minor"),
        updates,
        review.approved_updates(_decided(spark, sf_dir)),
        unreadable_changes(spark, sf_dir),
    )
