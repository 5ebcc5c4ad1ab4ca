"""Which documents mention which APIs.

A whole-word search is an equi-join on word tokens: a name of word characters
occurs as a whole word exactly when one of the line's maximal word runs equals
it. Other names join on a token any match must contain and are then verified.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftspark.functions.markdown import fenced_blocks
from driftspark.functions.text import (
    is_plain_name,
    lines_of,
    name_key,
    names_whole_word,
    tokens_of,
)

# The API columns a hit carries besides the name.
API_COLUMNS = ("api_path", "api_ordinal", "kind_rank")
HIT_ORDER = ("kind_rank", "api_path", "api_ordinal")
LIST_ROWS, LIST_BYTES = 100_000, 32_000_000  # of a search list that every task holds
PART_BYTES = 1 << 20  # of documents whose examples are written together


def search_names(changed: DataFrame, scope: Sequence[str] = ("repo",)) -> DataFrame:
    """Search list of changed APIs: scope, name, join token and the API's identity."""
    return changed.filter(F.length("name") > 0).select(
        *scope,
        F.col("name").alias("api_name"),
        name_key(F.col("name")).alias("token"),
        F.col("path").alias("api_path"),
        F.col("ordinal").alias("api_ordinal"),
        "kind_rank",
    )


def _with_texts(
    docs: DataFrame, hits: DataFrame, where: Sequence[str], scope: Sequence[str], parts: int = 0
) -> DataFrame:
    """Hits (positions only) of each document, joined once to the document's lines.

    One row per hit with ``where``, the API columns and ``lines``, in the order of ``where``: rows with
    the same text follow each other, so a writer's compression finds it. A document's hits are
    bounded by its own lines times the APIs that a line names. With ``parts`` the documents are dealt
    to as many tasks, by the shuffles of a sort-merge join or after a broadcast one.
    """
    keys = [*scope, "path"]
    entry = F.struct(*where, "api_name", *API_COLUMNS)
    # hits come from all over the search list: before the shuffle there is little of a document to collect
    found = _dealt(hits, keys, parts).groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("hits"))
    texts = docs.select(*keys, "content")
    # Spark leaves out the last repartition where the join's sides are dealt so already
    joined = _dealt(_dealt(texts, keys, parts).join(found, keys), keys, parts) if parts else texts.join(found, keys)
    return joined.select(*keys, lines_of(F.col("content")).alias("lines"), "hits").select(
        *keys, "lines", F.inline("hits")
    )


def _dealt(rows: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    return rows.repartition(parts, *keys) if parts else rows.repartition(*keys)


def _verified(hits: DataFrame, text: Column) -> DataFrame:
    name = F.col("api_name")
    return hits.filter(is_plain_name(name) | names_whole_word(text, name))


def goes_to_the_texts(docs: DataFrame, names: DataFrame, scope: Sequence[str] = ("repo",)) -> bool:
    """True for a search list that can be broadcast, of at most ``LIST_ROWS`` rows and ``LIST_BYTES`` bytes of
    text, and documents without repeated paths: a line's hits then follow from the line alone."""
    texts = [F.octet_length(F.coalesce(c, F.lit(""))) for c in ("api_name", "token", "api_path")]
    size = names.limit(LIST_ROWS + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(texts, F.lit(0))), F.lit(0)))
    rows, bytes_ = size.first()
    if rows > LIST_ROWS or bytes_ > LIST_BYTES:
        return False
    keys = [*scope, "path"]
    return docs.dropna(subset=keys).groupBy(*keys).count().filter("count > 1").isEmpty()


def _named(texts: DataFrame, names: DataFrame, text: Column, scope: Sequence[str]) -> DataFrame:
    """Each text with each API row that it names; the list goes to the texts. The text is only
    looked at again for names that token equality does not prove."""
    listed = F.broadcast(names.withColumn("plain", is_plain_name(F.col("api_name"))))
    tokens = texts.withColumn("token", F.explode(tokens_of(text)))
    found = tokens.join(listed, [*scope, "token"])
    return found.filter(F.col("plain") | names_whole_word(text, F.col("api_name")))


def find_references(
    docs: DataFrame,
    names: DataFrame,
    scope: Sequence[str] = ("repo",),
    two_phase: bool | None = None,
    small_parts: bool = False,
) -> DataFrame:
    """One row per document line and API row it names, with the line's context.

    ``docs`` holds ``scope``, ``path`` and ``content``, one row per path; ``names``
    comes from :func:`search_names`. The context is the line and its neighbours.

    A list that every task can hold meets the lines where they are read; nothing is shuffled.
    In two phases, by default for a longer list or repeated paths, only tokens and line numbers meet it;
    Spark splits a frequent token's rows. The text is then joined once per document that has a hit; with
    ``small_parts`` in tasks of about ``PART_BYTES`` of text, as :func:`find_examples` says.
    """
    keys = [*scope, "path"]
    result = ["context", F.lit("name").alias("reference_type"), "api_name", *API_COLUMNS]
    around = F.concat_ws("\n", *[F.get("lines", F.col("pos") + step) for step in (-1, 0, 1)]).alias("context")
    number = (F.col("pos") + 1).alias("line_no")
    if two_phase or (two_phase is None and not goes_to_the_texts(docs, names, scope)):
        lines = docs.select(*keys, F.posexplode(lines_of(F.col("content"))).alias("pos", "line"))
        tokens = lines.select(*keys, "pos", F.explode(tokens_of(F.col("line"))).alias("token"))
        parts = _parts(docs, copies=3) if small_parts else 0  # a line stands in three contexts
        hits = _with_texts(docs, tokens.join(names, [*scope, "token"]), ["pos"], scope, parts)
        proven = _verified(hits, F.get("lines", F.col("pos")))
        return proven.select(*keys, number, around, "api_name", *API_COLUMNS).select(*keys, "line_no", *result)
    lined = docs.dropna(subset=keys).select(*keys, lines_of(F.col("content")).alias("lines"))
    lines = lined.select(*keys, "lines", F.posexplode("lines").alias("pos", "line"))
    lines = lines.select(*keys, number, "line", around)
    return _named(lines, names, F.col("line"), scope).select(*keys, "line_no", *result)


def code_blocks(docs: DataFrame, scope: Sequence[str] = ("repo",)) -> DataFrame:
    """Closed fenced blocks of every document: language, line range and code."""
    extra = [c for c in docs.columns if c not in (*scope, "path", "content")]
    return docs.select(
        *scope, "path", *extra, F.inline(fenced_blocks(F.col("content")))
    )


def find_examples(
    docs: DataFrame,
    names: DataFrame,
    scope: Sequence[str] = ("repo",),
    two_phase: bool | None = None,
    small_parts: bool = False,
) -> DataFrame:
    """One row per fenced block and API row it names; the plans are those of the lines.

    A block's code stands in as many rows as it names APIs. For rows that will be written,
    ``small_parts`` deals the documents to tasks with about ``PART_BYTES`` of text, so that the
    dictionary of a file's code column, a megabyte, holds each code once.
    """
    place = ["language", "start_line", "end_line"]
    keys = [*scope, "path"]
    if two_phase is None:
        two_phase = not goes_to_the_texts(docs, names, scope)
    parts = _parts(docs) if small_parts else 0
    blocks = code_blocks(docs.select(*keys, "content"), scope)
    if two_phase:
        tokens = blocks.select(*keys, *place, F.explode(tokens_of(F.col("code"))).alias("token"))
        hits = _with_texts(docs, tokens.join(names, [*scope, "token"]), place, scope, parts)
        length = F.col("end_line") - F.col("start_line") + 1
        code = F.array_join(F.slice("lines", F.col("start_line"), length), "\n")
        return _verified(hits, code).select(*keys, *place, code.alias("code"), "api_name", *API_COLUMNS)
    blocks = blocks.dropna(subset=keys)
    dealt = blocks.repartition(parts, *keys) if parts else blocks
    return _named(dealt, names, F.col("code"), scope).select(*keys, *place, "code", "api_name", *API_COLUMNS)


def _parts(docs: DataFrame, copies: int = 1) -> int:
    """Number of parts with about ``PART_BYTES`` of text that stands in the rows ``copies`` times."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("content")), F.lit(0))).first()[0]
    return max(1, -(-size * copies // PART_BYTES))


def missing_docs(
    changed: DataFrame,
    references: DataFrame,
    examples: DataFrame,
    scope: Sequence[str] = ("repo",),
) -> DataFrame:
    """Changed public APIs that no document line and no example names."""
    keys = [*scope, "api_name"]
    seen = references.select(*keys).unionByName(examples.select(*keys)).distinct()
    seen = seen.withColumnRenamed("api_name", "name")
    return changed.filter("is_public").join(seen, [*scope, "name"], "left_anti").select(
        *changed.columns
    )


def total_references(references: DataFrame) -> DataFrame:
    """Number of references; a line naming two APIs counts twice."""
    return references.agg(F.count(F.lit(1)).alias("total_references"))


def document_hits(
    references: DataFrame, examples: DataFrame, scope: Sequence[str] = ("repo",)
) -> DataFrame:
    """Reference and example counts of each affected document.

    Counts combine on the map side, so this holds for a document with any share
    of all hits; the rows themselves stay in the two hit tables.
    """
    keys = [*scope, "path"]
    both = references.select(*keys, F.lit(1).alias("ref")).unionByName(
        examples.select(*keys, F.lit(0).alias("ref"))
    )
    return both.groupBy(*keys).agg(
        F.sum("ref").cast("long").alias("n_references"),
        F.sum(1 - F.col("ref")).cast("long").alias("n_examples"),
    )


def affected_docs(
    docs: DataFrame,
    references: DataFrame,
    examples: DataFrame,
    scope: Sequence[str] = ("repo",),
) -> DataFrame:
    """Affected documents as one row each, with ordered references and examples.

    References and examples are grouped apart (never crossed) and carry only
    positions through the shuffle; context and code are cut out of the document
    after it is joined back. A row is bounded by its own document's lines times
    the API rows that share a name; use the hit tables for unbounded reports.
    """
    keys = [*scope, "path"]

    def grouped(hits: DataFrame, where: Sequence[str], name: str) -> DataFrame:
        entry = F.struct(*HIT_ORDER, *where, "api_name")
        return hits.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias(name))

    refs = grouped(references, ["line_no"], "ref_hits")
    exs = grouped(examples, ["start_line", "end_line", "language"], "example_hits")
    return cut_out(docs, refs.join(exs, keys, "full_outer"), scope)


def cut_out(docs: DataFrame, hits: DataFrame, scope: Sequence[str] = ("repo",)) -> DataFrame:
    """Documents with the context and code of their hits.

    ``hits`` has one row per affected document: ``ref_hits`` and ``example_hits``, ordered
    arrays of positions and API names. Each document's text is joined once; other columns
    of ``hits`` are kept.
    """
    keys = [*scope, "path"]
    kept = [c for c in hits.columns if c not in (*keys, "ref_hits", "example_hits")]
    joined = docs.select(*keys, "content").join(hits, keys).withColumn(
        "lines", lines_of(F.col("content"))
    )

    def reference(hit):
        near = [F.get("lines", hit["line_no"] + step) for step in (-2, -1, 0)]
        return F.struct(
            hit["line_no"].alias("line_no"),
            F.concat_ws("\n", *near).alias("context"),
            F.lit("name").alias("reference_type"),
            hit["api_name"].alias("api_name"),
            *[hit[c].alias(c) for c in HIT_ORDER],
        )

    def example(hit):
        length = hit["end_line"] - hit["start_line"] + 1
        return F.struct(
            hit["language"].alias("language"),
            hit["start_line"].alias("start_line"),
            hit["end_line"].alias("end_line"),
            F.array_join(F.slice("lines", hit["start_line"], length), "\n").alias("code"),
            hit["api_name"].alias("api_name"),
        )

    return joined.select(
        *keys,
        "content",
        F.transform(F.coalesce("ref_hits", F.expr("array()")), reference).alias("references"),
        F.transform(F.coalesce("example_hits", F.expr("array()")), example).alias("examples"),
        *kept,
    )
