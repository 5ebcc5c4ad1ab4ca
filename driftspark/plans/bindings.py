"""Operator inputs derived from the given tables.

The tables hold prose, parts and conversations, so snapshots, API lists, source
files, markdown, answers and decisions are derived from all their rows by
column expressions; ``oracle`` states the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftspark.functions.patterns import WORD


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use every core also for a table that is stored as a few small files.

    A table with at least one split per core is left as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _by(column: str, cases: dict[str, Column | str], otherwise: Column | str) -> Column:
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    picked = as_column(otherwise)
    for value, result in reversed(cases.items()):
        picked = F.when(F.col(column) == value, as_column(result)).otherwise(picked)
    return picked


def corpus(id_: str) -> Column:
    """One of the five corpora of the search queries."""
    return F.concat(F.lit("corpus"), F.col(id_) % 5)


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Old and new file snapshot: labels decide which documents each side lacks."""
    docs = spread(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels")
    extension = _by("lang", {"en": ".ts", "fr": ".test.ts", "de": ".py"}, ".JSX")
    path = F.concat(F.lit("src/"), "source", F.lit("/"), "doc_id", extension)
    reviewed = F.concat("text", F.lit("\nReviewed for "), "source")

    def without(lacking: str, content: Column) -> DataFrame:
        kept = docs.join(labels.filter(lacking), "doc_id", "left_anti")
        return kept.select(F.col("source").alias("repo"), path.alias("path"), content.alias("content"))

    new_text = F.when(F.col("n_chars") > 1500, reviewed).otherwise(F.col("text"))
    return without("quality = 0 and toxic = 0", F.col("text")), without("toxic = 1", new_text)


def listed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit file list: the documents labelled as good."""
    old, new = snapshots(spark, sf_dir)
    good = table(spark, sf_dir, "labels").filter("quality = 1").select(
        F.col("doc_id").cast("string").alias("id")
    )
    paths = old.select("repo", "path").unionByName(new.select("repo", "path")).distinct()
    file_id = F.regexp_extract("path", r"/(\d+)\.", 1)
    return paths.withColumn("id", file_id).join(good, "id", "left_semi").select("repo", "path")


def part_apis(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Old and new API list: a part is an API of its brand's file for its type."""
    part = table(spark, sf_dir, "part")
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    none = F.lit(None).cast("string")

    def param(kind: str, type_: str, optional: bool, default: str | None) -> Column:
        return F.struct(
            F.lit(kind).alias("name"),
            F.lit(type_).alias("type"),
            F.lit(optional).alias("optional"),
            F.lit(default).cast("string").alias("default_value"),
        )

    plain = F.array(param("size", "number", False, None))

    def side(rows: str, type_: Column, params: Column, returns: Column, doc: Column) -> DataFrame:
        return part.filter(rows).select(
            F.col("p_brand").alias("repo"),
            F.concat(F.lit("src/"), F.lower("p_type"), F.lit(".ts")).alias("path"),
            F.col("p_partkey").cast("int").alias("ordinal"),
            F.when(F.col("p_size") >= 30, "class").otherwise("function").alias("kind"),
            name.alias("name"),
            F.concat(F.lit("function "), name, F.lit("(size: "), type_, F.lit(")")).alias("signature"),
            (F.col("p_size") < 35).alias("is_public"),
            doc.alias("documentation"),
            returns.alias("return_type"),
            params.alias("parameters"),
            F.struct(*[F.lit(0).alias(c) for c in ("start_line", "end_line", "start_column", "end_column")]).alias("location"),
        )

    old = side("p_size <= 40", F.lit("number"), plain, none, F.col("p_name"))
    new = side(
        "p_size >= 6",
        _by("p_type", {"ECONOMY": "string"}, "number"),
        _by(
            "p_type",
            {
                "ECONOMY": F.array(param("size", "string", False, None)),
                "SMALL": F.array(
                    param("size", "number", False, None), param("unit", "string", True, '"mm"')
                ),
            },
            plain,
        ),
        _by("p_type", {"STANDARD": F.lit("void")}, none),
        _by("p_type", {"PROMO": F.concat("p_name", F.lit(" (revised)"))}, F.col("p_name")),
    )
    return old, new


def part_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Old and new source files, one per part, with every kind of declaration.

    New promo parts have broken source, old ones only where the size is even; every
    fifth small part had broken source. Large parts are files of another language.
    """
    part = spread(table(spark, sf_dir, "part"))
    template = """import React, {{ useState as us_{k} }} from 'react';
import * as u{k} from './{type}';
/**
 * {name}
 */
export function f_{k}(a: string, b?: {b}, c = {size}{close}: Promise<string> {{
  return a;
}}
export const c_{k} = '{name}', d_{k} = {size};
{g}/** {type} part */
export class K_{k} extends Base {{
  private n = {{ a: 1 }};
  constructor(private s: string) {{ super(); }}
  size(unit: string): number {{ if (unit) {{ return {size}; }} }}
}}
export interface I_{k} {{
  id: string;
  tags?: string[];
  find(q: string): Promise<Part>;
}}
export type T_{k} = 'a' | 'b';
export {{ u{k} as util_{k} }};
export default f_{k};
"""
    arrow = F.concat(
        F.lit("export const g_"),
        "p_partkey",
        F.lit(" = async (x: number, ...rest: string[]): void => { };\n"),
    )
    path = F.concat(
        F.lit("src/part_"), "p_partkey", _by("p_type", {"LARGE": ".py"}, ".ts")
    ).alias("path")

    def side(b: Column, g: Column, broken: str) -> DataFrame:
        holes = {
            "k": F.col("p_partkey").cast("string"),
            "type": F.lower("p_type"),
            "name": F.col("p_name"),
            "size": F.col("p_size").cast("string"),
            "close": F.when(F.expr(broken), "").otherwise(")"),
            "b": b,
            "g": g,
        }
        marked = template.format(**{hole: f"\x00{hole}\x00" for hole in holes})
        pieces = [holes.get(p, F.lit(p)) for p in marked.split("\x00")]
        return part.select(F.col("p_brand").alias("repo"), path, F.concat(*pieces).alias("content"))

    old = side(
        F.when(F.col("p_size") > 25, "string").otherwise("number"),
        F.when(F.col("p_size") < 10, "").otherwise(arrow),
        "(p_type = 'PROMO' AND p_size % 2 = 0) OR (p_type = 'SMALL' AND p_size % 5 = 0)",
    )
    return old, side(F.lit("number"), arrow, "p_type = 'PROMO'")


def search_apis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One API for each word of a corpus' benchmark items, in the first item that uses it."""
    words = table(spark, sf_dir, "benchmark").select(
        corpus("item_id").alias("repo"),
        "item_id",
        F.posexplode(F.regexp_extract_all("text", F.lit(rf"[{WORD}]+"), F.lit(0))).alias("pos", "name"),
    )
    first = words.groupBy("repo", "name").agg(F.min(F.struct("item_id", "pos")).alias("at"))
    first = first.select("repo", "name", "at.*")
    none = F.lit(None).cast("string")
    return first.select(
        "repo",
        F.concat(F.lit("src/bench/"), "item_id", F.lit(".ts")).alias("path"),
        F.col("pos").alias("ordinal"),
        F.lit("function").alias("kind"),
        "name",
        F.concat(F.lit("function "), "name", F.lit("()")).alias("signature"),
        (F.length("name") != 7).alias("is_public"),
        none.alias("documentation"),
        none.alias("return_type"),
        F.lit(None).cast("array<struct<name:string,type:string,optional:boolean,default_value:string>>").alias("parameters"),
        F.struct(*[F.lit(0).alias(c) for c in ("start_line", "end_line", "start_column", "end_column")]).alias("location"),
    )


def search_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Old and new version of :func:`search_apis`."""
    apis = search_apis(spark, sf_dir)
    changed = F.concat(F.lit("function "), "name", F.lit("(x)"))
    new = apis.filter(F.length("name") >= 6).withColumn(
        "signature", F.when(F.col("name").contains("th"), changed).otherwise(F.col("signature"))
    )
    return apis.filter(F.length("name") <= 9), new


def streamed_versions(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three batches of file versions: the documents, and one code file per benchmark item that exports
    the names of :func:`search_apis`, changed as in :func:`search_versions`. Then the short
    documents and the code of every third item go."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("docs/"), "source", F.lit("/"), "doc_id", F.lit(".md"))
    texts = docs.select(corpus("doc_id").alias("repo"), path.alias("path"), F.col("text").alias("content"), "n_chars")
    every = table(spark, sf_dir, "benchmark").select(
        corpus("item_id").alias("repo"), F.concat(F.lit("src/bench/"), "item_id", F.lit(".ts")).alias("path"), "item_id"
    )

    def code(rows: str, params: Column | str) -> DataFrame:
        line = F.concat(F.lit("export function "), "name", F.lit("("), params, F.lit(") {}"))
        files = search_apis(spark, sf_dir).filter(rows).groupBy("repo", "path").agg(
            F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("lines")
        )
        return every.join(files, ["repo", "path"], "left").select(
            "repo", "path", F.concat_ws("\n", F.concat(F.lit("// item "), "item_id"), "lines").alias("content")
        )

    more = F.when(F.col("name").contains("th"), "a: string, b: number").otherwise("a: string")
    none = F.lit(None).cast("string").alias("content")
    revised = F.concat("content", F.lit("\nReviewed")).alias("content")
    batches = [
        texts.select("repo", "path", "content").unionByName(code("length(name) <= 9", F.lit("a: string"))),
        texts.filter("n_chars > 1500").select("repo", "path", revised).unionByName(code("length(name) >= 6", more)),
        texts.filter("n_chars < 300").select("repo", "path", none).unionByName(
            every.filter("item_id % 3 = 0").select("repo", "path", none)
        ),
    ]
    return [
        rows.select("repo", "path", F.lit(version).cast("long").alias("version"), "content")
        for version, rows in enumerate(batches)
    ]


def prose_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    path = F.concat(F.lit("docs/"), "source", F.lit("/"), "doc_id", F.lit(".md"))
    return docs.select(corpus("doc_id").alias("repo"), path.alias("path"), F.col("text").alias("content"))


def markdown_docs(spark: SparkSession, sf_dir: str, per_language: bool = False) -> DataFrame:
    """Markdown around every document: header, text, the text as a code block.

    French documents end with an empty block, Spanish ones with an open fence.
    """
    docs = spread(table(spark, sf_dir, "documents"))
    content = F.concat(
        F.lit("# Doc "),
        "doc_id",
        F.lit("\n\n"),
        "text",
        F.lit("\n\n```"),
        "lang",
        F.lit("\n"),
        "text",
        F.lit("\n```\n"),
        _by(
            "lang",
            {
                "fr": "\n```\n```\n",
                "es": "\n```js\nopen (x)",
                "de": "\nYou can pass {Type} here.\n* item\n",
            },
            "",
        ),
    )
    path = F.concat(F.lit("docs/"), "source", F.lit("/"), "doc_id", F.lit(".md"))
    repo = F.concat("source", F.lit("/"), "lang") if per_language else corpus("doc_id")
    return docs.select(
        repo.alias("repo"), path.alias("path"), content.alias("content"), "doc_id", "lang", "text"
    )


def update_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an edited version: lines put first, last, inside or in a fence."""
    docs = spread(table(spark, sf_dir, "documents"))
    inserted = "".join(f"Inserted {i}\n" for i in range(1, 13))
    updated = _by(
        "lang",
        {
            "en": F.concat("text", F.lit("\nNew closing line.")),
            "fr": F.concat(F.lit("New opening line (see notes)\n"), "text"),
            "de": F.regexp_replace("text", r"^([^\n]*)\n", f"$1\n{inserted}"),
        },
        F.concat(F.lit("```\ncode\n```\n"), "text"),
    )
    return docs.select(
        F.col("source").alias("repo"),
        F.concat(F.lit("docs/"), "doc_id", F.lit(".md")).alias("path"),
        F.col("text").alias("original_content"),
        updated.alias("updated_content"),
    )


def risky_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates that lose or break structure, one way per language."""
    updated = _by(
        "lang",
        {
            "en": F.col("content"),
            "fr": F.lit("  \n "),
            "de": F.col("text"),
        },
        F.concat(F.lit("# T\n```x``` and\n"), "text"),
    )
    docs = markdown_docs(spark, sf_dir)
    return docs.select(
        "repo", "path", F.col("content").alias("original_content"), updated.alias("updated_content")
    )


def answers(spark: SparkSession, sf_dir: str, new_docs: bool = False) -> DataFrame:
    """Recorded answers: assistant turns, wrapped differently per turn."""
    turns = table(spark, sf_dir, "conversations").filter("role = 'assistant'")
    titled = F.concat(F.lit("# Answer\n"), "text")
    with_reason = F.to_json(F.struct(titled.alias("updatedContent"), F.lit("why").alias("reasoning")))
    bare = F.to_json(F.struct(titled.alias("updatedContent")))
    turn = F.col("turn")

    def fenced(tag: str, body: Column) -> Column:
        return F.concat(F.lit(f"```{tag}\n"), body, F.lit("\n```"))

    if new_docs:
        response = F.when(turn == 1, fenced("markdown", titled)).when(turn == 2, fenced("js", titled))
    else:
        response = (
            F.when(turn == 1, fenced("json", with_reason))
            .when(turn == 2, bare)
            .when(turn == 3, fenced("markdown", titled))
        )
    return turns.select(
        F.lit("chat").alias("repo"),
        F.concat(F.lit("docs/"), "conv_id", F.lit(".md")).alias("path"),
        turn.cast("int").alias("attempt"),
        response.otherwise(F.concat(F.lit("  "), "text", F.lit(" \n"))).alias("response"),
        F.when(F.length("text") < 400, "timeout").alias("error"),
    )


def reviewed_updates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Updates of the labelled documents and the recorded review decisions."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    place = [
        F.col("source").alias("repo"),
        F.concat(F.lit("docs/"), "source", F.lit("/"), "doc_id", F.lit(".md")).alias("path"),
        F.col("doc_id").cast("int").alias("seq"),
    ]
    updates = labelled.select(
        *place,
        F.col("text").alias("original_content"),
        F.concat("text", F.lit("\n\nReviewed.")).alias("updated_content"),
        F.concat(F.lit("review of "), "lang").alias("reasoning"),
    )
    toxic, good, size = F.col("toxic") == 1, F.col("quality") == 1, F.col("n_chars")
    edited = F.when(size > 1000, F.concat(F.lit("Edited: "), "source")).otherwise("")
    action = F.when(size < 300, None).when(toxic, "reject").when(good, "approve").otherwise("edit")
    decisions = labelled.select(
        *place,
        action.alias("action"),
        F.when(action == "edit", edited).alias("edited_content"),
        F.when(action == "reject", F.lit("off topic")).alias("feedback"),
        (toxic & (size > 2500)).alias("stop"),
    )
    return updates, decisions
