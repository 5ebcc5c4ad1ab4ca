"""License scan by diagonal voting, with DataFrame functions only.

The hashes of all adjacent word pairs of the documents are joined with the pair
positions of short license templates. A hit at document word d and template word t
votes for the diagonal d - t. A phrase stands at word d exactly where its diagonal d has
a vote of every pair of it. For longer templates, neighbouring diagonals (words put in
or left out) are merged into one span, which is verified by the share of the template's
pairs that it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Opening words of public license notices and their labels; at most 64 words each.
NOTICES = [
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "mit",
    ),
    (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "apache",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation",
        "gpl",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
        "bsd",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mpl",
    ),
    (
        "this work is licensed under a creative commons attribution 4 0 international license",
        "cc-by",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies",
        "isc",
    ),
]

COVERED = 0.6  # share of a notice's pairs that a span must hold
NEAR = 4  # diagonals at most so far apart belong to one span


def words(text: Column) -> Column:
    """Words of a text, ASCII lower case; null is empty.

    ``lower`` also lowers other letters, which moves no word border; the two
    characters that it would turn into ASCII letters are replaced first.
    """
    plain = F.coalesce(text, F.lit(""))
    for odd in ("K", "İ"):
        plain = F.replace(plain, F.lit(odd), F.lit("ª"))
    return F.regexp_extract_all(F.lower(plain), F.lit(WORD), F.lit(0))


def pairs(of: str) -> Column:
    """Hash of each adjacent pair of words."""
    return F.expr(
        f"CASE WHEN size({of}) > 1 THEN zip_with(slice({of}, 1, size({of}) - 1), slice({of}, 2, size({of}) - 1),"
        f" (a, b) -> xxhash64(a, b)) ELSE cast(array() as array<bigint>) END"
    )


def _templates(spark: SparkSession) -> DataFrame:
    """(hash, template, pair, n_pairs, label, is_phrase); a fixed, small table."""
    rows = [(i, text, label, i < len(PHRASES)) for i, (text, label) in enumerate([*PHRASES, *NOTICES])]
    frame = spark.createDataFrame(rows, "template int, text string, label string, is_phrase boolean")
    return frame.select("template", "label", "is_phrase", F.split("text", " ").alias("words")).select(
        "template", "label", "is_phrase", (F.size("words") - 1).alias("n_pairs"), F.posexplode(pairs("words")).alias("pair", "hash")
    )


def license_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Verified spans: (doc_id, text_hash, n_words, template, label, is_phrase, low, high,
    covered, times): the lowest and highest diagonal, and the share of the template's
    pairs. Rows with one id and one text count as one, ``times`` says how many there are.
    Each such document also has one row of template -1, which is no span. Null and empty
    texts have no words and no spans. Other columns are left out.
    """
    spark = docs.sparkSession
    marker = 0  # a pair hash of its own that each document carries once
    known = _templates(spark).unionByName(
        spark.createDataFrame([(-1, "", False, 0, 0, marker)], "template int, label string, is_phrase boolean, n_pairs int, pair int, hash bigint")
    )
    parts = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("text_hash"),
        words(F.col(f"`{text}`")).alias("words"),
    )
    hashes = parts.select(
        "doc_id",
        "text_hash",
        F.size("words").cast("bigint").alias("n_words"),
        F.posexplode(F.concat(pairs("words"), F.array(F.lit(marker).cast("bigint")))).alias("at", "hash"),
    )
    votes = (
        hashes.join(F.broadcast(known), "hash")
        .repartition("doc_id", "text_hash")
        .groupBy("doc_id", "text_hash", "n_words", "template", "label", "is_phrase", "n_pairs",
                 F.when(F.col("template") >= 0, F.col("at") - F.col("pair")).alias("diagonal"))
        .agg(F.expr("bit_or(shiftleft(1L, pair))").alias("held"), F.count(F.lit(1)).alias("times"))
    )
    return _spans(votes)


def _spans(votes: DataFrame) -> DataFrame:
    """The votes with a span number for neighbouring diagonals, merged and verified."""
    ordered = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    far = F.col("is_phrase") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(ordered) > NEAR, F.lit(True))
    numbered = votes.withColumn("far", far.cast("int")).withColumn("span", F.sum("far").over(ordered))
    merged = numbered.groupBy("doc_id", "text_hash", "n_words", "template", "label", "is_phrase", "n_pairs", "span").agg(
        F.bit_or("held").alias("held"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.max("times").alias("times")
    )
    covered = F.when(F.col("n_pairs") > 0, F.bit_count("held") / F.col("n_pairs")).otherwise(0.0)
    return merged.withColumn("covered", covered).where(
        (F.col("template") < 0) | (F.col("covered") >= F.when(F.col("is_phrase"), 1.0).otherwise(COVERED))
    )


def label_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score). Labels are distinct, sorted and comma-joined; the score
    is the largest share of a template that a verified span holds, 0 without one."""
    spans = license_spans(docs, doc_id, text)
    base = F.col("is_phrase") & (F.col("template") >= 0)
    found = F.col("template") >= 0
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",")
    per_document = spans.groupBy("doc_id", "text_hash", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("low"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("high"))).cast("bigint").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(found).alias("labels"),
        F.max("covered").alias("score"),
        F.max(F.when(~found, F.col("times"))).cast("int").alias("times"),
    )
    return per_document.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    return label_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
