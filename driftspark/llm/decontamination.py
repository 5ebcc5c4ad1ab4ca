"""Benchmark decontamination by suffix arrays over the training texts.

Each shard (a slice of a partition) of the training texts gets a suffix array over
its words, sorted by the first ``window`` words. Every suffix of every benchmark item
is looked up in it by binary search, which gives all places that share at least a
window with it; these are extended to the longest verbatim match.

A suffix that meets a word which no item has before it reaches the shortest window
can match nothing, and is left out of the array.

The benchmark is a stated query set. It is handed to the tasks in blocks of at most
``block_bytes`` of text; a larger benchmark takes several blocks, one after another,
over the same pass of the training texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftspark.llm.common import chunks, extended, free_name, with_columns
from driftspark.llm.words import ALPHANUMERIC, words_of

WINDOW = 10
BLOCK_BYTES = 32 << 20
MATCH = "array<struct<item_id:string,item_word:bigint,doc_word:bigint,words:bigint>>"


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple[str, str]]]:
    """Items with their ids as text, in bounded lists; null ids and null texts are skipped."""
    rows = benchmark.where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(
        F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")
    )
    block, size = [], 0
    for row in rows.toLocalIterator():
        if block and size + len(row.text) > limit:
            yield block
            block, size = [], 0
        block.append((row.id, row.text))
        size += len(row.text)
    if block:
        yield block


class _Block:
    """Items as word numbers of the block's own vocabulary (0: no word of it), with a 0 between items."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        words = words_of(pa.array([t for _, t in items], pa.large_string()), ALPHANUMERIC)
        self.names = [i for i, _ in items]
        self.vocabulary, numbers = np.unique(words.hashes, return_inverse=True)
        counts = np.diff(words.offsets)
        item = np.repeat(np.arange(len(items)), counts)
        place = np.arange(len(item)) + item
        self.ids = np.zeros(len(item) + len(items) + 1, np.int64)
        self.ids[place] = numbers + 1
        need = np.minimum(counts[item], window)
        word = np.arange(len(item)) - words.offsets[item]
        fits = word + need <= counts[item]
        fits &= (need == window) | (word == 0)
        self.item, self.word, self.start, self.need = item[fits], word[fits], place[fits], need[fits]
        self.shortest = int(self.need.min()) if len(self.need) else 0
        self.window = window
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        self.per_key = max(1, 62 // self.bits)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def keys(self, ids: np.ndarray, at: np.ndarray, need: np.ndarray, fill: int) -> list[np.ndarray]:
        """The first ``window`` words at each place, packed; words from ``need`` on count as ``fill``."""
        out = []
        for first in range(0, self.window, self.per_key):
            key = np.zeros(len(at), np.int64)
            for j in range(first, min(first + self.per_key, self.window)):
                word = np.where(j < need, ids[np.minimum(at + j, len(ids) - 1)], fill)
                key = (key << self.bits) | word
            out.append(key)
        return out

    def find(self, column: pa.Array) -> tuple[np.ndarray, ...]:
        """Word count of each text, and all longest matches: text, its word, item, its word, length."""
        words = words_of(column, ALPHANUMERIC)
        counts = np.diff(words.offsets)
        none = np.zeros(0, np.int64)
        nothing = counts, none, none, none, none, none
        if not self.shortest or not len(words.hashes):
            return nothing
        numbers = np.zeros(len(words.hashes), np.int64)
        likely = np.flatnonzero(self.maybe[(words.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        near = np.minimum(np.searchsorted(self.vocabulary, words.hashes[likely]), len(self.vocabulary) - 1)
        known = self.vocabulary[near] == words.hashes[likely]
        numbers[likely[known]] = near[known] + 1
        text = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(numbers)) + text
        ids = np.zeros(len(numbers) + len(counts) + 1, np.int64)
        ids[place] = numbers
        # the suffixes that stay inside the vocabulary for the shortest window
        breaks = np.flatnonzero(ids == 0)
        suffixes = np.flatnonzero(ids)
        if not len(suffixes):
            return nothing
        run = breaks[np.searchsorted(breaks, suffixes)] - suffixes
        suffixes = suffixes[run >= self.shortest]
        if not len(suffixes):
            return nothing
        whole = np.full(len(suffixes), self.window)
        keys = self.keys(ids, suffixes, whole, 0)
        order = np.lexsort(keys[::-1])
        array, keys = suffixes[order], [k[order] for k in keys]
        top = (1 << self.bits) - 1
        low = _bound(keys, self.keys(self.ids, self.start, self.need, 0), False)
        high = _bound(keys, self.keys(self.ids, self.start, self.need, top), True)
        n = high - low
        if not n.any():
            return nothing
        query = np.repeat(np.arange(len(n)), n)
        at = array[np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + low[query]]
        source = self.start[query]
        before_doc = np.where(at > 0, ids[at - 1], 0)
        before_item = np.where(source > 0, self.ids[source - 1], 0)
        first = (before_doc == 0) | (before_doc != before_item)
        query, at, source = query[first], at[first], source[first]
        length = self.need[query].copy()
        grows = np.arange(len(query))
        while len(grows):
            a = ids[at[grows] + length[grows]]
            grows = grows[(a != 0) & (a == self.ids[source[grows] + length[grows]])]
            length[grows] += 1
        begins = words.offsets[:-1] + np.arange(len(counts))
        found = np.searchsorted(begins, at, side="right") - 1
        return counts, found, at - begins[found], self.item[query], self.word[query], length


def _bound(keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """For each wanted tuple, the first place in the sorted tuples that is not below it (or is above it)."""
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(keys[0]), np.int64)
    for _ in range(len(keys[0]).bit_length() + 1):
        middle = np.minimum((low + high) >> 1, len(keys[0]) - 1)
        below = np.full(len(low), after)
        for key, want in zip(reversed(keys), reversed(wanted), strict=True):
            have = key[middle]
            below = (have < want) | ((have == want) & below)
        open_ = low < high
        low = np.where(open_ & below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, str, str]:
    """The documents with two more columns: their word count, and their longest verbatim matches.

    A match has at least ``window`` words, or all words of a shorter item. Null and
    empty texts have no words and no matches; null items and items without words
    match nothing; repeated items with one id count as that id. All columns are kept;
    the new ones get names that are free. Returns the frame and the two names.
    """
    count, found = free_name(docs, "n_words"), free_name(docs, "matches")
    out = docs.select("*", F.lit(0).cast("bigint").alias(count), F.expr(f"cast(array() as {MATCH})").alias(found))
    passes = list(_blocks(benchmark, item_id, item_text, block_bytes))
    for items in passes or [[]]:
        block = docs.sparkSession.sparkContext.broadcast(_Block(items, window))

        def search(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk in chunks(batch, text):
                    yield _searched(chunk, block.value, text, count, found)

        out = out.mapInArrow(search, out.schema)
    return out, count, found


def _searched(chunk: pa.RecordBatch, block: _Block, text: str, count: str, found: str) -> pa.RecordBatch:
    """The rows with the block's matches added to those of earlier blocks."""
    counts, doc, doc_word, item, item_word, length = block.find(chunk.column(text))
    old = chunk.column(found)
    old = old.cast(pa.list_(old.type.value_type))
    old_doc = np.repeat(np.arange(len(counts)), pa.compute.list_value_length(old).to_numpy(zero_copy_only=False))
    order = np.lexsort((np.concatenate((np.full(len(old_doc), -1), doc_word)), np.concatenate((old_doc, doc))))
    new = pa.StructArray.from_arrays(
        [
            pa.array([block.names[i] for i in item], pa.string()),
            pa.array(item_word, pa.int64()),
            pa.array(doc_word, pa.int64()),
            pa.array(length, pa.int64()),
        ],
        names=["item_id", "item_word", "doc_word", "words"],
    )
    values = pa.concat_arrays([old.flatten().cast(new.type), new]).take(pa.array(order))
    sizes = np.bincount(np.concatenate((old_doc, doc)).astype(np.int64), minlength=len(counts))
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    columns = dict(zip(chunk.schema.names, chunk.columns, strict=True))
    columns[count] = pa.array(counts, pa.int64())
    columns[found] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def covered_words(matches: str) -> Column:
    """How many words of a text lie inside its matches."""
    return F.expr(
        f"""aggregate(
            array_sort(transform(`{matches}`, m -> struct(m.doc_word as a, m.doc_word + m.words as b))),
            struct(0L as n, 0L as upto),
            (s, m) -> struct(s.n + greatest(0L, m.b - greatest(m.a, s.upto)) as n, greatest(s.upto, m.b) as upto),
            s -> s.n)"""
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any match, with their own columns. Options as in ``with_matches``."""
    searched, _, found = with_matches(docs, benchmark, **options)
    return searched.where(F.size(F.col(f"`{found}`")) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    searched, count, found = with_matches(docs, benchmark)
    items = F.array_sort(F.array_distinct(F.col(f"{found}.item_id")))
    hit = covered_words(found)
    return searched.select(
        "doc_id",
        F.col(count).alias("n_words"),
        hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.col(f"{found}.words")), F.lit(0)).cast("bigint").alias("longest"),
    )


OP1_SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS win
  FROM (SELECT item_id, words, unnest(generate_series(1, greatest(1, len(words) - 9))) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i
        FROM w, sizes WHERE len(words) >= n)),
hits AS (SELECT doc_id, i, d.n, item_id FROM doc_windows d JOIN item_windows t ON d.n = t.n AND d.win = t.win),
runs AS (SELECT doc_id, i, n, lead(i) OVER (PARTITION BY doc_id, n ORDER BY i) AS nxt FROM (SELECT DISTINCT doc_id, i, n FROM hits)),
spots AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM runs),
hit_words AS (SELECT doc_id, count(*) AS n_hit FROM spots GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id),
-- longest: maximal matches are runs of windows along one diagonal of document and item
item_places AS (
  SELECT item_id, n, i AS item_at, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, words, least(len(words), 10) AS n, unnest(generate_series(1, greatest(1, len(words) - 9))) AS i
        FROM b WHERE len(words) > 0)),
diagonals AS (
  SELECT doc_id, item_id, d.n, i - item_at AS diagonal, i,
         i - row_number() OVER (PARTITION BY doc_id, item_id, d.n, i - item_at ORDER BY i) AS island
  FROM (SELECT * FROM doc_windows SEMI JOIN hits USING (doc_id, i, n)) d JOIN item_places t ON d.n = t.n AND d.win = t.win),
longest AS (
  SELECT doc_id, max(words) AS longest FROM (
    SELECT doc_id, count(*) + min(n) - 1 AS words FROM diagonals GROUP BY doc_id, item_id, n, diagonal, island) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(longest, 0) AS BIGINT) AS longest
FROM w LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN longest USING (doc_id)
"""
