"""Lexical retrieval packing: documents that share rare tokens share a training window.

1. Every text is tokenised once; the ids go to a table in the shared folder, each row
   with the smallest hash of its tokens (``near``), which similar documents tend to share.
2. The document frequency of each token is counted over all documents. The vocabulary of
   the tokenizer bounds this table.
3. The documents are dealt out by ranges of (near, place), so that similar ones meet and
   no group is too large for one task. Each task reads its range in order and cuts it
   into shards of bounded size.
4. Each shard gets a BM25 inverted index. A seed document opens a window; the unused
   documents with the best BM25 scores for the seed's rarest tokens fill it, best first.
   Documents that share nothing with the seed follow in order. A document that reaches
   over the end of the window is cut, and its rest is the seed of the next window.
5. A task's last window that is not full is cut into sequences of powers of two, which
   need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftspark.llm.common import chunks, shared_folder
from driftspark.llm.tokens import shared_encoder
from driftspark.llm.words import mix

WINDOW = 4096
SHARD_TOKENS = 1 << 20
QUERY_TOKENS = 32
K1, B = 1.2, 0.75  # the usual BM25 parameters
TOKENS = "place bigint, doc_id bigint, near bigint, n_tokens bigint, ids binary"
PIECES = (
    "place bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, offset bigint, ids binary"
)


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, spaces: bool, doc_id: str, text: str) -> DataFrame:
    """The ids of each text as little-endian 32-bit integers, stored; null texts are empty."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("place"),
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer, end_id, spaces)
        for batch in batches:
            for chunk in chunks(batch, "text", 4 << 20):
                ids, offsets = encoder.encode(chunk.column("text"))
                near = np.minimum.reduceat(mix(ids.astype(np.uint64) + np.uint64(1)) >> np.uint64(1), offsets[:-1])
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(chunk), [None, pa.py_buffer(4 * offsets), pa.py_buffer(ids.astype("<u4", copy=False))]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column("place"), chunk.column("doc_id"), pa.array(near.astype(np.int64)),
                        pa.array(np.diff(offsets), pa.int64()), raw.cast(pa.binary()),
                    ],
                    names=["place", "doc_id", "near", "n_tokens", "ids"],
                )

    path = shared_folder(docs.sparkSession, "packing")
    rows.mapInArrow(encode, TOKENS).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(TOKENS).parquet(path)


def document_frequencies(tokens: DataFrame) -> DataFrame:
    """(token, df) over all documents: at most as many rows as the vocabulary has ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(0, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                ids = np.unique(np.frombuffer(raw.as_buffer(), "<u4"))
                if len(ids) and ids[-1] >= len(df):
                    df = np.concatenate((df, np.zeros(int(ids[-1]) + 1 - len(df), np.int64)))
                df[ids] += 1
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(df[used], pa.int64())], names=["token", "df"])

    return tokens.select("ids").mapInArrow(count, "token bigint, df bigint").groupBy("token").agg(F.sum("df").alias("df"))


class _Index:
    """BM25 postings of one shard: for each of its tokens the documents and their weights."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, mean: float):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = np.concatenate(texts).astype(np.int64)
        doc = np.repeat(np.arange(len(texts)), sizes)
        pair, tf = np.unique(flat * len(texts) + doc, return_counts=True)
        self.n, token = len(texts), pair // len(texts)
        self.doc = pair % len(texts)
        self.weight = idf[token] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[self.doc] / mean))
        self.tokens, self.first = np.unique(token, return_index=True)
        self.first = np.append(self.first, len(pair))
        self.idf = idf

    def ranked(self, seed: np.ndarray) -> np.ndarray:
        """Documents that share one of the seed's rarest tokens, best first; equal scores in order."""
        tokens = np.unique(seed).astype(np.int64)
        at = np.searchsorted(self.tokens, tokens)
        at = at[self.first[at + 1] - self.first[at] > 1]  # tokens that another document has
        rare = at[np.argsort(-self.idf[self.tokens[at]], kind="stable")[:QUERY_TOKENS]]
        if not len(rare):
            return rare
        spans = [slice(self.first[i], self.first[i + 1]) for i in rare]
        docs = np.concatenate([self.doc[s] for s in spans])
        score = np.bincount(docs, np.concatenate([self.weight[s] for s in spans]), minlength=self.n)
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


class _Packer:
    """Fills windows; a document's piece is (document, start, length, sequence, offset)."""

    def __init__(self, window: int):
        self.window, self.sequence, self.filled, self.pieces = window, 0, 0, []

    def put(self, doc: tuple, start: int) -> int:
        """As much of the document from ``start`` on as fits; where it stopped."""
        length = min(self.window - self.filled, doc[2] - start)
        self.pieces.append((doc, start, length, self.sequence, self.filled))
        self.filled += length
        if self.filled == self.window:
            self.sequence, self.filled = self.sequence + 1, 0
        return start + length

    def split_last(self) -> None:
        """Cut the open window into sequences of powers of two."""
        if not self.filled:
            return
        last = [p for p in self.pieces if p[3] == self.sequence]
        del self.pieces[-len(last) :]
        ends, total = [], 0
        for bit in range(self.filled.bit_length() - 1, -1, -1):
            if self.filled >> bit & 1:
                total += 1 << bit
                ends.append(total)
        begin = 0
        for end in ends:
            for doc, start, length, _, offset in last:
                low, high = max(offset, begin), min(offset + length, end)
                if low < high:
                    self.pieces.append((doc, start + low - offset, high - low, self.sequence, low - begin))
            self.sequence, begin = self.sequence + 1, end
        self.filled = 0


def _pack_shard(packer: _Packer, docs: list[tuple], idf: np.ndarray, mean: float) -> None:
    """Pack all documents (place, doc_id, n, ids) of a shard into the packer's windows."""
    index = _Index([np.frombuffer(d[3], "<u4") for d in docs], idf, mean)
    unused = np.ones(len(docs), bool)
    following = 0
    queue: list[int] = []
    while True:
        while queue and not unused[queue[-1]]:
            queue.pop()
        if not queue:
            while following < len(docs) and not unused[following]:
                following += 1
            if following == len(docs):
                return
        chosen = queue.pop() if queue else following
        unused[chosen] = False
        doc, start = docs[chosen], 0
        opens = packer.filled == 0
        while start < doc[2]:
            before = packer.sequence
            start = packer.put(doc, start)
            opens |= packer.sequence != before and start < doc[2]
        # a document that opened a window seeds it; so does the rest of a cut one
        if opens or (not queue and packer.filled):
            ranked = index.ranked(np.frombuffer(doc[3], "<u4"))
            queue = ranked[unused[ranked]][::-1].tolist()


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    spaces: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per piece, with its ids; every id of every document lies in one piece.

    Null and empty texts have the end id only. Rows that repeat an id are packed each on
    their own. Other columns are left out. An empty table gives no pieces.
    """
    spark: SparkSession = docs.sparkSession
    tokens = tokenised(docs, tokenizer, end_id, spaces, doc_id, text)
    n_docs, n_tokens = tokens.agg(F.count(F.lit(1)), F.sum("n_tokens")).first()
    counted = document_frequencies(tokens).toPandas()  # bounded by the vocabulary
    idf = np.zeros(int(counted["token"].max()) + 1 if len(counted) else 1)
    idf[counted["token"]] = np.log1p((n_docs - counted["df"] + 0.5) / (counted["df"] + 0.5))
    mean = (n_tokens or 1) / max(1, n_docs)
    idf_of = spark.sparkContext.broadcast(idf)
    dealt = tokens.repartitionByRange("near", "place").sortWithinPartitions("near", "place")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer, idf, held, total = _Packer(window), idf_of.value, [], 0
        task = TaskContext.get().partitionId() << 32
        for batch in batches:
            for place, doc, n, ids in zip(*(batch.column(c) for c in ("place", "doc_id", "n_tokens", "ids")), strict=True):
                held.append((place.as_py(), doc.as_py(), n.as_py(), ids.as_py()))
                total += held[-1][2]
                if total >= shard_tokens:
                    _pack_shard(packer, held, idf, mean)
                    done = [p for p in packer.pieces if p[3] < packer.sequence]
                    packer.pieces = packer.pieces[len(done) :]
                    yield _rows(done, task)
                    held, total = [], 0
        if held:
            _pack_shard(packer, held, idf, mean)
        packer.split_last()
        yield _rows(packer.pieces, task)

    return dealt.select("place", "doc_id", "n_tokens", "ids").mapInArrow(fill, PIECES)


def _rows(pieces: list[tuple], task: int) -> pa.RecordBatch:
    parts = [doc[3][4 * start : 4 * (start + length)] for doc, start, length, _, _ in pieces]
    columns = {
        "place": [p[0][0] for p in pieces],
        "doc_id": [p[0][1] for p in pieces],
        "start": [p[1] for p in pieces],
        "length": [p[2] for p in pieces],
        "ids_crc32": [zlib.crc32(x) for x in parts],
        "doc_tokens": [p[0][2] for p in pieces],
        "sequence_id": [task + p[3] for p in pieces],
        "offset": [p[4] for p in pieces],
    }
    arrays = [pa.array(v, pa.int64()) for v in columns.values()]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(parts, pa.binary())], names=[*columns, "ids"])


def op6_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
