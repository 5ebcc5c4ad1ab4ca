"""Byte-level BPE of long texts by tree concatenation.

A long text is halved again and again; the leaves are encoded, and neighbours are joined level by
level up to the whole text. Around a join the last tokens of the left half and the first ones of the right
half form a window, whose text is encoded anew. The window grows until its first token is the left half's
and its last token is the right half's; then the left half's tokens before it, its own, and the right half's after it
are the tokens of both halves together. Texts beyond ``PART`` bytes are halved over tasks first; their parts
are encoded in parallel and meet again for the last joins.

Why this is exact. The pre-tokenizer cuts a text into runs of letters, of digits, of other marks and of
blanks, a blank going with the run after it, and BPE works inside each. (1) Between an ASCII letter or digit and an
ASCII byte of another class there is a cut in every text, and what lies before it and after it is encoded
independently; a window edge at such a place, or at an end of the two halves, is firm. (2) Inside a
run, a sequence of tokens is the BPE of its text exactly when every two neighbours are the BPE of theirs. An edge
inside a run leaves two neighbours as they were in their half where the window keeps the token at its edge. That an
edge lies inside a run is seen by its surroundings, which the pre-tokenizer must leave in one piece.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftspark.llm.common import chunks
from driftspark.llm.tokens import shared_encoder

LEAF = 2048  # bytes of the texts that are encoded at once
PART = 1 << 16  # bytes of a text that one task encodes
FIRST = 4  # tokens of the first window on each side
AROUND = 4  # characters to each side of an edge inside a run
DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
RESULT = "n_tokens bigint, ids array<int>, decoded string"

_CLASS = bytes(
    1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3 if chr(b).isspace() else 4 if b < 128 else 0 for b in range(128)
) + bytes(128)


def _firm(raw: bytes, at: int) -> bool:
    """Whether every text is cut here, whatever surrounds the two bytes."""
    before, after = _CLASS[raw[at - 1]], _CLASS[raw[at]]
    return before in (1, 2) and after != 0 and before != after


def halves(raw: bytes, most: int) -> list[tuple[int, int]]:
    """The leaves of a binary tree over the text: 2^n spans of whole characters, about equally long
    and of at most ``most`` bytes, but for the character at a border."""
    n = 1
    while len(raw) > n * most:
        n *= 2
    cuts = []
    for i in range(n + 1):
        at = len(raw) * i // n
        while 0 < at < len(raw) and raw[at] & 0xC0 == 0x80:
            at -= 1
        cuts.append(at)
    return list(zip(cuts, cuts[1:]))


class TreeEncoder:
    def __init__(self, path: str, leaf: int = LEAF):
        self.leaves, self.leaf = shared_encoder(path, 0, True), max(leaf, 4)
        self.tokenizer = self.leaves.tokenizer
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.added = {t.content.encode(): i for i, t in added.items()}
        self.apart = re.compile(b"|".join(sorted(map(re.escape, self.added), key=len, reverse=True)) or b"(?!)")
        # Printable bytes stand for themselves in the vocabulary, the others for 256 and on, in order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        tokens |= {i: t for t, i in self.added.items()}
        listed = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.sizes = list(map(len, listed))
        self.size = np.array(self.sizes)
        self.first_byte = np.cumsum(self.size) - self.size
        self.all_bytes = np.frombuffer(b"".join(listed), np.uint8)
        self.names = list(map(str, range(len(listed))))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Strings of added tokens are cut out first, as the library does."""
        pieces: list[bytes] = []
        plans: list[list[tuple[int, int]]] = []  # for each text: (piece, -1) or (-1, id of an added token)
        for text in texts:
            raw, at, plan = text.encode(), 0, []
            for match in self.apart.finditer(raw):
                plan += [(len(pieces), -1), (-1, self.added[match.group()])]
                pieces.append(raw[at : match.start()])
                at = match.end()
            plan.append((len(pieces), -1))
            pieces.append(raw[at:])
            plans.append(plan)
        spans = [halves(p, self.leaf) for p in pieces]
        ids = self._leaves([p[a:b].decode() for p, cuts in zip(pieces, spans, strict=True) for a, b in cuts])
        parts, at = [], 0
        for cuts in spans:
            parts.append(ids[at : at + len(cuts)])
            at += len(cuts)
        whole = self.joined(pieces, spans, parts)
        return [
            whole[plan[0][0]] if len(plan) == 1
            else np.concatenate([whole[p] if p >= 0 else np.array([i], np.uint32) for p, i in plan])
            for plan in plans
        ]

    def _leaves(self, texts: list[str]) -> list[np.ndarray]:
        ids, offsets = self.leaves.encode(texts)
        return [ids[a : b - 1] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]  # without the end id

    def joined(self, texts: list[bytes], spans: list[list[tuple[int, int]]], ids: list[list[np.ndarray]]) -> list[np.ndarray]:
        """The ids of each text from the ids of its spans, of which it has a power of two."""
        spans, ids = [list(s) for s in spans], [list(i) for i in ids]
        while any(len(s) > 1 for s in spans):
            joins = [(t, k) for t, s in enumerate(spans) for k in range(0, len(s) - 1, 2)]
            made = self._join_all([(texts[t], spans[t][k], spans[t][k + 1], ids[t][k], ids[t][k + 1]) for t, k in joins])
            result = dict(zip(joins, made, strict=True))
            for t, s in enumerate(spans):
                if len(s) > 1:
                    ids[t] = [result[t, k] for k in range(0, len(s) - 1, 2)]
                    spans[t] = [(s[k][0], s[k + 1][1]) for k in range(0, len(s) - 1, 2)]
        return [i[0] for i in ids]

    def _join_all(self, joins: list[tuple]) -> list[np.ndarray]:
        made: list = [None] * len(joins)
        waiting, k = list(range(len(joins))), FIRST
        while waiting:
            windows = []
            for n in waiting:
                raw, (low, join), (_, high), a, b = joins[n]
                left = self._edge(raw, a[::-1][: 4 * k].tolist(), join, low, k, -1)
                right = self._edge(raw, b[: 4 * k].tolist(), join, high, k, 1)
                windows.append((left, right))
            whole = [w for w in zip(waiting, windows, strict=True) if w[1][0] and w[1][1]]
            texts = [joins[n][0][left[1] : right[1]].decode() for n, (left, right) in whole]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            for (n, ((i, s), (j, e))), encoding in zip(whole, found, strict=True):
                raw, (low, _), (_, high), a, b = joins[n]
                middle = encoding.ids
                agrees = (s == low or (middle and middle[0] == a[len(a) - i])) and (e == high or (middle and middle[-1] == b[j - 1]))
                if agrees:
                    made[n] = np.concatenate((a[: len(a) - i], np.array(middle, np.uint32), b[j:]))
            waiting = [n for n in waiting if made[n] is None]
            k *= 2
        return made

    def _edge(self, raw: bytes, ids: list[int], join: int, end: int, k: int, step: int) -> tuple[int, int] | None:
        """How many tokens from the join on, and where they end: at least k, up to a firm place or to the
        end of the half; else, where 4 k tokens have none, to a place inside a run. None where there is neither."""
        at = join
        for n, token in enumerate(ids, 1):
            at += step * self.sizes[token]
            if at == end:
                return n, end
            if n >= k and _firm(raw, at):
                return n, at
        if not ids or len(ids) < 4 * k:
            return len(ids), end  # an empty half
        return (len(ids), at) if raw[at] & 0xC0 != 0x80 and self._inside_run(raw, at) else None

    def _inside_run(self, raw: bytes, at: int) -> bool:
        low, high = max(0, at - 4 * AROUND), at + 4 * AROUND
        before = raw[low:at].decode(errors="ignore")[-AROUND:]
        after = raw[at:high].decode(errors="ignore")[:AROUND]
        return len(before) == len(after) == AROUND and len(self.tokenizer.pre_tokenizer.pre_tokenize_str(before + after)) == 1

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each sequence of ids."""
        flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int64)
        sizes = self.size[flat]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.all_bytes[np.arange(total) + np.repeat(self.first_byte[flat] - ends + sizes, sizes)].tobytes()
        borders = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int64)].tolist()
        return [raw[a:b] for a, b in zip(borders, borders[1:])]

    def rows(self, doc_ids: pa.Array, ids: list[np.ndarray], digests: bool) -> pa.RecordBatch:
        """The result rows; what is decoded is decoded from the ids."""
        decoded = [raw.decode("utf-8", "replace") for raw in self.decode(ids)]
        n = pa.array([len(i) for i in ids], pa.int64())
        if digests:
            lines = [",".join(map(self.names.__getitem__, i.tolist())) for i in ids]
            columns = [pa.array([hashlib.sha256(x.encode()).hexdigest() for x in side]) for side in (lines, decoded)]
        else:
            columns = [pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
        names = [x.split()[0] for x in (DIGESTS if digests else RESULT).split(", ")]
        columns = [c.cast(pa.string()) if c.type == pa.null() else c for c in columns]
        return pa.RecordBatch.from_arrays([doc_ids, n, *columns], names=["doc_id", *names])


@cache
def tree_encoder(path: str, leaf: int) -> TreeEncoder:
    """The one encoder of this worker process."""
    return TreeEncoder(path, leaf)


def encode_and_decode(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    digests: bool = False,
    leaf: int = LEAF,
    part: int = PART,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, and the ids and the text decoded from them; with
    ``digests`` their SHA-256 instead (of the decimal ids joined by commas, and of the decoded text).

    ``tokenizer`` is a byte-level BPE file of the ``tokenizers`` library; ids and decoded texts are those of
    its ``encode`` without added special tokens and its ``decode``; strings of special tokens in a text become
    their ids. Null and empty texts have no ids and decode to an empty text. Repeated rows count each on their
    own. Other columns are left out. An empty table gives no rows. A text of any length is encoded whole.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    ).withColumn("row", F.monotonically_increasing_id())
    schema = f"doc_id bigint, {DIGESTS if digests else RESULT}"

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tree_encoder(tokenizer, leaf)
        for batch in batches:
            for chunk in chunks(batch, "text", 4 << 20):
                yield encoder.rows(chunk.column("doc_id"), encoder.encode(chunk.column("text").to_pylist()), digests)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tree_encoder(tokenizer, leaf)
        for batch in batches:
            for row, doc, value in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True):
                raw = value.encode()
                # a cut could hit the string of an added token: such a text stays in one task
                spans = [(0, len(raw))] if encoder.apart.search(raw) else halves(raw, part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row] * len(spans), pa.int64()), pa.array([doc] * len(spans), pa.int64()),
                        pa.array(range(len(spans)), pa.int64()), pa.array([raw[a:b].decode() for a, b in spans], pa.string()),
                    ],
                    names=["row", "doc_id", "part", "text"],
                )

    def encode_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tree_encoder(tokenizer, leaf)
        for batch in batches:
            for chunk in chunks(batch, "text", 4 << 20):
                ids = [i.astype("<u4").tobytes() for i in encoder.encode(chunk.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([*chunk.columns, pa.array(ids, pa.binary())], names=[*chunk.schema.names, "ids"])

    def join_parts(table: pa.Table) -> pa.Table:
        encoder = tree_encoder(tokenizer, leaf)
        table = table.sort_by("part")
        texts = [x.encode() for x in table.column("text").to_pylist()]
        ends = np.cumsum([len(x) for x in texts]).tolist()
        ids = [np.frombuffer(x, "<u4") for x in table.column("ids").to_pylist()]
        whole = encoder.joined([b"".join(texts)], [list(zip([0, *ends], ends))], [ids])
        return pa.Table.from_batches([encoder.rows(table.column("doc_id").combine_chunks()[:1], whole, digests)])

    size = F.octet_length("text")
    done = rows.where(size <= part).select("doc_id", "text").mapInArrow(short, schema)
    parts = rows.where(size > part).mapInArrow(cut, "row bigint, doc_id bigint, part bigint, text string")
    parts = parts.repartition("row", "part").mapInArrow(encode_parts, "row bigint, doc_id bigint, part bigint, text string, ids binary")
    return done.unionByName(parts.groupBy("row").applyInArrow(join_parts, schema))


def op11_tree_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_and_decode(docs, public_tokenizers.path("byte_bpe_50k.json"), digests=True)
