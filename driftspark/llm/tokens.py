"""Token ids of many texts by a tokenizer file of the ``tokenizers`` library.

Each text is cut into pieces at single spaces and line feeds and before a closing mark
after a letter, and each different piece is encoded once. This gives the ids of the whole
text where no pre-token crosses such a cut. Byte-level BPE keeps a space with what follows
it, so a piece is encoded with its space; there a blank next to another blank could be
part of a longer run of blanks, and such a text is encoded whole. Word BPE drops blanks
and case. Texts that could hold a special token are encoded whole as well.

Pieces are known by 64-bit hashes of their bytes.
"""

from __future__ import annotations

import os
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa

from driftspark.llm.words import hash_spans, mix, text_bytes, words_of

_BYTES = np.arange(256)
_PIECE = (_BYTES != 32) & (_BYTES != 10)
_LETTER = ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122))
_MARK = (_BYTES == ord(".")) | (_BYTES == ord(","))
_ALONE = np.uint64(0x51ED270B9F3A7C15)  # set apart the hashes of pieces without a space before them
KEEP = 600_000  # pieces known at once


class Encoder:
    """``spaces``: a space belongs to the piece that follows it (byte-level BPE)."""

    def __init__(self, path: str, end_id: int, spaces: bool, keep: int = KEEP):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.spaces, self.keep = Tokenizer.from_file(path), spaces, keep
        self.lead = " " if spaces else ""
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():  # each character of a token stands for a byte
            self.bytes_of[number] = len(token.removesuffix("</w>"))
        fixed = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in ("\n", ".", ",")]
        self.fixed = [np.array(x, np.uint32) for x in ([end_id], *fixed)]  # numbers 0 to 3
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)  # by place in ``hashes``: used again since it was learnt or kept
        self.values = np.concatenate(self.fixed)
        self.lengths = np.array([len(x) for x in self.fixed], np.int64)

    def _store(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        start = len(self.lengths)
        self.lengths = np.concatenate((self.lengths, lengths))
        self.values = np.concatenate((self.values, ids))
        return start

    def _learn(self, texts: list[str]) -> int:
        """Encode texts one by one; the number of the first of them."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return self._store(np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths)

    def _learn_joined(self, pieces: list[str]) -> int:
        """Encode pieces that end where a token ends, many in one text; the bytes of each token tell which are
        whose. The pieces have characters below U+0130 only, whose bytes no normaliser here counts otherwise."""
        start = len(self.lengths)
        found: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        for i in range(0, len(pieces), 512):
            part = pieces[i : i + 512]
            ids = np.array(self.tokenizer.encode(" " + " ".join(part), add_special_tokens=False).ids, np.int64)
            ends = np.cumsum(self.bytes_of[ids])
            sizes = np.cumsum(np.fromiter((len(p.encode()) for p in part), np.int64, len(part)) + self.spaces)
            last = np.searchsorted(ends, sizes)
            if len(ids) and ends[-1] == sizes[-1] and (ends[last] == sizes).all():
                found.append(ids.astype(np.uint32))
                lengths.append(np.diff(last, prepend=-1))
            else:
                one_by_one = [self.tokenizer.encode(self.lead + p, add_special_tokens=False).ids for p in part]
                found.append(np.array(list(chain.from_iterable(one_by_one)), np.uint32))
                lengths.append(np.array(list(map(len, one_by_one)), np.int64))
        if pieces:
            self._store(np.concatenate(found), np.concatenate(lengths))
        return start

    def _learn_pieces(self, pieces: list[str], alone: np.ndarray) -> np.ndarray:
        """Numbers of new pieces; -1 where a text with the piece is encoded whole."""
        out = np.full(len(pieces), -1, np.int64)
        joined, single, bare = [], [], []
        for i, (p, is_alone) in enumerate(zip(pieces, alone.tolist(), strict=True)):
            if "<|" in p or (self.spaces and (p[0].isspace() or p[-1].isspace())):
                continue
            if is_alone:
                bare.append(i)
            elif p.isprintable() and (p.isascii() or max(p) < "İ"):
                joined.append(i)
            else:
                single.append(i)
        out[joined] = self._learn_joined([pieces[i] for i in joined]) + np.arange(len(joined))
        for places, lead in ((single, self.lead), (bare, "")):
            if places:
                out[places] = self._learn([lead + pieces[i] for i in places]) + np.arange(len(places))
        return out

    def _numbers(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, alone: np.ndarray) -> np.ndarray:
        """The number of each piece."""
        hashes = hash_spans(data, starts, lengths)
        hashes[alone] = mix(hashes[alone] ^ _ALONE)
        different, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > self.keep:
            self._keep_used()
        known, numbers = np.zeros(len(different), bool), np.full(len(different), -1, np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, different), len(self.hashes) - 1)
            known = self.hashes[at] == different
            numbers[known] = self.numbers[at[known]]
            self.again[at[known]] = True
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            spans = zip(starts[first[new]].tolist(), (starts + lengths)[first[new]].tolist(), strict=True)
            numbers[new] = self._learn_pieces([raw[a:b].decode() for a, b in spans], alone[first[new]])
            merged = np.concatenate((self.hashes, different[new]))
            order = np.argsort(merged, kind="stable")  # two sorted stretches: one merge
            self.hashes, self.numbers = merged[order], np.concatenate((self.numbers, numbers[new]))[order]
            self.again = np.concatenate((self.again, np.zeros(len(new), bool)))[order]
        return numbers[inverse]

    def _keep_used(self) -> None:
        """Forget the pieces that were not used again; all of them where most were."""
        kept = self.again & (self.numbers >= 0)
        if 2 * kept.sum() > self.keep:
            kept[:] = False
        hashes, numbers = self.hashes[kept], self.numbers[kept]
        lengths, values = self.lengths[numbers], self._joined(numbers)
        self._forget()
        self.numbers = self._store(values, lengths) + np.arange(len(hashes))
        self.hashes, self.again = hashes, np.zeros(len(hashes), bool)

    def _joined(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of a sequence of pieces."""
        if not len(numbers):
            return self.values[:0]
        lengths = self.lengths[numbers]
        starts = np.cumsum(self.lengths) - self.lengths
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) - np.repeat(ends - lengths - starts[numbers], lengths)
        return self.values[at]

    def encode(self, column: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids (32 bit, unsigned) of the texts, each with the end id, and the offsets of the texts. Null is empty."""
        column = pa.array(column, pa.string()) if isinstance(column, list) else column
        n = len(column)
        words = words_of(column, _PIECE, lower=not self.spaces, hashed=False)
        data, starts = words.data, words.starts
        counts = np.diff(words.offsets)
        text = np.repeat(np.arange(n), counts)
        last = starts + words.lengths - 1
        marked = _MARK[data[last]] & (words.lengths > 1)
        marked[marked] = _LETTER[data[last[marked] - 1]]
        head = np.zeros(len(starts), bool)  # first piece of its text
        head[words.offsets[:-1][counts > 0]] = True
        fed = ~head & (data[np.maximum(starts - 1, 0)] == 10)  # follows a line feed
        alone = (head | fed) & self.spaces
        cores = self._numbers(data, starts, words.lengths - marked, alone)
        whole = np.zeros(n, bool)
        whole[text[cores < 0]] = True
        if self.spaces:  # a blank at an end or next to a blank
            raw, offsets = text_bytes(column)
            blanks = np.concatenate(([0], np.cumsum(~_PIECE[raw])))[offsets]
            whole |= counts != np.diff(blanks) + 1
        else:
            fed[:] = False
        at_whole = np.flatnonzero(whole)
        stays = ~whole[text]
        text, cores, marked, fed, last = text[stays], cores[stays], marked[stays], fed[stays], last[stays]
        size = 1 + fed.astype(np.int64) + marked
        per_text = np.bincount(text, size, minlength=n).astype(np.int64) + whole + 1
        ends = np.concatenate(([0], np.cumsum(per_text)))
        numbers = np.zeros(ends[-1], np.int64)  # 0 is the end id
        if len(at_whole):
            numbers[ends[:-1][at_whole]] = self._learn([column[int(i)].as_py() or "" for i in at_whole]) + np.arange(len(at_whole))
        earlier = np.cumsum(per_text) - per_text - (np.cumsum(np.bincount(text, size, minlength=n)) - np.bincount(text, size, minlength=n))
        place = np.cumsum(size) - size + earlier.astype(np.int64)[text]
        numbers[place[fed]] = 1
        numbers[place + fed] = cores
        numbers[(place + fed + 1)[marked]] = np.where(data[last[marked]] == ord("."), 2, 3)
        return self._joined(numbers), np.concatenate(([0], np.cumsum(self.lengths[numbers])))[ends]


@cache
def shared_encoder(path: str, end_id: int, spaces: bool) -> Encoder:
    """The one encoder of this process: what a task has learnt serves the next one of its worker."""
    return Encoder(path, end_id, spaces)
