"""Exact similarity join on sets of word shingles, by set relations.

The method has two parts. *Answers from similar sets*: a set that is linked to a leader is attached to
it with its distance, and is not searched for on its own: it only adds its rarest shingles to the
leader's. What the leader is linked to answers for its members. As the Jaccard distance is a metric, sets attached
to leaders A and B can only be linked where d(A, B) <= t + r(A) + r(B), with t the largest linked distance and r the
largest distance of an attached set; only where that leaves an answer open, and the two are not
connected yet, are members compared. Answers also grow step by step: a leader is first compared with
a neighbour in each of its lists only, and pairs that are connected by then are not formed any more.
*Skipping in the index*: the rarest shingles of the leaders' sets are index lists, sorted by set
size and cut into blocks. A block is skipped by an entry where the sizes in the block, or the shingles that are left
behind the entries' positions, cannot give the needed overlap; single entries are then tested likewise. A
pair that is left is ruled out next where the counts of both sets in the parts of the hash range differ too much; a
long set has more parts.
Pairs travel by *cells*, the pairs between two blocks of sets that share lists: a cell is one row with all its pairs,
and a set comes to it once, whatever the number of its pairs there. What a cell has connected is not compared again.

Leaders and index are only ways to find links: two linked sets share one of the shingles that each of them has
put into the lists, so every link between different sets is found whatever the leaders are. Sets are counted and
compared by 64-bit hashes; index entries have the first 40 bits, which only add candidates.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftspark.llm.common import chunks, most_frequent, stored, stored_in_groups
from driftspark.llm.components import merged
from driftspark.llm.words import UNBLANK, mix, rolling, words_of

LEADERS = (
    "row bigint, leader bigint, distance double, n bigint, least bigint, most bigint, radius double, "
    "tokens array<bigint>, places array<int>, spread binary"
)
MARKS = 1 << 24  # parts of the range of min-hashes
HELD = 1 << 20  # list entries of one leader, from which on a new one takes over
ROUNDS = 2  # in which only neighbours of lists are compared, before all pairs
LISTS = 8  # every so many-th list is looked at in such a round
ORDERS = 4  # of a round's lists
BLOCK = 64  # entries of a list that are skipped together
TRIED = 8  # leaders a set is compared with; only the number of leaders depends on it
HOT = 1 << 20  # shingles counted as frequent; only the order of shingles depends on it
BROADCAST_ROWS = 500_000  # of 24 bytes
BLOCK_SETS = 256  # in a block of sets, about
BLOCK_SHINGLES = 1 << 17  # of its sets, about
CELLS = "c bigint, d bigint, a array<bigint>, b array<bigint>, u array<bigint>, v array<bigint>, far array<double>"
SETS = "row bigint, doc_id bigint, n bigint, near bigint, shingles binary"
_DROPPED = np.uint64(24)  # bits of a hash that index entries leave out
PARTS = 32  # of the range of hashes, at least, for the counts that rule pairs out
PART_SHINGLES = 2  # of a set in a part, at most, on average: with fixed parts, counts cannot tell long sets apart
CELL_PAIRS = 1 << 18  # in a batch of cells, about
ROW_GROUP = 4 << 20  # bytes; a task holds the row group of the sets that it reads


def _packed(hashes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Sets of 64-bit numbers as binary values."""
    raw = np.ascontiguousarray(hashes.astype("<u8", copy=False))
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(8 * offsets.astype(np.int64)), pa.py_buffer(raw)]
    ).cast(pa.binary())


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u8")


def _sets(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different hashes of each text, and how many."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, doc))
    doc, keys = doc[order], hashes[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    return keys[new], np.bincount(doc[new], minlength=len(offsets) - 1)


def shingle_sets(docs: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One stored row per document: its sorted set of k-word shingles and that set's min-hash."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "text", 1 << 20):
                hashes, offsets = rolling(words_of(chunk.column("text"), UNBLANK), k)
                keys, counts = _sets(hashes, offsets)
                offsets = np.concatenate(([0], np.cumsum(counts)))
                near = np.zeros(len(chunk), np.int64)
                some = counts > 0
                if some.any():
                    low = np.minimum.reduceat(mix(keys) >> np.uint64(1), offsets[:-1][some])
                    near[some] = low.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("row"), chunk.column("doc_id"), pa.array(counts, pa.int64()), pa.array(near), _packed(keys, offsets)],
                    names=["row", "doc_id", "n", "near", "shingles"],
                )

    return stored_in_groups(rows.mapInArrow(cut, SETS), "sets", ROW_GROUP)


def frequent_shingles(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ``HOT`` most frequent shingles, as far as chunks of sets show them, and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch, "shingles", 8 << 20):
                flat = np.concatenate([_unpacked(r.as_buffer()) for r in chunk.column("shingles")] or [np.zeros(0, np.uint64)])
                flat >>= _DROPPED
                flat.sort()
                first = np.flatnonzero(np.concatenate((flat[:1] == flat[:1], flat[1:] != flat[:-1])))
                shingle, n = flat[first], np.diff(first, append=len(flat))
                often = n >= 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle[often].astype(np.int64)), pa.array(n[often])], names=["shingle", "n"]
                )

    found = sets.where("n > 0").select("shingles").mapInArrow(count, "shingle bigint, n bigint")
    counts = stored(found.groupBy("shingle").agg(F.sum("n").alias("n")).where("n >= 4"), "shingles")
    top = most_frequent(counts, HOT).toPandas().sort_values("shingle")
    return top["shingle"].to_numpy(np.uint64), top["n"].to_numpy(np.uint64)


def _shared_marks(sets: DataFrame) -> bytes:
    """A bit for each part of the min-hashes' range that two sets fall into: at most ``MARKS / 8`` bytes.
    A set without its bit shares its min-hash with no other."""
    mark = F.pmod(F.col("near"), F.lit(MARKS))
    twice = sets.where("n > 0").groupBy(mark.alias("mark")).count().where("count > 1")
    word = F.shiftright("mark", 5)
    words = twice.groupBy(word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(mark & 31 AS int))")).alias("bits"))
    out = np.zeros(MARKS // 32, "<u4")
    found = words.toPandas()
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    return out.tobytes()


class _Leader:
    """A set with the sets attached to it; ``tokens`` are the list entries of all of them."""

    def __init__(self, row: int, values: np.ndarray, tokens: np.ndarray):
        self.row, self.values, self.radius = row, values, 0.0
        self.least = self.most = len(values)
        self.tokens, self.places = [tokens], [np.arange(len(tokens))]
        self.held = len(tokens)

    def attach(self, values: np.ndarray, tokens: np.ndarray, distance: float) -> None:
        self.radius = max(self.radius, distance)
        self.least, self.most = min(self.least, len(values)), max(self.most, len(values))
        if distance:
            self.tokens.append(tokens)
            self.places.append(np.arange(len(tokens)))
            self.held += len(tokens)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and their least places, rarest first."""
        tokens, places = np.concatenate(self.tokens), np.concatenate(self.places)
        order = np.lexsort((places, tokens))
        tokens, places = tokens[order], places[order]
        new = np.ones(len(tokens), bool)
        new[1:] = tokens[1:] != tokens[:-1]
        tokens, places = tokens[new], places[new]
        order = np.argsort(places, kind="stable")
        return tokens[order], places[order]


def _spread(values: np.ndarray) -> bytes:
    """How many of the set's hashes lie in each part of their range, at most 15, two counts to a byte.
    The number of parts is a power of two that grows with the set."""
    bits = max(PARTS.bit_length() - 1, (max(0, len(values) - 1) // PART_SHINGLES).bit_length())
    counts = np.bincount((values >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    counts = np.minimum(counts, 15).astype(np.uint8)
    return (counts[::2] | counts[1::2] << 4).tobytes()


def _differing(spreads: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each pair (i, j) of sets a number of hashes that at least differ, by their spreads. Of two spreads
    the finer one is folded to the parts of the other."""
    size = np.array([len(x) for x in spreads], np.int64)
    least, out = np.minimum(size[i], size[j]), np.zeros(len(i), np.int64)
    for parts in np.unique(least).tolist():  # bytes: half the number of parts
        of = np.flatnonzero(least == parts)
        used, at = np.unique(np.concatenate((i[of], j[of])), return_inverse=True)
        counts = np.empty((len(used), 2 * parts), np.int32)
        for row, which in enumerate(used.tolist()):
            raw = spreads[which]
            counts[row] = np.stack((raw & 15, raw >> 4), 1).reshape(2 * parts, -1).sum(1, dtype=np.int32)
        step = max(1, (1 << 18) // parts)
        for x in range(0, len(of), step):
            a, b = at[x : x + step][: len(of) - x], at[len(of) + x : len(of) + x + step]
            out[of[x : x + step]] = np.abs(counts[a] - counts[b]).sum(1)
    return out


def _distance(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and the union."""
    merged = np.concatenate((a, b))
    merged.sort()
    common = int((merged[1:] == merged[:-1]).sum())
    return common, len(merged) - common


def _nearest(active: deque[_Leader], values: np.ndarray, linked: Fraction) -> tuple[_Leader | None, float]:
    """The latest leader that the set is linked to, and the distance."""
    for leader in reversed(active):
        if len(leader.values) < (1 - linked) * len(values):
            break  # sets come by size: earlier leaders are smaller still
        common, union = _distance(leader.values, values)
        if union - common <= linked * union:
            return leader, (union - common) / union
    return None, 0.0


def _leaders(sets: DataFrame, linked: Fraction) -> DataFrame:
    """One stored row per set that is not empty: (row, leader, distance), and for a leader what its list
    entries need.

    Sets that may share their min-hash come in order of (min-hash, size), so almost equal ones
    meet; the others stay where they are. A range of a hot min-hash is cut between tasks, which makes more
    leaders and nothing else.
    """
    context = sets.sparkSession.sparkContext
    frequent, marks = context.broadcast(frequent_shingles(sets)), context.broadcast(_shared_marks(sets))

    def prefix(values: np.ndarray) -> np.ndarray:
        """The set's rarest shingles: two linked sets share one of them."""
        hot, times = frequent.value
        short = values >> _DROPPED
        at = np.minimum(np.searchsorted(hot, short), max(0, len(hot) - 1))
        order = short.copy()
        if len(hot):
            order += np.where(hot[at] == short, np.minimum(times[at], np.uint64(1 << 22)), np.uint64(0)) << np.uint64(40)
        length = len(values) - int(np.ceil(float(1 - linked) * len(values) - 1e-9)) + 1
        if length < len(order):
            order = np.partition(order, length - 1)[:length]
        order.sort()
        return (order & np.uint64((1 << 40) - 1)).astype(np.int64)

    def finish(leader: _Leader) -> tuple:
        tokens, places = leader.entries()
        return (
            leader.row, leader.row, 0.0, len(leader.values), leader.least, leader.most, leader.radius,
            tokens, places.astype(np.int32), _spread(leader.values),
        )

    def marked(batch: pa.RecordBatch) -> np.ndarray:
        near = batch.column("near").to_numpy(zero_copy_only=False) % MARKS
        bits = np.frombuffer(marks.value, "<u4")
        return (bits[near >> 5] >> (near & 31).astype(np.uint32) & np.uint32(1)).astype(bool)

    def keep_marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marked(batch)))

    def lead_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch, out = batch.filter(pa.array(~marked(batch))), []
            for row, raw in zip(batch.column("row").to_pylist(), batch.column("shingles"), strict=True):
                values = _unpacked(raw.as_buffer())
                out.append(finish(_Leader(row, values, prefix(values))))
                if len(out) > 2000:
                    yield _leader_rows(out)
                    out = []
            yield _leader_rows(out)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        active: deque[_Leader] = deque()
        out: list[tuple] = []
        last = None
        for batch in batches:
            for row, near, raw in zip(batch.column("row").to_pylist(), batch.column("near").to_pylist(), batch.column("shingles"), strict=True):
                values = _unpacked(raw.as_buffer())
                if near != last:
                    while active:
                        out.append(finish(active.popleft()))
                    last = near
                leader, distance = _nearest(active, values, linked)
                if leader:
                    leader.attach(values, prefix(values) if distance else values[:0], distance)
                    out.append((row, leader.row, distance, len(values), None, None, 0.0, None, None, None))
                    if leader.held > HELD:
                        active.remove(leader)
                        out.append(finish(leader))
                else:
                    active.append(_Leader(row, values, prefix(values)))
                    if len(active) > TRIED:
                        out.append(finish(active.popleft()))
                if len(out) > 2000:
                    yield _leader_rows(out)
                    out = []
        out += [finish(leader) for leader in active]
        yield _leader_rows(out)

    some = sets.where("n > 0").select("row", "near", "n", "shingles")
    met = some.mapInArrow(keep_marked, some.schema).repartitionByRange("near", "n", "row").sortWithinPartitions("near", "n", "row")
    found = some.mapInArrow(lead_alone, LEADERS).unionByName(met.mapInArrow(lead, LEADERS))
    return stored(found, "leaders")


def _leader_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [
        pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(),
        pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(),
    ]
    names = [field.split()[0] for field in LEADERS.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _blocks(leaders: DataFrame) -> DataFrame:
    """One stored row per set that may be compared: (row, leader, distance, block). Sets whose leaders meet the same
    leader first in some of the lists are in one block, cut by a hash where it is large. Only the cost of bringing
    pairs together depends on it."""
    entries = leaders.where("row = leader").select("row", F.explode("tokens").alias("token"))
    entries = entries.where(F.pmod(F.xxhash64("token"), F.lit(LISTS)) == 0)
    lists = entries.repartition("token").sortWithinPartitions("token", "row")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = low = None
        for batch in batches:
            row, token = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "token"))
            if not len(row):
                continue
            new = np.concatenate(([token[0] != last], token[1:] != token[:-1]))
            start = np.maximum.accumulate(np.where(new, np.arange(len(row)), -1))
            lows = np.where(start >= 0, row[start], 0 if low is None else low)
            last, low = token[-1], lows[-1]
            later = lows != row
            yield pa.RecordBatch.from_arrays([pa.array(row[later]), pa.array(lows[later])], names=["leader", "low"])

    lowest = lists.mapInArrow(first, "leader bigint, low bigint").groupBy("leader").agg(F.min("low").alias("low"))
    sets = leaders.where("row = leader OR distance > 0").select("row", "leader", "distance", "n")
    sets = sets.join(lowest, "leader", "left").withColumn("low", F.coalesce("low", "leader"))
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES))
    large = sets.groupBy("low").agg(parts.alias("parts")).where("parts > 1")
    cut = F.xxhash64("low", F.pmod(F.xxhash64("row"), F.col("parts")))
    block = F.when(F.col("parts").isNull(), F.col("low")).otherwise(cut)
    return stored(sets.join(large, "low", "left").select("row", "leader", "distance", block.alias("block")), "blocks")


def _candidates(leaders: DataFrame, blocks: DataFrame, linked: Fraction, groups: DataFrame | None, nearby: int) -> DataFrame:
    """Cells of the pairs of leaders that share a list entry, may hold linked sets and are not in one
    component of ``groups``. A number above 0 asks only for neighbours in some of the lists, in an order that this
    number and the token make, and for links of the leaders themselves: each list then gives fewer pairs than it has entries.
    """
    listed = F.arrays_zip(F.col("tokens").alias("token"), F.col("places").alias("place"))
    if nearby:  # a part of the lists is enough to connect most of what is linked; only it meets the blocks
        listed = F.filter(listed, lambda x: F.pmod(F.xxhash64(x["token"]), F.lit(LISTS)) == nearby % LISTS)
    own = leaders.where("row = leader").select("row", "least", "most", listed.alias("listed"))
    where = blocks.where("row = leader").select("row", "block")
    if groups is None:
        where = where.withColumn("root", F.col("row"))
    else:
        where = where.join(groups.select(F.col("node").alias("row"), "root"), "row", "left")
        where = where.withColumn("root", F.coalesce("root", "row"))
    where = F.broadcast(where) if where.count() <= BROADCAST_ROWS else where
    entries = own.join(where, "row").select("row", "root", "least", "most", "block", F.inline("listed"))
    columns = ["token", "row", "root", "least", "most", "place", "block"]
    order = F.xxhash64("row", F.lit(nearby), F.pmod(F.col("token"), F.lit(ORDERS))) if nearby else F.col("least")
    lists = entries.repartition("token").sortWithinPartitions("token", order, "row").select(*columns)
    similar = float(1 - linked)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]
            kept = now if kept is None else [np.concatenate(x) for x in zip(kept, now, strict=True)]
            whole = int(np.searchsorted(kept[0], kept[0][-1])) if len(kept[0]) else 0  # the last list may go on
            yield from _listed_pairs(*[x[:whole] for x in kept], similar, nearby > 0)
            kept = [x[whole:] for x in kept]
        if kept is not None:
            yield from _listed_pairs(*kept, similar, nearby > 0)

    found = lists.mapInArrow(search, "c bigint, d bigint, a array<bigint>, b array<bigint>")
    met = found.repartition("c", "d").sortWithinPartitions("c", "d").mapInArrow(_once, CELLS)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sets differ at least by what their counts in the parts of the hash range differ."""
        left: tuple[list, ...] = ([], [], [], [])
        held = 0
        for key, pairs, known in _brought(batches):
            rows = np.array(sorted(known), np.int64)
            n, radius = (np.array([known[r][x] for r in rows.tolist()]) for x in (0, 1))
            spreads = [np.frombuffer(known[r][2], np.uint8) for r in rows.tolist()]
            i, j = (np.searchsorted(rows, pairs[side]) for side in ("a", "b"))
            differ = _differing(spreads, i, j)
            far = float(linked) + (0 if nearby else radius[i] + radius[j]) + np.full(len(i), 1e-9)
            fits = differ <= far * (n[i] + n[j]) / (2 - far)
            if fits.any():
                for x, y in zip(left, (key, pairs["a"][fits], pairs["b"][fits], far[fits]), strict=True):
                    x.append(y)
                held += int(fits.sum())
            if len(left[0]) >= 500 or held >= CELL_PAIRS:
                yield _cell_rows(*left)
                left, held = ([], [], [], []), 0
        yield _cell_rows(*left)

    cells = stored(met, "met")
    facts = leaders.where("row = leader").select("row", "n", "radius", F.col("spread").alias("value"))
    return _meeting(cells, facts).mapInArrow(sift, CELLS)


def _cell_rows(keys: list[tuple[int, int]], a: list[np.ndarray], b: list[np.ndarray], far: list[np.ndarray] | None = None) -> pa.RecordBatch:
    """Cells of pairs (a, b) that stand for themselves."""
    listed = lambda x, kind: pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *map(len, x)]), pa.int32()), pa.array(np.concatenate(x) if x else [], kind)
    )
    empty = lambda kind: pa.nulls(len(keys), pa.list_(kind))
    columns = [
        pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), listed(a, pa.int64()), listed(b, pa.int64()),
        empty(pa.int64()), empty(pa.int64()), empty(pa.float64()) if far is None else listed(far, pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in CELLS.split(", ")])


def _meeting(cells: DataFrame, facts: DataFrame) -> DataFrame:
    """For :func:`_brought`: each cell, then the facts (row, n, radius, value) of each set that its pairs name, once."""
    wanted = stored(cells.select("c", "d", F.explode(F.array_distinct(F.concat("a", "b"))).alias("row")), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    both = facts.join(wanted, "row").unionByName(cells, allowMissingColumns=True)
    return both.repartition("c", "d").sortWithinPartitions("c", "d", "row")


def _brought(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], dict, dict]]:
    """Each cell with the columns of its pairs, and the facts of their sets by row."""
    key, pairs, known = None, {}, {}
    for batch in batches:
        now = zip(*(batch.column(c).to_pylist() for c in ("c", "d", "row", "n", "radius")), strict=True)
        for at, (c, d, row, n, radius) in enumerate(now):
            if row is None:  # comes first
                if key is not None:
                    yield key, pairs, known
                lists = {x: batch.column(x)[at].values for x in ("a", "b", "u", "v", "far")}
                key, pairs, known = (c, d), {x: None if v is None else v.to_numpy() for x, v in lists.items()}, {}
            else:
                known[row] = (n, radius, batch.column("value")[at].as_buffer())
    if key is not None:
        yield key, pairs, known


def _listed_pairs(token, row, root, least, most, place, block, similar: float, nearby: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of entries of one list, by cells. Lists come one after the other, sorted by least set size."""
    left = most - place  # shingles from the entry on
    need = similar / (1 + similar) - 1e-9  # of both sizes: the overlap of linked sets

    def fits(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        sizes = (most[i] >= (similar - 1e-9) * least[j]) & (most[j] >= (similar - 1e-9) * least[i])
        return sizes & (np.minimum(left[i], left[j]) >= need * (least[i] + least[j])) & (root[i] != root[j])

    starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(token))
    if nearby:
        i = np.flatnonzero(token[1:] == token[:-1])
        yield _pair_rows([_ordered(row, block, i[ok], i[ok] + 1) for ok in [fits(i, i + 1)]])
        return
    held, count = [], 0
    short = ends - starts <= BLOCK
    for step in range(1, BLOCK):  # short lists together, by the distance of their entries
        i = np.flatnonzero(token[step:] == token[:-step])
        if not len(i):
            break
        i = i[short[np.searchsorted(starts, i, "right") - 1]]
        ok = fits(i, i + step)
        held.append(_ordered(row, block, i[ok], i[ok] + step))
        count += int(ok.sum())
    for start, end in zip(starts[~short].tolist(), ends[~short].tolist(), strict=True):
        for first in range(start, end, BLOCK):
            last = min(first + BLOCK, end)
            inside = np.arange(first, last)
            # entries up to this block whose sets could be large enough, with enough left behind both places
            before = np.arange(start, last)
            low = least[first]
            may = (most[before] >= (similar - 1e-9) * low) & (np.minimum(left[before], left[inside].max()) >= need * (least[before] + low))
            if (root[inside] == root[first]).all():
                may &= root[before] != root[first]
            before = before[may]
            for part in range(0, len(before), 1024):
                i, j = (x.ravel() for x in np.meshgrid(before[part : part + 1024], inside, indexing="ij"))
                ok = (i < j) & fits(i, j)
                held.append(_ordered(row, block, i[ok], j[ok]))
                count += int(ok.sum())
                if count > CELL_PAIRS:
                    yield _pair_rows(held)
                    held, count = [], 0
    if held:
        yield _pair_rows(held)


def _ordered(row: np.ndarray, block: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The pairs with the two blocks of their cells."""
    return np.stack([f(x[i], x[j]) for x in (block, row) for f in (np.minimum, np.maximum)], 1)


def _different(pairs: np.ndarray) -> np.ndarray:
    """The rows in order, each once; pairs of a set with itself go."""
    pairs = pairs[np.lexsort(pairs.T[::-1])]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]).any(1)
    return pairs[new & (pairs[:, -2] != pairs[:, -1])]


def _pair_rows(held: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each cell of the pairs."""
    pairs = _different(np.concatenate(held))
    first = np.flatnonzero(np.concatenate(([True], (pairs[1:, :2] != pairs[:-1, :2]).any(1)))) if len(pairs) else np.zeros(0, np.int64)
    ends = pa.array(np.append(first, len(pairs)), pa.int32())
    listed = [pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(pairs[:, x]))) for x in (2, 3)]
    return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(pairs[first, x])) for x in (0, 1)), *listed], names=["c", "d", "a", "b"])


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one cell, which come together, as one row with each pair once; lists share many pairs."""
    now, held, count, waiting = None, [], 0, 0
    done: tuple[list, list, list] = ([], [], [])
    for batch in batches:
        a, b = batch.column("a"), batch.column("b")
        for at, key in enumerate(zip(batch.column("c").to_pylist(), batch.column("d").to_pylist(), strict=True)):
            if key != now:
                if held:
                    for x, y in zip(done, (now, *_different(np.concatenate(held)).T), strict=True):
                        x.append(y)
                    waiting += len(done[1][-1])
                now, held, count = key, [], 0
                if len(done[0]) >= 500 or waiting >= CELL_PAIRS:
                    yield _cell_rows(*done)
                    done, waiting = ([], [], []), 0
            held.append(np.stack((a[at].values.to_numpy(), b[at].values.to_numpy()), 1))
            count += len(held[-1])
            if count > CELL_PAIRS:
                held, count = [_different(np.concatenate(held))], 0
    if held:
        for x, y in zip(done, (now, *_different(np.concatenate(held)).T), strict=True):
            x.append(y)
    yield _cell_rows(*done)


def _compared(cells: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs of the cells with their sets compared: (a, b, common, joint), joint being the union's size. Stored.
    Pairs farther apart than their ``far`` are left out, and those that links of their cell connect: of the
    links, as many stay as connect the same sets. Where ``u`` and ``v`` are given, a pair stands for these two.
    """
    cells = stored(cells, "pairs")
    none = F.lit(None)
    facts = sets.select("row", none.cast("bigint").alias("n"), none.cast("double").alias("radius"), F.col("shingles").alias("value"))

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True))[:4] if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["a", "b", "common", "joint"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for _, pairs, known in _brought(batches):
            roots: dict[int, int] = {}

            def root(x: int, roots: dict[int, int] = roots) -> int:
                while (up := roots.get(x, x)) != x:
                    roots[x] = x = roots.get(up, up)
                return x

            values = {row: _unpacked(fact[2]) for row, fact in known.items()}
            a, b = pairs["a"].tolist(), pairs["b"].tolist()
            u, v = (a, b) if pairs["u"] is None else (pairs["u"].tolist(), pairs["v"].tolist())
            out = []
            for i, far in enumerate(pairs["far"].tolist()):
                low, high = root(u[i]), root(v[i])
                if low == high:
                    continue
                common, union = _distance(values[a[i]], values[b[i]])
                is_link = common * similarity.denominator >= union * similarity.numerator
                if is_link:
                    roots[low] = high
                if is_link or union - common <= far * union:
                    out.append((u[i], v[i], common, union, is_link))
            held += [x for x in out if x[4] or root(x[0]) != root(x[1])]
            if len(held) > 2000:
                yield rows(held)
                held = []
        yield rows(held)

    return stored(_meeting(cells, facts).mapInArrow(compare, "a bigint, b bigint, common bigint, joint bigint"), "compared")


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs of leaders that are not in one component yet."""
    root = lambda s: groups.select(F.col("node").alias(s), F.col("root").alias(f"root_{s}"))
    joined = pairs.join(root("a"), "a", "left").join(root("b"), "b", "left")
    return joined.where("coalesce(root_a, a) != coalesce(root_b, b)").select("a", "b", "gap")


def _member_links(open_: DataFrame, blocks: DataFrame, sets: DataFrame, similarity: Fraction, both: bool) -> DataFrame:
    """Links between members of open pairs, as links (a, b) of their leaders. With ``both`` two
    members are compared, else a member and the other leader."""
    member = blocks.where("row != leader")
    side = lambda s: member.select(*[F.col(c).alias(f"{to}{s}") for c, to in (("leader", ""), ("row", "m"), ("distance", "d"), ("block", "c"))])
    own = lambda s: blocks.where("row = leader").select(F.col("row").alias(s), F.col("row").alias(f"m{s}"), F.col("block").alias(f"c{s}"))
    near = float(1 - similarity) + 1e-9
    wanted = ["a", "b", "ma", "mb", "ca", "cb"]
    if both:
        pairs = open_.join(side("a"), "a").join(side("b"), "b").where(f"gap - da - db <= {near}").select(wanted)
    else:
        one = open_.join(side("a"), "a").where(f"gap - da <= {near}").join(own("b"), "b").select(wanted)
        pairs = one.unionByName(open_.join(side("b"), "b").where(f"gap - db <= {near}").join(own("a"), "a").select(wanted))
    pair = F.struct(F.col("ma").alias("a"), F.col("mb").alias("b"), F.col("a").alias("u"), F.col("b").alias("v"), F.lit(near).alias("far"))
    cells = pairs.groupBy(F.col("ca").alias("c"), F.col("cb").alias("d")).agg(F.collect_list(pair).alias("p"))
    found = _compared(cells.select("c", "d", "p.a", "p.b", "p.u", "p.v", "p.far"), sets, similarity)
    return found.where(_is_link(similarity)).select("a", "b").distinct()


def _is_link(similarity: Fraction) -> str:
    return f"common * {similarity.denominator} >= joint * {similarity.numerator}"


def near_components(
    docs: DataFrame, k: int = 5, similarity: Fraction = Fraction(4, 5), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id).

    Two documents are linked when their sets of k-word shingles have a Jaccard similarity
    of at least ``similarity``; the component's id is its smallest doc_id. A text of fewer
    than k words has its whole sequence as its one shingle. Null texts, empty texts and texts
    without words have an empty set and no links. Equal texts have equal sets and are
    linked. Null ids count as larger than all others. Other columns are left out.
    """
    linked = 1 - similarity
    sets = shingle_sets(docs, k, doc_id, text)
    leaders = _leaders(sets, linked)
    blocks = _blocks(leaders)
    is_link = _is_link(similarity)
    groups = None
    for nearby in [*range(1, ROUNDS + 1), 0]:
        compared = _compared(_candidates(leaders, blocks, linked, groups, nearby), sets, similarity)
        found = compared.where(is_link).select("a", "b")
        groups = merged(groups, found)
    open_ = compared.where(f"NOT {is_link}").select("a", "b", (1 - F.col("common") / F.col("joint")).alias("gap"))
    # First the members of each side against the other side's leader, then, where that
    # has not connected the two, the members of both sides that the bound leaves open.
    for both in (False, True):
        open_ = stored(_apart(open_, groups), "open")
        if open_.isEmpty():
            break
        more = _member_links(open_, blocks, sets, similarity, both)
        groups = merged(groups, more)
    rows = sets.select("row", "doc_id", "n").join(leaders.select("row", "leader"), "row", "left")
    rows = rows.join(groups.withColumnRenamed("node", "leader"), "leader", "left")
    rows = stored(rows.select("doc_id", "n", F.coalesce("root", "leader", "row").alias("group")), "groups")
    least = stored(rows.groupBy("group").agg(F.min("doc_id").alias("component_id")), "least")
    return rows.join(least, "group").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, the one with the smallest id, with its own columns.
    An id stands for one document: of rows that repeat an id one stays. Documents without
    an id stay unless they are linked with one that has an id."""
    found = near_components(docs, doc_id=doc_id, text=text, **options)
    kept = stored(found.where("doc_id <=> component_id").groupBy("doc_id").count(), "kept").select(
        F.col("doc_id").alias("kept_id"), "count"
    )
    once = docs.join(kept.select("kept_id"), docs[doc_id].eqNullSafe(F.col("kept_id")), "left_semi")
    if kept.where("count > 1 AND kept_id IS NOT NULL").isEmpty():
        return once
    several = kept.where("count > 1 AND kept_id IS NOT NULL").select("kept_id")
    repeated = docs.join(several, docs[doc_id] == F.col("kept_id"), "left_semi").dropDuplicates([doc_id])
    return once.join(several, once[doc_id] == F.col("kept_id"), "left_anti").unionByName(repeated)


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=3, similarity=Fraction(9, 10))


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id != b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * common >= 90 * (na.n + nb.n - common)),
reach AS (SELECT DISTINCT a AS doc_id, a AS other FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
c AS (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.low, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
