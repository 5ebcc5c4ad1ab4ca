"""Tree concatenation, centroid clustering and periodic runs against the library, SQL and brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import public_tokenizers
from driftspark.llm import centroids, periodic_runs, tree_bpe
from driftspark.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id bigint, text string, n_tokens string, part string, row string"  # clash with inner names
PERIODIC = "zero one two three " * 12 + "end"
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "short"), (4, "short"), (None, PERIODIC), (6, PERIODIC), (7, "a " * 5000),
    (8, "x" * 9000), (9, "mixed <|endoftext|> it's 123abc  \n\n 中文字 é🙂 " * 90), (10, "0123456789" * 700), (11, "word " * 3 + " x"),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", "x", "x") for i, t in ODD], COLUMNS)


@pytest.fixture(scope="module")
def real(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# --- tree concatenation


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def library_rows(library, texts):
    out = []
    for doc, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((doc, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=repr)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.text("ab", min_size=1, max_size=60), st.text("theing", max_size=40), st.text("0123456789", max_size=30),
            st.text(" \n\t", max_size=9), st.text("'strelvmd", max_size=9), st.text("-=._!<|>", max_size=20),
            st.text("中文字日本é", max_size=20), st.text(max_size=9), st.just("<|endoftext|>"),
        ),
        max_size=8,
    ),
    st.sampled_from([4, 7, 32]),
)
def test_tree_encodes_like_the_library(library, parts, leaf):
    text = "".join(parts)
    encoder = tree_bpe.TreeEncoder(BPE, leaf)
    [ids] = encoder.encode([text])
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder.decode([ids])[0].decode() == text


@pytest.mark.parametrize("part", [64, 1 << 16])  # 64: most texts are halved over tasks
def test_tree_of_odd_texts(odd, library, part):
    assert rows(tree_bpe.encode_and_decode(odd, BPE, digests=True, leaf=32, part=part)) == library_rows(library, ODD)


def test_tree_gives_ids_and_texts(odd):
    found = tree_bpe.encode_and_decode(odd.where("doc_id IN (1, 4)"), BPE)
    assert rows(found) == [(1, 0, [], ""), (4, 1, [19509], "short"), (4, 1, [19509], "short")]


def test_tree_of_nothing(odd):
    assert rows(tree_bpe.encode_and_decode(odd.limit(0), BPE, digests=True)) == []


def test_tree_query(spark, real, library):
    assert rows(QUERIES["op11_tree_bpe"](spark, SF)) == library_rows(library, real)


def test_an_edge_without_agreement_grows():
    text = "a" * 997  # one run: tokens of several lengths, no firm place
    encoder = tree_bpe.TreeEncoder(BPE, 16)
    assert encoder.encode([text])[0].tolist() == Tokenizer.from_file(BPE).encode(text).ids


# --- clustering


def brute_clusters(vectors, k=8, rounds=10, dims=64):
    kept = [
        (i, [math.floor(1024 * x) for x in e])
        for i, e in vectors
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)
    ]
    name = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    means = [e for _, e in sorted(kept, key=name)[:k]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda e: min((distance(e, c), n) for n, c in enumerate(means))
    for _ in range(rounds):
        of = [near(e)[1] for _, e in kept]
        for n in range(len(means)):
            own = [e for (_, e), c in zip(kept, of, strict=True) if c == n]
            if own:
                means[n] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    found = [(i, *near(e)[::-1]) for i, e in kept]
    total = sum(d for *_, d in found)
    return sorted(
        ((i, c, d, sum(x for _, n, x in found if n == c), total, sha(",".join(map(str, means[c])))) for i, c, d in found), key=repr
    )


def vectors_of(seed, n, dims=64):
    rng = random.Random(seed)
    return [(i, [rng.choice((-1, 1)) * rng.random() ** 3 for _ in range(dims)]) for i in range(n)]


def test_clusters_of_odd_vectors(spark):
    data = vectors_of(1, 60)
    data += [(100, None), (101, []), (102, [0.5] * 63), (103, [0.5] * 65), (104, [math.nan] + [0.0] * 63)]
    data += [(105, [math.inf] + [0.0] * 63), (106, [None] + [0.0] * 63), (3, data[3][1]), (None, [0.25] * 64), (7, [-0.0] * 64)]
    frame = spark.createDataFrame([(i, e, "x", 0) for i, e in data], "vec_id bigint, embedding array<double>, cluster string, cell int")
    assert rows(centroids.cluster(frame)) == brute_clusters(data)


@pytest.mark.parametrize("n", [0, 1, 5, 8])
def test_few_vectors(spark, n):
    data = vectors_of(2, n)
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<float>")
    data = [(i, [float(np.float32(x)) for x in e]) for i, e in data]
    assert rows(centroids.cluster(frame)) == brute_clusters(data)


def test_ties_go_to_the_smaller_number(spark):
    data = [(i, [float(i % 2)] * 4) for i in range(20)]  # equal vectors: several centroids coincide
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    assert rows(centroids.cluster(frame, k=5, dims=4, lead=2)) == brute_clusters(data, k=5, dims=4)


def test_bounds_leave_most_centroids_unmeasured():
    rng = np.random.default_rng(3)
    axis = rng.normal(size=(4, 64))
    x = np.floor(1024 * (rng.normal(size=(4000, 4)) @ axis + 0.05 * rng.normal(size=(4000, 64)))).astype(np.int64)
    axes = np.linalg.eigh(np.cov(x.T))[1][:, ::-1]
    turned = x @ axes
    nearest = centroids.Nearest(x[:8], axes, 16)
    number, distance = nearest.find(x, turned[:, :16], np.sqrt((turned[:, 16:] ** 2).sum(1)))
    exact = ((x[:, None] - x[None, :8]) ** 2).sum(2)
    assert (number == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    assert nearest.measured < 2 * len(x)


def test_too_large_components_are_an_error(spark):
    frame = spark.createDataFrame([(1, [1e30] * 64)], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(frame).collect()


# --- periodic runs


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            if j > i and e - s >= max(24, 3 * q) and not any(words[s : e - r] == words[s + r : e] for r in range(1, q)):
                out.append((s, e - s, q))
            i = j + 1
    return sorted(out)


def brute_row(doc, text, planted):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if planted and doc is not None and h % 10 == 0 and n:
        a, g = (h // 10) % n, h // 10
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    facts = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    return (doc, len(runs), *facts, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(kept)))


word_lists = st.lists(
    st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=14), st.integers(1, 9), st.integers(0, 9)), max_size=6
).map(lambda parts: [w for unit, times, more in parts for w in (unit * (times + 1))[: len(unit) * times + more]])


@settings(max_examples=200, deadline=None)
@given(st.lists(word_lists, max_size=5))
def test_runs_equal_brute_force(texts):
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    words = np.array([w for t in texts for w in t], np.uint64)
    assert periodic_runs.find_runs(words, offsets) == [brute_runs(t) for t in texts]


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 5), st.integers(0, 2**31))
def test_squared_differences_are_exact(level, seed):
    b, rng = 1 << level, np.random.default_rng(seed)
    codes = max(2, int(np.sqrt((periodic_runs.MODULUS - 1) / b)))
    blocks, windows = rng.integers(0, codes, (5, b)), rng.integers(0, codes, (5, 2 * b))
    plain = [[((blocks[i] - windows[i, k : k + b]) ** 2).sum() for k in range(b)] for i in range(5)]
    assert periodic_runs.squared_differences(blocks, windows).tolist() == np.array(plain).tolist()


def test_runs_of_odd_texts(odd):
    assert rows(periodic_runs.periodic_runs(odd)) == sorted((brute_row(i, t, False) for i, t in ODD), key=repr)


def test_runs_of_nothing(odd):
    assert rows(periodic_runs.periodic_runs(odd.limit(0))) == []


def test_a_long_period():
    unit = np.random.default_rng(1).integers(0, 1 << 40, 30_000).astype(np.uint64)
    words = np.concatenate((unit[:5], np.tile(unit, 3), unit[:777], unit[:1]))
    assert periodic_runs.find_runs(words, np.array([0, len(words)])) == [[(5, 90_777, 30_000)]]


def test_runs_query(spark, real):
    short = {doc for doc, text in real if len(WORD.findall(text or "")) < 700}  # brute force is quadratic
    found = [r for r in rows(QUERIES["op13_periodic_runs"](spark, SF)) if r[0] in short]
    assert len(found) > 100 and any(r[1] for r in found)
    assert found == sorted((brute_row(i, t, True) for i, t in real if i in short), key=repr)
