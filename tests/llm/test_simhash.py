import random

import numpy as np
import xxhash

from riskspark.llm import simhash
from riskspark.llm.common import Scratch
from riskspark.llm.components import connected_components


def brute_fingerprint(text, k):
    words, word = [], b""
    for c in (text or "").encode() + b" ":
        if c in b" \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), b""
        else:
            word += bytes([c + 32]) if 65 <= c <= 90 else bytes([c])
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def corpus(seed=1, n=300):
    rnd = random.Random(seed)
    words = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(300)]
    texts = [None, "", " \t\n", "one", "One two", "one two three four", "ONE TWO three x four five"]
    base = [[rnd.choice(words) for _ in range(rnd.randint(30, 400))] for _ in range(60)]
    while len(texts) < n:
        w = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        texts.append(" ".join(w))
    return list(enumerate(texts, 100))


def test_fingerprint_is_the_bit_majority():
    for _, t in corpus(n=60):
        for k in (1, 4):
            assert simhash.fingerprint(t, k) == brute_fingerprint(t, k)


def test_gray_index_finds_all_pairs():
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 2**63, 30, dtype=np.uint64)
    fps = np.unique(np.r_[rnd.integers(0, 2**63, 300, dtype=np.uint64),
                          *[base ^ (np.uint64(1) << rnd.integers(0, 64, 30).astype(np.uint64)) for _ in range(20)]])
    node = rnd.integers(0, 3, len(fps))
    index = simhash.GrayIndex(node, fps)
    for d in (0, 3, 6):
        got = {(int(i), int(j)) for a, b in index.pairs(d, block=64) for i, j in zip(a, b)}
        f, n = index.fps, index.node
        want = {(i, j) for i in range(len(f)) for j in range(i + 1, len(f))
                if n[i] == n[j] and int(f[i] ^ f[j]).bit_count() <= d}
        assert got == want


def check(spark, rows, max_node=4096):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_duplicates(docs, 4, 4, max_node).collect()}
    fps = {d: brute_fingerprint(t, 4) for d, t in rows}
    ids = sorted(fps)
    pairs = [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
    want = brute_components(pairs, ids)
    assert {d: c for d, (_, c) in got.items()} == want
    assert {d: f & (2**64 - 1) for d, (f, _) in got.items()} == fps
    return want


def test_components_against_brute_force(spark):
    want = check(spark, corpus())
    assert len(set(want.values())) < len(want)


def test_large_nodes_are_factored_without_loss(spark):
    check(spark, corpus(seed=5, n=250), max_node=3)


def test_empty_nulls_and_repeats(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "x y z u v"), (1, "x y z u v"), (None, "x y z u v"), (None, None), (9, None)]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id)
                 for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(False, 1, 1)] * 3 + [(False, 2, 1), (False, 9, 9), (True, 0, 1), (True, 0, 9)]


def test_keep_one_keeps_columns(spark):
    rows = [(3, "a b c d e", "x", "m"), (1, "a b c d e", "y", "n"), (2, "unlike the others here", "z", "o")]
    out = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, component_id string, fp string"))
    assert out.columns == ["doc_id", "text", "component_id", "fp"]
    assert sorted(r.doc_id for r in out.collect()) == [1, 2]


def test_long_chain_of_links(spark):
    ids = list(range(1, 41))
    random.Random(2).shuffle(ids)
    links = spark.createDataFrame([(a, b) for a, b in zip(ids, ids[1:])] + [(100, 101), (101, 100)], "x long, y long")
    got = {r.node: r.root for r in connected_components(links, Scratch(spark, "t")).collect()}
    assert got == {i: 1 for i in range(2, 41)} | {101: 100}
