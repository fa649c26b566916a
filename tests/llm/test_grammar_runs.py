import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from riskspark.llm import grammar_runs as gr
from riskspark.llm import registry

SF = "/root/testdata/sf0.001"


def brute(words, least=12):
    """Every run by trying all periods: (start, length, period)."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least:
                found.setdefault((i, j + q - i), q)      # the smallest period comes first
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def got(words, least=12):
    return [tuple(x) for x in gr.runs(np.array(words, np.int64), least).tolist()]


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    rnd = random.Random(least)
    for trial in range(700):
        n, k = rnd.randint(0, 90), rnd.choice([1, 2, 2, 3, 6, 20])
        words = [rnd.randrange(k) for _ in range(n)]
        if trial % 2:      # planted periodic pieces among words of their own
            words = []
            while len(words) < n:
                base = [rnd.randrange(8) for _ in range(rnd.randint(1, 9))]
                words += (base * 12)[:rnd.randint(1, 5 * len(base))] + [100 + len(words)] * rnd.randint(0, 1)
        assert got(words, least) == brute(words, least), (trial, words)


def test_fibonacci_and_powers():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert got(b) == brute(b)
    assert got([7] * 5000) == [(0, 5000, 1)]
    assert got(list(range(50)) * 20 + [99]) == [(0, 1000, 50)]
    passage = list(range(3000))
    assert got(passage + [-5 + 10_000] + passage) == [] and got(passage * 2) == [(0, 6000, 3000)]


def test_repair_round_trip_and_no_pair_twice():
    rnd = random.Random(2)
    for _ in range(200):
        text = [rnd.randrange(4) for _ in range(rnd.randint(0, 120))]
        rest, rules = gr.repair(text, 4)
        spelled = {s: [s] for s in range(4)}
        for k, (x, y) in enumerate(rules):
            spelled[4 + k] = spelled[x] + spelled[y]
        assert [w for s in rest for w in spelled[s]] == text
        apart = {}
        for i, p in enumerate(zip(rest, rest[1:])):
            assert p not in apart or i - apart[p] < 2
            apart.setdefault(p, i)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = brute(words)
    lost = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in lost)))


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len((r.text or "").split()) < 2500]
    have = {r.doc_id: tuple(r) for r in registry.QUERIES["op12_grammar_runs"](spark, SF).collect()}
    assert len(have) == len(rows) and sum(r[1] > 0 for r in have.values()) > 10
    for r in short:
        assert have[r.doc_id] == expected(r.doc_id, r.text), r.doc_id


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "y"), (2, "", "y"), (3, "a\x0bb  " * 20_000, "z"), (None, "é " * 12, None), (4, "q " * 11, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    out = gr.find(docs).collect()
    assert sorted((r.n_words, len(r.runs), r.collapsed) for r in out if r.row.doc_id in (1, 2)) == [(0, 0, "")] * 3
    by = {r.row.doc_id: r for r in out}
    assert [tuple(x) for x in by[3].runs] == [(0, 40_000, 2)] and by[3].collapsed == "a b " and by[3].row.runs == "z"
    assert [tuple(x) for x in by[None].runs] == [(0, 12, 1)] and by[4].runs == [] and by[4].collapsed == " ".join("q" * 11)
    assert gr.find(docs.limit(0)).count() == 0 and gr.find(docs.select("text")).count() == len(rows)
