import random

import numpy as np
import pytest
from oracle_harness import check

from riskspark.llm import line_dedup as ld

SCHEMA = "doc_id long, text string"
BLANK = " \t\n\x0b\x0c\r"


def brute(docs, min_chars=10):
    def key(s):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(BLANK))
    holders = {}
    for d, t in docs:
        for s in (t or "").split("\n"):
            holders.setdefault(key(s), set()).add(d)
    out = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        out[d] = "\n".join(s for s in lines if len(key(s)) < min_chars or min(holders[key(s)]) == d)
    return out


def corpus(seed, ids):
    rnd = random.Random(seed)
    lines = [f"line number {i} of a few" for i in range(60)] + ["short", "ÉTÉ é", "", "  \t", "A line With Capitals É", "one every document holds"]
    return [(i, "\n".join([rnd.choice([s, s.upper() if s.isascii() else s, f"  {s}\r"]) for s in rnd.sample(lines, rnd.randint(0, 12))]
                          + ["one every document holds", f"own line of {i}"])) for i in ids]


def kept(index, spark, docs):
    return {r.row.doc_id: r.kept_text for r in ld.apply(index, spark.createDataFrame(docs, SCHEMA)).collect()}


def test_query_against_sql(spark):
    assert check(spark, "/root/testdata/sf0.001", ["op3_line_dedup"])["op3_line_dedup"][0]


def test_cuckoo_filter_inserts_and_deletes():
    rnd = np.random.default_rng(1)
    h = rnd.integers(-2**63, 2**63 - 1, (2, 20_000))
    f = ld.CuckooFilter.for_keys(20_000)
    f.insert(*h)
    f = ld.CuckooFilter.load(f.dump())
    assert f.contains(*h).all()
    assert f.contains(*rnd.integers(-2**63, 2**63 - 1, (2, 20_000))).mean() < 0.01
    f.delete(*h[:, :10_000])
    assert f.contains(*h[:, 10_000:]).all() and f.contains(*h[:, :10_000]).mean() < 0.01


def test_a_full_filter_loses_nothing():
    rnd = np.random.default_rng(2)
    h = rnd.integers(-2**63, 2**63 - 1, (2, 100))
    f = ld.CuckooFilter(4)
    f.insert(*h)
    f = ld.CuckooFilter.load(f.dump())
    assert f.stash and f.contains(*h).all()


def test_insertions_and_deletions_are_reversible(spark):
    one, two = corpus(1, range(40, 80)), corpus(2, range(0, 40))
    index = ld.build(spark.createDataFrame(one, SCHEMA), keys_per_shard=20)
    assert index.n_shards > 1 and kept(index, spark, one) == brute(one)
    both = ld.insert(index, spark.createDataFrame(two, SCHEMA))
    assert kept(both, spark, one + two) == brute(one + two)
    back = ld.delete(both, spark.createDataFrame([(d,) for d, _ in two], "doc_id long"))
    assert kept(back, spark, one) == brute(one)
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, index.counts.collect()))
    part = ld.delete(both, spark.createDataFrame([(d,) for d, _ in one[:30]], "doc_id long"))
    assert kept(part, spark, one[30:] + two) == brute(one[30:] + two)


def test_slices_of_a_hot_shard(spark):
    docs = corpus(3, range(60))
    frame = spark.createDataFrame(docs, SCHEMA)
    index = ld.build(frame, keys_per_shard=30)
    refs = ld.line_refs(frame)
    a, b = ({(r.doc_id, k.h1, k.h2) for r in ld.dropped_keys(index, refs, n).collect() for k in r["keys"]} for n in (3, 10**6))
    assert a == b and a


@pytest.mark.parametrize("docs,want", [
    ([], {}),
    ([(1, None), (2, ""), (3, "\n\n")], {1: "", 2: "", 3: "\n\n"}),
    ([(5, "the same line here"), (5, "the same line here")], {5: "the same line here"}),
    ([(4, "the same line here\nthe same line here\nx"), (9, "THE SAME LINE HERE \n\ty")], {4: "the same line here\nthe same line here\nx", 9: "\ty"}),
    ([(7, "éééééééééé"), (8, "éééééééééé"), (1, "ééééééééé"), (2, "ééééééééé")], {7: "éééééééééé", 8: "", 1: "ééééééééé", 2: "ééééééééé"}),
    ([(1, "\n".join(["a long line again"] * 30_000)), (2, "a long line again")], {1: "\n".join(["a long line again"] * 30_000), 2: ""}),
])
def test_edge_cases(spark, docs, want):
    frame = spark.createDataFrame([(*d, 1) for d in docs], SCHEMA + ", n_lines int")
    out = ld.dedup(frame).collect()
    assert {r.row.doc_id: r.kept_text for r in out} == want and len(out) == len(docs)
    assert all(r.row.n_lines == 1 for r in out)


def test_null_ids(spark):
    out = ld.dedup(spark.createDataFrame([(None, "a line of its own"), (None, "a line of its own"), (3, "a line of its own")], SCHEMA)).collect()
    assert sorted((r.row.doc_id is None, r.n_dropped) for r in out) == [(False, 1), (True, 0), (True, 0)]


def test_shards_follow_the_keys_of_a_large_insert(spark):
    one, two = corpus(1, range(10)), corpus(2, range(10, 300))
    index = ld.build(spark.createDataFrame(one, SCHEMA), keys_per_shard=20)
    both = ld.insert(index, spark.createDataFrame(two, SCHEMA))
    assert both.n_shards >= both.counts.count() / 20 and kept(both, spark, one + two) == brute(one + two)
    largest = both.counts.groupBy(ld._shard(both.n_shards)).count().agg({"count": "max"}).first()[0]
    assert largest <= 4 * 20
