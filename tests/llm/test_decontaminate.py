import random
import re

from oracle_harness import check

from riskspark.llm import decontaminate as dc


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, n):
    grams = {}
    for i, t in items:
        w = words(t)
        k = min(n, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            grams.setdefault(tuple(w[a:a + k]), set()).add(str(i))
    out = {}
    for d, t in docs:
        w, hit, seen = words(t), set(), set()
        for k in {len(g) for g in grams}:
            for a in range(len(w) - k + 1):
                if (found := grams.get(tuple(w[a:a + k]))) is not None:
                    hit |= set(range(a, a + k))
                    seen |= found
        out[d] = (len(w), len(hit), sorted(seen))
    return out


def test_query_against_sql(spark):
    assert check(spark, "/root/testdata/sf0.001", ["op6_decontamination"])["op6_decontamination"][0]


def fixture(seed=3):
    rnd = random.Random(seed)
    v = [f"w{i}" for i in range(30)] + ["É", "état", "ÀB", "x9"]
    text = lambda n: "".join(rnd.choice(v).title() + rnd.choice([" ", ", ", "--", "\n", "_"]) for _ in range(n))
    items = [(i, text(rnd.choice([2, 3, 4, 5, 9, 10, 11, 25]))) for i in range(25)] + [(90, None), (91, " ,."), (92, "w1"), (93, text(12)), (94, "")]
    docs = []
    for d in range(120):
        t = text(rnd.randint(0, 60))
        if rnd.random() < 0.5:
            t += "..." + (rnd.choice(items)[1] or "") + " " + text(rnd.randint(0, 9))
        docs.append((d, t))
    return docs + [(200, None), (201, ""), (202, items[3][1]), (203, (items[3][1] + " ") * 2000)], items


def test_hits_against_brute_force(spark):
    docs, items = fixture()
    for n, rows in ((10, 10**6), (4, 0), (1, 10**6)):         # without room to broadcast the sets are shuffled
        got = dc.find_hits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), n, broadcast_rows=rows)
        assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got.collect()} == brute(docs, items, n)


def test_removal_modes(spark):
    docs, items = fixture(5)
    frame = spark.createDataFrame([(*d, "k", 1) for d in docs + [(None, "w1"), (0, "clean")]], "doc_id long, text string, n_words string, spans int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 10)
    left = dc.remove(frame, bench)
    assert left.columns == frame.columns
    assert {r.doc_id for r in left.collect()} == {d for d, _ in docs if not want[d][1]} | {0}
    cut = {(r.doc_id, r.text) for r in dc.remove(frame, bench, mode="span").collect()}
    assert all((d, t) in cut for d, t in docs if not want[d][1]) and (None, "") in cut
    assert all(len(words(t)) == want[d][0] - want[d][1] for d, t in cut if d is not None and d != 0)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit) for r in dc.find_hits(docs, none).collect()] == [(2, 0)]
    assert dc.find_hits(docs.limit(0), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


def test_repeated_rows_each_have_their_result(spark):
    docs, items = fixture(7)
    again = docs + [d for d in docs[:40] for _ in range(2)] + [(None, items[3][1])] * 3 + [(None, None)] * 2
    frame = spark.createDataFrame(again, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in dc.find_hits(frame, bench, 10).collect())
    assert got == sorted((str(d), *brute([(d, t)], items, 10)[d]) for d, t in again)
    for mode in ("document", "span"):
        left = dc.remove(frame, bench, mode=mode)
        clean = [(d, t) for d, t in again if not brute([(d, t)], items, 10)[d][1]]
        assert left.count() == (len(clean) if mode == "document" else len(again))


def test_a_window_that_many_items_share(spark, monkeypatch):
    """Over the byte bound the windows are shuffled; the result is the same."""
    shared = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(f"item-{i:06d}", shared) for i in range(20_000)], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"x {shared} y"), (2, "nothing here")], "doc_id long, text string")
    for bound in (1 << 30, 0):
        monkeypatch.setattr(dc, "BROADCAST_BYTES", bound)
        got = {r.doc_id: (r.n_hit, len(r["items"])) for r in dc.find_hits(docs, items).collect()}
        assert got == {1: (10, 20_000), 2: (0, 0)}
