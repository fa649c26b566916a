import math
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import hard_negatives as hn
from riskspark.llm import registry

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, is_anchor):
    """By brute force over all rows: (vec_id, vector, label), in the order read."""
    good = [(i, v, l) for i, v, l in rows if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    m = [[math.floor(256 * float(np.float32(x))) for x in v] for _, v, _ in good]
    out = []
    for a, (aid, _, al) in enumerate(good):
        if aid is None or not is_anchor(aid):
            continue
        s = [sum(x * y for x, y in zip(m[a], m[b])) for b in range(len(good))]
        key = lambda b: (-s[b], good[b][0] is None, good[b][0] or 0)
        for p in sorted((b for b in range(len(good)) if b != a and good[b][2] == al), key=key)[:5]:
            fits = [b for b in range(len(good)) if good[b][2] != al and 30 * s[p] <= 100 * s[b] <= 90 * s[p]]
            out += [(aid, good[p][0], k, good[b][0], s[p], s[b]) for k, b in enumerate(sorted(fits, key=key)[:10], 1)]
    return sorted(out, key=str)


def mined(df, **kw):
    return sorted((tuple(r) for r in hn.mine(df, F.col("vec_id") % 100 == 0, **kw).collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = [(i, v, (l + 1) % 10 if i % 7 == 0 else l) for i, v, l in rows]
    got = sorted((tuple(r) for r in registry.QUERIES["op11_hard_negatives"](spark, SF).collect()), key=str)
    assert got == expected(rows, lambda i: i % 100 == 0) and len(got) > 100


@pytest.mark.parametrize("dim", [1, 3, 8])
def test_ties_clusters_and_many_pieces(spark, dim, monkeypatch):
    """Small numbers give many ties; one vector fills a third of the rows; cells and pieces are small."""
    for name, value in (("CELL_ROWS", 30), ("PIECE", 16), ("CHUNK", 2), ("FIRST_ROWS", 40), ("GROW", 3)):
        monkeypatch.setattr(hn, name, value)
    rnd = random.Random(dim)
    centres = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(600):
        v = centres[0] if i % 3 == 0 else [x + rnd.gauss(0, 0.05) for x in centres[rnd.randrange(6)]]
        rows.append((i, [round(x, 1) for x in v], rnd.randrange(4)))
    got = mined(spark.createDataFrame(rows, SCHEMA))
    assert got == expected(rows, lambda i: i % 100 == 0) and got


def test_heap_gives_every_cell_once_by_falling_bound_that_holds():
    rng = np.random.default_rng(5)
    rows = rng.integers(-50, 50, (400, 6)).astype(float)
    books = hn.codebook(rows[:, :3], 5), hn.codebook(rows[:, 3:], 7)
    codes = [hn.nearest(rows[:, :3], books[0]), hn.nearest(rows[:, 3:], books[1])]
    radii = tuple(np.array([max([np.linalg.norm(x - b[k]) for x in side[c == k]], default=0) for k in range(len(b))])
                  for side, b, c in zip((rows[:, :3], rows[:, 3:]), books, codes))
    counts = {}
    for cell in zip(*(c.tolist() for c in codes)):
        counts[cell] = counts.get(cell, 0) + 1
    multi = hn.MultiIndex(books, radii, counts)
    a = rows[7]
    order = list(multi.visit(a, 0, 10 ** 9, -math.inf, math.inf))
    assert sorted(order) == sorted(counts)
    both = list(multi.visit(a, 0, 100, -math.inf, math.inf)) + list(multi.visit(a, 100, 10 ** 9, -math.inf, math.inf))
    assert both == order
    scores = rows @ a
    for cut in (-2000, 0, 1500, 4000):
        seen = set(multi.visit(a, 0, 10 ** 9, cut, math.inf))
        assert all((c1, c2) in seen for c1, c2, s in zip(*codes, scores) if s >= cut)
        below = set(multi.visit(a, 0, 10 ** 9, -math.inf, cut))
        assert all((c1, c2) in below for c1, c2, s in zip(*codes, scores) if s <= cut)
    assert len(set(multi.visit(a, 0, 10 ** 9, 4000, math.inf))) < len(counts)


def test_large_numbers_are_exact():
    a = np.array([[2 ** 26 + 1, 2 ** 26 - 1]], np.int32)
    assert hn._scores(a, a).tolist() == [[(2 ** 26 + 1) ** 2 + (2 ** 26 - 1) ** 2]]


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [0.9, 0.5], 1), (2, [0.5, 0.2], 2), (2, [0.5, 0.2], 2), (None, [0.5, 0.2], 3),
            (3, None, 2), (4, [0.5, None], 2), (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (7, [0.4, 0.4], None), (8, [0.6], 2), (9, [], 2),
            (100, [-1.0, -1.0], 2), (200, [0.0, 0.0], 7), (300, [1e20, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mined(df.selectExpr("*", "1 AS uid", "'x' AS v"))
    padded = [(i, v if v is None else v + [0.0] * (2 - len(v)), l) for i, v, l in rows if i != 300]
    assert got == expected(padded, lambda i: i % 100 == 0) and got
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id = 1")) == [] and mined(df.where("vec_id = 200")) == []
    assert hn.mine(df.limit(0), F.lit(True)).columns == [c.split()[0] for c in hn.RESULT.split(", ")]


SMALL_DRIVER = """
import sys
from pyspark.sql import functions as F
from riskspark.llm import hard_negatives as hn
from riskspark.session import local_session

hn.SAMPLE_ROWS = 500
spark = local_session("local[2]", 4)
rows = spark.range(24000).repartition(40, "id").selectExpr("id AS vec_id", "transform(sequence(1, 64), i -> cast(cos(id * i) AS float)) AS embedding", "cast(id % 3 AS int) AS label")
rows.write.parquet(sys.argv[1])
print(hn.mine(spark.read.parquet(sys.argv[1]), F.col("vec_id") % 8000 == 0).count(), "rows")
"""


def test_driver_gets_a_sample_not_one_of_every_partition(tmp_path):
    """40 partitions of 600 rows, a sample of 500, and a driver that takes 2 MB of results: 500 rows of each are 6 MB."""
    conf = {"spark.driver.maxResultSize": "2m", "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "64k"}
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": " ".join(f"--conf {k}={v}" for k, v in conf.items()) + " pyspark-shell", "RISKSPARK_DRIVER_MEMORY": "1g",
                        "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))}
    run = subprocess.run([sys.executable, "-c", SMALL_DRIVER, str(tmp_path / "vectors")], env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert run.stdout.split()[-2:] == ["150", "rows"]


@pytest.mark.parametrize("held", [20, 1 << 18])
def test_many_passes_and_ties_of_null_ids(spark, held, monkeypatch):
    """One anchor a pass or two, tasks that give rows before their end, equal scores with and without vec_id."""
    for name, value in (("CELL_ROWS", 40), ("PIECE", 16), ("CHUNK", 2), ("FIRST_ROWS", 30), ("GROW", 3), ("PASS", 2), ("HELD", held)):
        monkeypatch.setattr(hn, name, value)
    rnd = random.Random(3)
    rows = [(None if i % 11 == 5 else i, [float(rnd.randrange(-2, 3)) / 2 for _ in range(4)], rnd.randrange(3)) for i in range(700)]
    got = mined(spark.createDataFrame(rows, SCHEMA))
    assert got == expected(rows, lambda i: i % 100 == 0) and got


def test_last_instalment_comes_to_what_the_heap_would():
    rng = np.random.default_rng(8)
    rows = rng.integers(-50, 50, (300, 6)).astype(float)
    books = hn.codebook(rows[:, :3], 6), hn.codebook(rows[:, 3:], 4)
    codes = [hn.nearest(rows[:, :3], books[0]), hn.nearest(rows[:, 3:], books[1])]
    radii = tuple(np.array([max([np.linalg.norm(x - b[k]) for x in side[c == k]], default=0) for k in range(len(b))])
                  for side, b, c in zip((rows[:, :3], rows[:, 3:]), books, codes))
    counts = {}
    for cell in zip(*(c.tolist() for c in codes)):
        counts[cell] = counts.get(cell, 0) + 1
    multi, anchors = hn.MultiIndex(books, radii, counts), rows[:9]
    for after, upto in ((0, 300), (60, 300), (60, 120), (0, 60)):
        for floor, ceiling in ((-(1 << 62), 1 << 62), (500, 1 << 62), (-2000, 800), (1 << 62, -(1 << 62))):
            got = multi.coming(anchors, after, upto, np.full(9, floor), np.full(9, ceiling))
            for i, a in enumerate(anchors):
                assert {(c // 4, c % 4) for c in np.flatnonzero(got[:, i])} == set(multi.visit(a, after, upto, floor, ceiling))


@pytest.mark.parametrize("width", [1, 63, 64, 65, 200])
def test_scores_between_limits(width):
    s = np.random.default_rng(width).integers(-9, 10, (7, width)).astype(np.float32)
    low, high = np.arange(-3, 4).astype(np.float32), np.array([9, 3, -9, 5, 5, 2, 8], np.float32)
    i, j = hn._within(s, low, high)
    assert sorted(zip(i.tolist(), j.tolist())) == list(zip(*(x.tolist() for x in np.nonzero((s >= low[:, None]) & (s <= high[:, None])))))
