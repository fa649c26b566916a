import zlib

import numpy as np

from riskspark.llm import pair_ranking as pr
from riskspark.llm import registry

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = registry.QUERIES["op2_pair_ranking"](spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    rows = [(r.score, r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert len(rows) > 50 and np.mean([p == y for _, p, y in rows]) > 0.95
    good, bad = [s for s, _, y in rows if y], [s for s, _, y in rows if not y]
    assert np.mean([a > b for a in good for b in bad]) > 0.98


def test_held_out_labels_are_not_learned_from(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    a, b = ({r.row.doc_id: r.score for r in pr.score(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_fit_ranks_and_thresholds_by_quantile():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(500, 4))
    y = (x[:, 0] - x[:, 1] + 0.1 * rnd.normal(size=500) > -1).astype(int)
    model = pr.fit(x, y)
    s = model.score(x)
    assert ((s >= 0.3) == y).mean() > 0.95
    assert abs((s < 0.3).mean() - (1 - y.mean())) < 0.1
    assert (pr.fit(x, np.ones(500)).score(x) == 0.5).all()


def test_nulls_repeats_empty_and_names(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "", 2), (3, "a very long text " * 20_000, 3), (4, "fine words here", 4)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(3, 1), (3, 1), (None, 0), (4, None), (1, 0), (9, 0)], "doc_id long, quality int")
    out = pr.score(docs, labels).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out) and sorted(r.row.score for r in out) == [1, 1, 2, 3, 4]
    assert pr.score(docs.limit(0), labels).count() == 0
    assert {r.score for r in pr.score(docs, labels.limit(0)).collect()} == {0.5}


def test_every_labelled_row_is_learned_from(spark):
    """The table's model is that of all rows, whatever their number; each row is in a pair of either label."""
    rnd = np.random.default_rng(2)
    z, y = rnd.normal(size=(90, 3)), np.repeat([1, 0], [13, 77])
    good, bad = z[y == 1], z[y == 0]
    met = {tuple(np.round(d, 9)) for d in pr.pairs(z, y)}
    assert all(any(tuple(np.round(g - b, 9)) in met for b in bad) for g in good) and all(any(tuple(np.round(g - b, 9)) in met for g in good) for b in bad)
    n, width = 13_000, pr.N_FEATURES
    x = rnd.normal(size=(n, width)).round(4)
    y = (x[:, 0] + 0.1 * rnd.normal(size=n) > 0).astype(int)
    x[12_500:, 1] += 1000       # only a mean of all rows tells of these
    rows = spark.createDataFrame([(i, int(q), r.tolist()) for i, (q, r) in enumerate(zip(y, x))], "doc_id long, quality int, x array<double>")
    model = pr.fit_table(rows, pr.Scratch(spark, "test-pairs"))
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0))
    assert ((model.score(x) >= 0.3) == y).mean() > 0.95
    other = pr.fit(x, y)
    assert np.corrcoef(model.rank(x), other.rank(x))[0, 1] > 0.999
