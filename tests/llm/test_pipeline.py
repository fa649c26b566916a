import re
import shutil

import corpus_pipeline as cp
import pytest
from test_curve_packing import check_pieces
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"


def brute_quality(docs):
    """Documents that pass; with these hosts' rates the verdict on hosts is checked apart, in test_host_rules."""
    out = {}
    for d, t in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        win = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        twice = {i + k for i, x in enumerate(win) if win.count(x) > 1 for k in range(8)}
        if len(w) >= 20 and 100 * len(twice) <= 30 * len(w):
            out[d] = t
    return out


def brute_lines(docs):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))
    owner = {}
    for d in sorted(docs):
        for line in docs[d].split("\n"):
            owner.setdefault(key(line), d)
    return {d: "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or owner[key(x)] == d) for d, t in docs.items()}


def brute_near(docs):
    fps = {d: brute_fingerprint(t, 4) for d, t in docs.items()}
    ids = sorted(fps)
    root = brute_components([(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 4], ids)
    return {d: docs[d] for d in ids if root[d] == d}


def brute_clean(docs, items):
    def words(t):
        return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    grams = set()
    for t in items:
        w = words(t)
        n = min(10, len(w))
        grams |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} - {()}
    sizes = {len(g) for g in grams}

    def hit(t):
        w = words(t)
        return any(tuple(w[i:i + n]) in grams for n in sizes for i in range(len(w) - n + 1))
    return {d: t for d, t in docs.items() if not hit(t)}


def test_stages_against_brute_force(spark, tmp_dir):
    docs, path = spark.read.parquet(f"{SF}/documents.parquet"), f"{SF}/documents.parquet"
    columns = docs.columns
    want = {r.doc_id: r.text or "" for r in docs.collect()}
    items = [r.text or "" for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for (name, stage), brute in zip(cp.STAGES[:-1], (brute_quality, brute_lines, brute_near, lambda d: brute_clean(d, items))):
        out = f"{tmp_dir}/{name}"
        stage(spark, spark.read.parquet(path), SF).write.parquet(out)
        path, want = out, brute(want)
        got = spark.read.parquet(path)
        assert got.columns == columns
        assert {r.doc_id: r.text or "" for r in got.collect()} == want, name
        assert got.where("n_chars != length(text)").count() == 0
    assert len(want) > 50
    check_pieces(cp.run(spark, SF).collect(), want.items())


@pytest.mark.parametrize("rows", [
    [],
    [(None, None, None, None, None)] * 3,
    [(1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, None, "en", "a", None), (3, "word " * 30_000, None, None, 1)],
])
def test_nulls_empty_repeats_and_further_columns(spark, tmp_dir, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_words string, host int"
    rows += [(i, " ".join(f"w{(i * 31 + k * k) % 997}" for k in range(50)) + f"\nline that all hold\n{i}", "en", "b", 9) for i in range(5, 8)] if rows else []
    docs = spark.createDataFrame([(*r, None, "x", 1) for r in rows], schema)
    for name, stage in cp.STAGES:
        out = f"{tmp_dir}/{name}"
        stage(spark, docs, SF).write.parquet(out)
        if name != "packing":
            assert spark.read.parquet(out).columns == docs.columns
        docs = spark.read.parquet(out)
    assert docs.select("doc_id").distinct().count() == (3 if rows else 0)
    shutil.rmtree(tmp_dir)


def test_built_twice_and_stages_called_apart(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rules, near = cp.quality_rules(spark, docs, SF), cp.near_dedup(spark, docs, SF)
    a = cp.run(spark, SF)
    b = cp.run(spark, SF)
    assert a.count() == b.count() > 0 and sorted(r.doc_id for r in a.select("doc_id").collect()) == sorted(r.doc_id for r in b.select("doc_id").collect())
    assert 0 < rules.count() <= docs.count() and 0 < near.count() <= docs.count()
