import random

from riskspark.llm import registry
from riskspark.llm import secret_forest as sf

SCHEMA = "doc_id long, text string"


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    common = [a + b + c for a in ("ther", "con", "inter", "re") for b in ("na", "ti", "mo") for c in ("tion", "ment", "ing", "al")]
    rows, truth = [], {}
    for d in range(n):
        words = [rnd.choice(common) for _ in range(60)]
        words[7] = "".join(rnd.choice(common) for _ in range(3))
        words[21] = f"mail{rnd.randrange(999)}@host.example.com"
        words[22] = f"{rnd.randrange(10**15)}"
        if d % 4 == 0:
            words[30] = "token = \"" + "".join(rnd.choice("0123456789abcdef") for _ in range(40)) + "\""
        if d % 10 == 3:      # of no known format
            value = "".join(rnd.choice("abcdefghjkmnpqrstuvwxyz0123456789ABCDEFGHJKLM") for _ in range(32))
            words[40] = f"secret = \"{value}\""
            truth[d] = value
        rows.append((d, " ".join(words)))
    return rows, truth


def test_forest_judges_by_shape_and_context(spark):
    rows, truth = corpus()
    got = sf.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    texts = dict(rows)
    assert all(texts[r.row.doc_id][r.start:r.start + r.length] == r.value for r in got)
    known = [r for r in got if r.label is not None]
    assert {r.label for r in known} == {0, 1} and sum(r.is_secret == (r.label == 1) for r in known) >= 0.99 * len(known)
    found = {(r.row.doc_id, r.value) for r in got if r.label is None and r.is_secret}
    assert len(found & set(truth.items())) >= 0.9 * len(truth) and found <= set(truth.items())


def test_reviewed_findings_decide(spark):
    rows, _ = corpus(60)
    docs = spark.createDataFrame(rows, SCHEMA)
    first = sf.scan(docs).collect()
    reviewed = [(r.row.doc_id, r.start, int("@" in r.value)) for r in first]
    got = sf.scan(docs, findings=spark.createDataFrame(reviewed, "doc_id long, start long, label int")).collect()
    assert sum(r.is_secret == ("@" in r.value) for r in got) >= 0.98 * len(got)


def test_query(spark):
    got = registry.QUERIES["op9_secret_forest"](spark, "/root/testdata/sf0.01").collect()
    known = [r for r in got if r.format_label is not None]
    assert known and sum(r.is_secret == (r.format_label == 1) for r in known) >= 0.97 * len(known)


def test_statistics_cover_the_corpus(spark):
    from riskspark.llm.common import Scratch

    docs = spark.createDataFrame([("one two three",), ("two three",), (None,), ("Three",)], "text string")
    words, table = sf.corpus_statistics(docs, 0.5, Scratch(spark, "t"))
    assert words == ["three", "two"] and table.shape == (sf.CLASSES, sf.CLASSES)


def test_edge_cases(spark):
    rows = [(1, None, "p"), (2, "", "p"), (None, "AKIA" + "ABCDEFGH12345678", "p"), (3, "x" * 70_000, "p"), (3, "x" * 70_000, "p")]
    docs = spark.createDataFrame(rows, SCHEMA + ", value string")
    got = sf.scan(docs).collect()
    assert len(got) == 3 and {r.row.value for r in got} == {"p"}
    assert sf.scan(docs.limit(0)).count() == 0
    alone = sf.scan(docs.where("doc_id IS NULL")).collect()      # one label only: no model, nothing removed
    assert [(r.p_secret, r.is_secret) for r in alone] == [(None, True)]


def test_assigned_values_of_any_length_and_signs_are_candidates(spark):
    rows, _ = corpus()
    values = ["CorrectHorse", "s3cr!", "aB#9$x%Z&q=1:k", "pässword"]
    for k, v in enumerate(values):
        assert v in {t[a:b] for t in (f'password = "{v}" and', f"api_key: {v} end") for a, b in sf.find(t)}
        rows.append((1000 + k, rows[k][1] + f' password = "{v}" ' + rows[k + 1][1]))
    got = {(r.row.doc_id, r.value): r for r in sf.scan(spark.createDataFrame(rows, SCHEMA)).where("row.doc_id >= 1000").collect()}
    assert all(got[1000 + k, v].label is None and got[1000 + k, v].p_secret is not None for k, v in enumerate(values))
    assert got[1002, values[2]].is_secret


def test_copies_take_one_place_of_the_sample(spark):
    rows = [(k, [float(g), float(k)]) for g in range(30) for k in (0, 1) for _ in range(200 if g < 10 else 1)]
    found = spark.createDataFrame(rows + [(None, [0.0, 0.0])], "label int, x array<double>")
    for bound, want in ((20, 20), (100, 30)):
        got = sf.sample_findings(found, bound).collect()
        for k in (0, 1):
            held = [r for r in got if r.label == k]
            assert len(held) == want == len({tuple(r.x) for r in held})
            assert all(r.weight == (200 if r.x[0] < 10 else 1) for r in held)


def test_places_equal_the_plain_pattern_and_take_linear_time():
    import re
    import time

    plain = re.compile(r"(?:key|token|secret|passw|pwd|auth|cred|api|bearer)\w*[\"']?\s*[=:]+[ \t]*(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"'][^\s]*))", re.I)
    rnd = random.Random(4)
    for _ in range(4000):
        t = "".join(rnd.choice(["key", "api", "x", "_", "=", ":", " ", "\n", '"', "'", "1", "Token", "zz ", "foo="]) for _ in range(rnd.randint(1, 14)))
        assert list(sf.assigned_values(t)) == [m.span(m.lastindex) for m in plain.finditer(t)], t
    for piece in ("api", "key=", "key = ", "token: '", "=", " "):
        began = time.time()
        sf.find(piece * (1_000_000 // len(piece)))
        assert time.time() - began < 4, piece
    wide = "password =" + " " * 500 + "CorrectHorse"
    assert (510, 522) in sf.find(wide) and sf.known_format(wide, 510, 522) is None


def test_features_equal_a_plain_count():
    import numpy as np

    import ahocorasick

    words = ahocorasick.Automaton()
    for w in ("horse", "orse", "correct"):
        words.add_word(w, len(w))
    words.make_automaton()
    table = np.zeros((sf.CLASSES, sf.CLASSES))
    text = "x /password = \"CorrectHorse9\"\n"
    first = text.index("Correct")
    got = dict(zip(sf.FEATURES, sf.describe(text, first, first + 13, words, table)))
    assert got["length"] == 13 and got["upper"] == 2 / 13 and got["digit"] == 1 / 13 and got["covered"] == 12 / 13
    assert got["quoted"] == 1 and got["assigned"] == 1 and got["hint_near"] == 1 and got["hint_any"] == 1 and got["colon"] == 0
    assert got["word_before"] == 8 and got["end_of_line"] == 0 and got["distinct"] == len(set("CorrectHorse9")) / 13


def test_forest_finds_a_known_format_held_out_of_the_labels(spark):
    """The driver's documents: hex tokens lose their label, and the forest finds them by what it learned of the others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    first = [r for r in sf.scan(docs).collect() if r.label is not None]
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = {(r.row.doc_id, r.start) for r in first if r.label == 1 and sf._HEX.fullmatch(r.value)}
    rest = [(r.row.doc_id, r.start, int(r.label)) for r in first if (r.row.doc_id, r.start) not in held]
    if not held or not any(x[2] for x in rest):
        return                       # one format alone: nothing to learn from
    got = sf.scan(docs, findings=spark.createDataFrame(rest, "doc_id long, start long, label int")).collect()
    found = {(r.row.doc_id, r.start) for r in got if r.is_secret}
    assert texts and len(found & held) >= 0.9 * len(held)
