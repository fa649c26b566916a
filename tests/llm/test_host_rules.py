import pytest
from oracle_harness import check

from riskspark.llm import host_rules as hr

SCHEMA = "doc_id long, text string, source string, kept int, n_words string"
GOOD = " ".join(f"word{i}" for i in range(40))


def judged(spark, rows, **rules):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return {r.row.doc_id: r for r in hr.judge(frame, hr.HostRules(**rules)).collect()}


def test_query_against_sql(spark):
    assert check(spark, "/root/testdata/sf0.001", ["op4_host_rules"])["op4_host_rules"][0]


@pytest.mark.parametrize("text", ["", "a", " x  y\n", "a b " * 30, "a b c d e f g h i " * 3, GOOD, GOOD + "\n" + GOOD, "é#*$ \x0b|<>&% é",
                                  "l1\nl1\n \n\nl2\nl1", " ".join(f"w{i % 13}" for i in range(100)) + " " + GOOD, "z " * 30_000])
def test_measures(spark, text):
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    win = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = {}
    for x in win:
        n[x] = n.get(x, 0) + 1
    covered = {i + k for i, x in enumerate(win) if n[x] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    r = judged(spark, [(1, text, "s")])[1]
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
    assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_hosts_shrink_towards_the_prior(spark):
    rows, i = [], 0
    for host, bad, good in (("bad", 45, 5), ("fine", 2, 98), ("also", 1, 80), ("one", 1, 0), ("mid", 10, 40)):
        for k in range(bad + good):
            rows.append((i, "few words" if k < bad else GOOD, host))
            i += 1
    got = judged(spark, rows)
    rate = {rows[d][2]: r.host_rate for d, r in got.items()}
    assert rate["bad"] > 0.5 > rate["mid"] > rate["fine"]
    assert 0.9 > rate["bad"] and rate["one"] < 1                 # shrunk
    kept = {d for d, r in got.items() if r.kept}
    assert kept == {d for d, t, h in rows if t == GOOD and h != "bad"}


def test_nulls_empty_and_repeats(spark):
    rows = [(1, None, None), (2, GOOD, None), (2, GOOD, None), (None, GOOD, "a"), (5, "", "a")]
    frame = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    assert hr.judge(frame.limit(0)).count() == 0
    out = hr.keep_good(frame)
    assert out.columns == frame.columns and sorted(str(r.doc_id) for r in out.collect()) == ["2", "2", "None"]
