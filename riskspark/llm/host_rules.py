"""Host-level quality rules, as DataFrame expressions only.

Every document is measured and tested against document rules. Failures are
counted per host (the ``source`` column); the failure rate of a host is
shrunk towards the rate of all hosts with an empirical beta prior, fitted
by moments over the hosts, so that a host with three documents is not
judged by three documents. The verdict on the host is joined back to its
documents.

Edge cases. Null text: no words, so the base rule fails. Null hosts form one
host of their own. Repeated rows are measured, counted and kept or
rejected each on its own. An empty table gives an empty result. A host of
any size is one row after the partial aggregation; nothing is collected per
host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import BLANKS, Scratch, small_side, split_words

#: Measures that ``measure`` adds.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 8


@dataclass(frozen=True)
class HostRules:
    """Limits. ``max_host_rate``: hosts whose shrunk failure rate is above it are rejected."""

    min_words: int = 20
    max_repeat_percent: int = 30
    max_symbol_percent: int = 50
    max_dup_line_percent: int = 50
    max_host_rate: float = 0.5
    #: Bounds on the weight of the prior, in documents.
    prior_weight: tuple[float, float] = (2.0, 10_000.0)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Columns of ``df`` plus the measures of each whole text.

    Repeated words: the hashes of all 8-word windows are compared; only
    a text that has a repeated window goes through the sort that finds which
    positions the repeated windows cover.
    """
    keep = [F.col(f"`{c}`") for c in df.columns]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    df = df.select(*keep, split_words(body).alias("_words"), F.filter(
        F.split(body, "\n", -1), lambda s: F.length(F.btrim(s, F.lit(BLANKS))) > 0).alias("_lines"))
    size = F.size("_words")
    windows = F.when(size >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.greatest(size - (WINDOW - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("_words", i, WINDOW))
    )).otherwise(F.array().cast("array<bigint>"))
    df = df.select(
        *keep,
        size.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_windows"),
    )
    sorted_windows = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("p")))))
    df = df.select(*keep, *MEASURES[:4], sorted_windows.alias("_sorted"))
    twice = F.filter("_sorted", lambda x, i: (x["h"] == F.get("_sorted", i - 1)["h"]) | (x["h"] == F.get("_sorted", i + 1)["h"]))
    df = df.select(*keep, *MEASURES[:4], F.array_sort(F.transform(twice, lambda x: x["p"])).alias("_at"))
    covered = F.aggregate(
        F.transform("_at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda total, x: total + x)
    return df.select(*keep, *MEASURES[:4], F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed(rules: HostRules):
    return (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))


def rule_failed(rules: HostRules):
    """A document's failure as its host's rate counts it: the base rule, symbols, or repeated lines."""
    return (base_failed(rules)
            | (100 * F.col("n_symbols") > rules.max_symbol_percent * F.col("n_words"))
            | (100 * F.col("n_dup_lines") > rules.max_dup_line_percent * F.col("n_lines")))


def host_verdicts(measured: DataFrame, host: str, rules: HostRules, scratch: Scratch) -> tuple[DataFrame, int]:
    """(host, n_docs, n_failed, shrunk_rate, host_ok), one row per host, and the number of hosts.

    The prior: m is the mean of the hosts' rates, v their variance less what
    sampling explains; the beta distribution with that mean and variance has
    the weight m (1 - m) / v - 1, held within ``prior_weight``.
    """
    hosts = scratch.save(
        measured.groupBy(F.col(f"`{host}`").alias("host")).agg(
            F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("_failed").cast("long")).alias("n_failed")), "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    m, v, noise, n_hosts = hosts.agg(
        F.avg(rate), F.var_samp(rate), F.avg(rate * (1 - rate) / F.col("n_docs")), F.count(F.lit(1))).first()
    low, high = rules.prior_weight
    m = 0.5 if m is None else m
    between = max((v or 0.0) - (noise or 0.0), 0.0)
    weight = min(max(m * (1 - m) / between - 1, low), high) if between > 0 else high
    shrunk = (F.col("n_failed") + F.lit(m * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.select("host", "n_docs", "n_failed", shrunk.alias("shrunk_rate"),
                        (shrunk <= rules.max_host_rate).alias("host_ok")), n_hosts


def judge(docs: DataFrame, rules: HostRules = HostRules(), text: str = "text", host: str = "source",
          carry: list[str] | None = None, scratch: Scratch | None = None) -> DataFrame:
    """One row per document: ``row`` (a struct of the carried columns, all by default), the
    measures, ``base_failed``, ``host_rate``, ``kept``.

    The measured rows are written once, as both the host counts and the
    verdicts read them; carry only what is needed. Carried columns sit in
    a struct, so their names cannot clash with the measures.
    """
    scratch = scratch or Scratch(docs.sparkSession, "host-rules")
    carried = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)])
    rows = docs.select(carried.alias("row"), F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("text"))
    measured = measure(rows.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")))
    measured = scratch.save(measured.select("row", "host", *MEASURES, base_failed(rules).alias("base_failed"),
                                            rule_failed(rules).alias("_failed")), "measured")
    hosts, n_hosts = host_verdicts(measured, "host", rules, scratch)
    hosts = small_side(hosts.select(F.col("host").alias("_host"), "shrunk_rate", "host_ok"), n_hosts)
    joined = measured.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left")
    return joined.select("row", *MEASURES, "base_failed", F.col("shrunk_rate").alias("host_rate"),
                         (~F.col("base_failed") & F.col("host_ok")).alias("kept"))


def keep_good(docs: DataFrame, rules: HostRules = HostRules(), text: str = "text", host: str = "source",
              scratch: Scratch | None = None) -> DataFrame:
    """The documents that pass, with their columns."""
    return judge(docs, rules, text, host, scratch=scratch).where("kept").select("row.*")
