"""Registered queries of the subpackage: key -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import compact_windows, curve_packing, decontaminate, grammar_runs, hard_negatives, host_rules, line_dedup, pair_ranking, ring_sharding, secret_forest, sentence_pieces, simhash, unigram_counts
from riskspark.llm.common import split_words, table

#: Folder of the tokenizers' files on every machine.
TOKENIZERS = os.environ.get("RISKSPARK_TOKENIZERS") or os.path.dirname(public_tokenizers.path("x"))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return wrap


_OP4_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS win
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
r AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM g
      WHERE (doc_id, win) IN (SELECT (doc_id, win) FROM g GROUP BY doc_id, win HAVING count(*) > 1)),
rep AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n FROM r GROUP BY doc_id),
m AS (SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, len(string_split(t, chr(10))) AS n_lines
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
f AS (SELECT *, base_failed OR 100 * n_symbols > 50 * n_words OR 100 * n_dup_lines > 50 * n_lines AS failed FROM b),
h AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(failed AS INT)) AS DOUBLE) AS k FROM f GROUP BY source),
p AS (SELECT avg(k / n) AS mu, greatest(coalesce(var_samp(k / n), 0) - avg(k / n * (1 - k / n) / n), 0) AS v FROM h),
q AS (SELECT mu, CASE WHEN v > 0 THEN least(greatest(mu * (1 - mu) / v - 1, 2.0), 10000.0) ELSE 10000.0 END AS s FROM p),
o AS (SELECT source, (k + mu * s) / (n + s) <= 0.5 AS ok FROM h, q)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND o.ok AS kept
FROM f JOIN o ON f.source IS NOT DISTINCT FROM o.source
"""


@query("op4_host_rules", _OP4_SQL)
def op4(spark, sf_dir):
    judged = host_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), carry=["doc_id"])
    return judged.select("row.doc_id", *host_rules.MEASURES, "base_failed", "kept")


_OP3_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''),
             '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
s AS (SELECT k, min(doc_id) AS owner FROM k WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.doc_id, i, line, s.owner IS NOT NULL AND s.owner <> k.doc_id AS lost FROM k LEFT JOIN s ON s.k = k.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(lost AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


@query("op3_line_dedup", _OP3_SQL)
def op3(spark, sf_dir):
    out = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query("op5_simhash_gray")
def op5(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


_OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
      FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT DISTINCT n FROM g),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, s WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN g ON g.gram = dw.gram AND g.n = dw.n),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON hw.doc_id = d.doc_id LEFT JOIN hi ON hi.doc_id = d.doc_id
"""


@query("op6_decontamination", _OP6_SQL)
def op6(spark, sf_dir):
    found = decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query("op1_curve_packing")
def op1(spark, sf_dir):
    pieces = curve_packing.pack(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json", 4096, end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op8_ring_sharding")
def op8(spark, sf_dir):
    rows = ring_sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), n_shards=16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


@query("op2_pair_ranking")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pair_ranking.score(docs, table(spark, sf_dir, "labels"), cut=0.3)
    found = found.select("row.doc_id", "score", "predicted")
    return found.select("doc_id", pair_ranking.held_out().alias("held_out"), "score", "predicted")


@query("op7_unigram_counts")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = unigram_counts.count_tokens(docs, f"{TOKENIZERS}/piece_bpe_32k.model")
    return found.select("row.doc_id", "n_tokens", "score")


@query("op9_secret_forest")
def op9(spark, sf_dir):
    found = secret_forest.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "start", "length", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
                        F.col("label").alias("format_label"), "p_secret", "is_secret")


@query("op10_compact_windows")
def op10(spark, sf_dir):
    return compact_windows.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op13_sentence_pieces")
def op13(spark, sf_dir):
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sentence_pieces.encode(docs, model, decoded=True)
    return found.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.btrim(F.to_json("ids"), F.lit("[]")).cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "agrees")


def _periodic(docs: DataFrame) -> DataFrame:
    """Documents as the contract of op12 rewrites them: in one of ten by doc_id, the words from a on are periodic."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words, n, g = F.col("words"), F.size("words").cast("long"), F.col("g")
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("words", F.when(F.col("doc_id").isNotNull() & (F.col("h") % 10 == 0), split_words(F.col("text"))))
    rows = rows.withColumn("a", F.when(n > 0, g % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    turned = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, at(i).cast("int")))
    return rows.select("doc_id", F.when(n > 0, F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_grammar_runs")
def op12(spark, sf_dir):
    found = grammar_runs.find(_periodic(table(spark, sf_dir, "documents").select("doc_id", "text")), least=12)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    line = lambda r: F.concat_ws(",", r.start, r.length, r.period)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select("row.doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed").select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query("op11_hard_negatives")
def op11(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)
