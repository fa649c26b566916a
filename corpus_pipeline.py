"""The training-data pipeline: quality rules, line dedup, SimHash near-dedup, decontamination, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the documents that it keeps, with the columns of ``documents``, but
for the last, which returns the packed pieces. Each stage's result is
written as Parquet and read again as the next one's documents.

* quality rules: documents that fail the base rule or whose host is rejected go.
* line dedup: lines that an earlier document holds are cut from the text
  (``n_chars`` follows); documents stay, a copy with what is left of it.
* near-dedup: the smallest doc_id of each SimHash component stays.
* decontamination: documents with a benchmark window go.
* packing: what is left, in sequences of 4096 tokens, with the token ids.

Null columns, empty and repeated rows, empty tables and further columns
are passed on as each operator states; very long texts go through every stage
whole, and are cut into pieces by the last alone; of documents that tie (a line's
holders, a component) the smallest doc_id stays. A stage writes its result to a
table of its own, which later calls leave alone, and then drops the tables that it made on the way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import curve_packing, decontaminate, host_rules, line_dedup, simhash
from riskspark.llm.common import Scratch, table
from riskspark.llm.registry import TOKENIZERS

def _written(spark: SparkSession, name: str, work, docs: DataFrame, sf_dir: str) -> tuple[DataFrame, Scratch]:
    """A stage's result as a table of its own, and what holds it. The stage's other tables go once it is written."""
    scratch, kept = Scratch(spark, f"pipeline-{name}"), Scratch(spark, f"pipeline-{name}-result")
    try:
        return kept.save(work(spark, docs, sf_dir, scratch), "kept"), kept
    finally:
        scratch.drop()


def _rules(spark, docs, sf_dir, scratch):
    return host_rules.keep_good(docs, scratch=scratch)


def _lines(spark, docs, sf_dir, scratch):
    out = line_dedup.dedup(docs, scratch=scratch)
    cut = F.col("n_dropped") > 0
    row = F.col("row").withField("text", F.when(cut, F.col("kept_text")).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars")))
    return out.select(row.alias("row")).select("row.*")


def _near(spark, docs, sf_dir, scratch):
    return simhash.keep_one(docs, shingle=4, max_bits=4, scratch=scratch)


def _leaks(spark, docs, sf_dir, scratch):
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"), n=10, mode="document", scratch=scratch)


def _pack(spark, docs, sf_dir, scratch):
    pieces = curve_packing.pack(docs, f"{TOKENIZERS}/word_bpe_49k.json", 4096, end_id=2, scratch=scratch)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _written(spark, "rules", _rules, docs, sf_dir)[0]


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _written(spark, "lines", _lines, docs, sf_dir)[0]


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _written(spark, "simhash", _near, docs, sf_dir)[0]


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _written(spark, "leaks", _leaks, docs, sf_dir)[0]


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _written(spark, "packing", _pack, docs, sf_dir)[0]


_WORK = {quality_rules: ("rules", _rules), dedup_lines: ("lines", _lines), near_dedup: ("simhash", _near),
         decontamination: ("leaks", _leaks), packing: ("packing", _pack)}

STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: Near-dedup components are not a matter of plain SQL; tests/llm/test_pipeline.py holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of ``documents`` after all stages. A stage's table goes once the next one's is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs, kept = _written(spark, *_WORK[stage], docs, sf_dir)
        if before:
            before.drop()
        before = kept
    return docs
