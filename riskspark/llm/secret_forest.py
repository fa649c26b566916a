"""Secret scanning with a random forest that removes false positives.

1. ``corpus_statistics`` reads all documents: how many hold each word of 3
   to 12 ASCII letters, and how often one character follows another. The
   dictionary is the words in at least one document of ``1 / min_share``; as
   a document of d distinct words adds d to all counts together, it has at
   most (mean d) / min_share words, however large the corpus, and is sent to
   the tasks, as is the fixed table of transitions.
2. ``candidates`` reads all documents again: every run of key characters
   that is long (16) or holds a digit (8) is a candidate, and so is every value
   assigned to a key, token or password, of any length and signs, with its place and
   features: length, character classes, entropy, mean log-probability of
   its transitions, share covered by dictionary words, path shape, and the
   words and signs next to it.
3. ``fit`` trains a forest (Spark MLlib) on labelled findings, a bounded
   sample of distinct ones by hash order, weighted by their number; ``scan`` gives every candidate its probability.

``known_formats`` labels the candidates whose kind their format settles:
issuer prefixes and assigned hex strings are secrets; addresses, numbers and
plain words are not. The format tests are no features, so the forest has to
judge by shape and context, and gives a verdict on candidates of no known
format. A table of reviewed findings can be passed instead.

Edge cases. Null or empty text has no candidates. Repeated rows give
repeated findings. Without findings of both labels there is no model: all
probabilities are null and nothing is removed (``is_secret`` is true). A
candidate in a very long text is found as any other; the context looks at
40 characters before it.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import Scratch

#: Documented bound on the labelled findings of either label that the forest is trained on.
MAX_FINDINGS = 10_000
MIN_SHARE = 1 / 2000
CLASSES = 38                    # a-z, 0-9, blank, other
_RUN = re.compile(r"[A-Za-z0-9_+/.@-]{8,}")
_WORD = re.compile(r"[a-z]{3,12}(?![a-z])")
_BEFORE = re.compile(r"(\w+)\W*$")
_HINTS = re.compile(r"(key|token|secret|passw|pwd|auth|cred|api|bearer)", re.I)

#: Formats that settle a candidate's label: fixed values.
_ISSUED = re.compile(r"(AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})")
_HEX = re.compile(r"[0-9a-f]{16,}|[0-9A-F]{16,}")
_ASSIGNED = re.compile(r"(token|password|passwd|secret|api_key|apikey)\s*[=:]\s*[\"']?$", re.I)
_SIGN = re.compile(r"[=:]+")
_VALUE = re.compile(r"[ \t]*(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"'][^\s]*))")
_HINTED = re.compile(r"(key|token|secret|passw|pwd|auth|cred|api|bearer)\w*[\"']?\s*[=:]+\s*[\"']?$", re.I)
_HARMLESS = re.compile(r"[A-Za-z]+\.?|[0-9.+-]+|[A-Za-z0-9_.+-]+@[A-Za-z0-9.-]+|https?://.*")

FEATURES = ("length", "upper", "lower", "digit", "sign", "changes", "entropy", "transition", "covered", "distinct",
            "hex_only", "slashes", "dots", "at", "after_slash", "quoted", "assigned", "colon", "hint_near", "hint_any",
            "word_before", "end_of_line")


def _folded(raw: bytes) -> np.ndarray:
    return _FOLD[np.frombuffer(raw, np.uint8)]


_FOLD = np.full(256, 37, np.int64)
_FOLD[[9, 10, 11, 12, 13, 32]] = 36
for _i in range(26):
    _FOLD[65 + _i] = _FOLD[97 + _i] = _i
for _i in range(10):
    _FOLD[48 + _i] = 26 + _i


def corpus_statistics(docs: DataFrame, min_share: float, scratch: Scratch) -> tuple[list[str], np.ndarray]:
    """The dictionary and the log-probabilities of transitions, over all texts of ``docs`` (text)."""

    def run(batches):
        for batch in batches:
            words, pairs, n = Counter(), np.zeros(CLASSES * CLASSES, np.int64), 0
            for text in batch["text"].to_pylist():
                if text:
                    raw, n = text.encode("utf-8", "surrogatepass"), n + 1
                    words.update(set(_WORD.findall(text.lower())))
                    codes = _folded(raw)
                    pairs += np.bincount(codes[:-1] * CLASSES + codes[1:], minlength=CLASSES * CLASSES)
            at = np.flatnonzero(pairs)
            for kind, keys, values in (("w", list(words), list(words.values())), ("p", [str(i) for i in at], pairs[at].tolist()), ("n", [""], [n])):
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(keys), pa.string()), pa.array(keys, pa.string()), pa.array(values, pa.int64())],
                                                 names=["kind", "key", "n"])

    counts = scratch.save(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "kind string, key string, n long")
                          .groupBy("kind", "key").agg(F.sum("n").alias("n")), "statistics")
    n_docs = counts.where("kind = 'n'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(2, math.ceil(n_docs * min_share))
    words = [r.key for r in counts.where((F.col("kind") == "w") & (F.col("n") >= least)).select("key").orderBy("key").collect()]
    table = np.full(CLASSES * CLASSES, 0.5)
    for r in counts.where("kind = 'p'").collect():         # CLASSES squared rows at most
        table[int(r.key)] += r.n
    table = table.reshape(CLASSES, CLASSES)
    return words, np.log(table / table.sum(axis=1, keepdims=True))


def _covered(automaton, low: str) -> float:
    """Share of characters inside some dictionary word."""
    if not len(automaton):
        return 0.0
    last, total = -1, 0
    for end, size in automaton.iter(low):      # by end; longest first
        first = max(end - size + 1, last + 1)
        total, last = total + max(0, end + 1 - first), max(last, end)
    return total / len(low)


def describe(text: str, first: int, end: int, automaton, transitions: np.ndarray) -> list[float]:
    """The features of one candidate."""
    value, before, after = text[first:end], _context(text, first), text[end:end + 1]
    raw, low, n = value.encode("utf-8", "surrogatepass"), value.lower(), end - first
    codes = _folded(raw)
    kinds = [0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3 for c in value]
    shares = [kinds.count(k) / n for k in range(4)]
    freq = np.array(list(Counter(value).values())) / n
    near = _BEFORE.search(before)
    return [float(x) for x in (
        n, *shares, sum(a != b for a, b in zip(kinds, kinds[1:])) / n, -(freq * np.log2(freq)).sum(),
        transitions[codes[:-1], codes[1:]].mean() if len(codes) > 1 else 0.0, _covered(automaton, low), len(freq) / n,
        bool(re.fullmatch(r"[0-9a-fA-F]+", value)), value.count("/"), value.count("."), "@" in value,
        before[-1:] == "/", before[-1:] in "\"'" and bool(before), bool(re.search(r"=\s*[\"']?$", before)),
        bool(re.search(r":\s*[\"']?$", before)), bool(near and _HINTS.search(near[1])), bool(_HINTS.search(before)),
        len(near[1]) if near else 0, after in ("", "\n"))]


def known_format(text: str, first: int, end: int) -> int | None:
    """1 or 0 where the format settles it, else None."""
    value, before = text[first:end], _context(text, first)
    if _ISSUED.fullmatch(value) or _HEX.fullmatch(value) and _ASSIGNED.search(before):
        return 1
    # A word or number that is assigned may be a password: the forest decides.
    return 0 if _HARMLESS.fullmatch(value) and not _HINTED.search(before) else None


def _word_before(text: str, at: int) -> tuple[int, int]:
    """The word that ends at ``at``, but for blanks and a quote in front of it."""
    end = at
    while end > 0 and text[end - 1].isspace():
        end -= 1
    if end > 0 and text[end - 1] in "\"'":
        end -= 1
    first = end
    while first > 0 and (text[first - 1].isalnum() or text[first - 1] == "_"):
        first -= 1
    return first, end


def assigned_values(text: str):
    """Places of the values behind ``=`` or ``:`` after a word that holds a hint, in order, none within another.

    From each sign one word is looked back over, so the time is in proportion to the text.
    """
    done = 0
    for sign in _SIGN.finditer(text):
        if sign.start() < done:
            continue
        first, end = _word_before(text, sign.start())
        if first < end and _HINTS.search(text, max(first, done), end):
            m = _VALUE.match(text, sign.end())
            if m is None and sign.end() - sign.start() > 1:       # nothing but signs: the last is the value
                m = _VALUE.match(text, sign.end() - 1)
            if m:
                done = m.end()
                yield m.span(m.lastindex)


def find(text: str) -> list[tuple[int, int]]:
    """The candidates' places in a text: runs of key characters, and whole values in an assigned or hinted context."""
    runs = {m.span() for m in _RUN.finditer(text) if len(m[0]) >= 16 or any(c.isdigit() for c in m[0])}
    return sorted(runs | set(assigned_values(text)))


def _context(text: str, first: int) -> str:
    """The 40 characters before a place, or more where the gap to the word before is wider."""
    gap = first
    while gap > 0 and (text[gap - 1].isspace() or text[gap - 1] in "\"'=:"):
        gap -= 1
    return text[max(0, gap - 40 if first - gap > 20 else first - 40):first]


def candidates(docs: DataFrame, words: list[str], transitions: np.ndarray, text: str = "text") -> DataFrame:
    """(row, start, length, value, label, x) for every candidate; ``row`` holds the other columns of ``docs``."""
    carried = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(F.struct(*carried).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    out = "start long, length long, value string, label int, x array<double>"
    held = []

    def run(batches):
        if not held:
            automaton = ahocorasick.Automaton()
            for w in words:
                automaton.add_word(w, len(w))
            if words:
                automaton.make_automaton()
            held.append(automaton)
        for batch in batches:
            at, cols = [], [[], [], [], [], []]
            for i, t in enumerate(batch["text"].to_pylist()):
                for first, end in find(t or ""):
                    at.append(i)
                    for col, v in zip(cols, (first, end - first, t[first:end], known_format(t, first, end), describe(t, first, end, held[0], transitions))):
                        col.append(v)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["row"].take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=["row", "start", "length", "value", "label", "x"])

    from pyspark.sql.types import StructType

    schema = StructType(rows.select("row").schema.fields + _ddl(docs.sparkSession, out).fields)
    return rows.mapInArrow(run, schema)


def _ddl(spark, text: str):
    return spark.createDataFrame([], text).schema


def sample_findings(found: DataFrame, max_findings: int) -> DataFrame:
    """(label, x, weight): at most ``max_findings`` distinct findings of either label, weighted by their number."""
    rows = found.where("label IS NOT NULL").groupBy("label", "x").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    parts = [rows.where(F.col("label") == k).orderBy(F.xxhash64("x", "label"), "x").limit(max_findings) for k in (0, 1)]
    return parts[0].union(parts[1]).coalesce(1)


def fit(found: DataFrame, max_findings: int, scratch: Scratch, trees: int = 20, depth: int = 6, seed: int = 9):
    """The forest, or None without findings of both labels. ``found``: label, x among others."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    sample = scratch.save(sample_findings(found, max_findings), "findings")
    if sample.select("label").distinct().count() < 2:
        return None
    sample = sample.select(F.col("label").cast("double").alias("label"), array_to_vector("x").alias("features"), "weight")
    return RandomForestClassifier(weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed, maxBins=64, subsamplingRate=0.7).fit(sample)


def scan(docs: DataFrame, text: str = "text", findings: DataFrame | None = None, threshold: float = 0.5,
         max_findings: int = MAX_FINDINGS, min_share: float = MIN_SHARE) -> DataFrame:
    """(row, start, length, value, label, p_secret, is_secret) for every candidate.

    ``findings`` (doc_id, start, label): reviewed findings to learn from;
    without it the labels come from known formats.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array

    scratch = Scratch(docs.sparkSession, "secret-forest")
    words, transitions = corpus_statistics(docs.select(F.col(f"`{text}`").alias("text")), min_share, scratch)
    found = candidates(docs, words, transitions, text)
    if findings is not None:
        reviewed = findings.groupBy(F.col("doc_id").alias("_doc"), F.col("start").alias("_start")).agg(F.max("label").cast("int").alias("_label"))
        found = found.join(reviewed, (F.col("row.doc_id") == F.col("_doc")) & (F.col("start") == F.col("_start")), "left").select(
            "row", "start", "length", "value", F.col("_label").alias("label"), "x")
    found = scratch.save(found, "candidates")
    model = fit(found, max_findings, scratch)
    if model is None:
        return found.select("row", "start", "length", "value", "label", F.lit(None).cast("double").alias("p_secret"), F.lit(True).alias("is_secret"))
    judged = model.transform(found.withColumn("features", array_to_vector("x")))
    p = F.round(vector_to_array("probability")[1], 9)
    return judged.select("row", "start", "length", "value", "label", p.alias("p_secret"), (p >= threshold).alias("is_secret"))
