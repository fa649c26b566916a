"""Quality scores by Bradley-Terry pairwise ranking.

A preference pair is a good and a bad labelled document; the model is a
weight vector w, fitted by logistic loss on the pairs' feature differences:
P(good before bad) = 1 / (1 + exp(-w (x_good - x_bad))). A document's rank
score is w x. The threshold is a quantile of the rank scores of the labelled
rows it is fitted on: the level at which as many of them lie below as are
labelled bad, moved to where balanced accuracy is best among the quantiles
nearby, both counted in bins of a thousandth of the ranks' deviation. The score is the logistic function of the distance to that threshold,
placed so that the threshold itself scores ``cut``.

Features come from the text alone (shares of each ASCII character, word
shapes, repetition), as numbers of one length for any text; they are computed
once per text. The fit uses every labelled row: rows are dealt into buckets by
the hash of their id, and in a bucket each row is paired with ``ROUNDS`` rows of
the other label at least, so that pairs grow with the rows. Means, Newton steps and
counts are sums that tasks make; only these sums come to the driver.

Edge cases. Null or empty text has features of zero and a score. Null labels
and ids are not learned from; of repeated labels the largest holds. Without both
labels every score is 0.5. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.common import Scratch

#: Pairs of a row, at least, and rows of the rarer label in a bucket, about.
ROUNDS, BUCKET = 4, 64
#: Bins of ranks per standard deviation.
BINS = 1000
_PUNCT = [c for c in range(33, 127) if not chr(c).isalnum()]


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * N_FEATURES
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, n_words = len(raw), len(words)
    distinct = len(set(words))
    lines = raw.split(b"\n")
    sizes = np.fromiter(map(len, words), np.int64, n_words)
    upper, lower, digits = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    same = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:]))) / max(n_words - 1, 1)
    shapes = [upper / n, lower / n, digits / n, counts[128:].sum() / n, counts[9:14].sum() / n, counts[32] / n,
              upper / max(upper + lower, 1), np.log1p(n_words), min(n_words, 20) / 20, sizes.mean() / 10, sizes.std() / 10,
              sizes.max() / 100, (sizes <= 2).mean(), distinct / n_words, pairs, same / n_words,
              np.log1p(len(lines)), 1 - len(set(lines)) / len(lines), n / len(lines) / 1000,
              sum(w.isupper() for w in words) / n_words, sum(w[:1].isupper() for w in words) / n_words,
              sum(w[-1:].isalnum() or w[-1] > 127 for w in words) / n_words]
    return [float(x) for x in shapes] + (counts[_PUNCT] / n_words).tolist()


N_FEATURES = 22 + len(_PUNCT)


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float
    cut: float

    def rank(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.rank(x) - self.threshold) + np.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def pairs(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differences of rows labelled 1 and rows labelled 0: each row meets ``ROUNDS`` of the other label, or all where these are fewer."""
    good, bad = z[y == 1], z[y == 0]
    few, n = min(len(good), len(bad)), max(len(good), len(bad))
    at, turns = np.arange(n), min(ROUNDS, few)
    shifts = [r * few // turns for r in range(turns)]
    more, less, sign = (good, bad, 1) if len(good) >= len(bad) else (bad, good, -1)
    return np.concatenate([sign * (more - less[(at + k) % few]) for k in shifts]) if few else z[:0]


def loss_terms(diff: np.ndarray, w: np.ndarray) -> np.ndarray:
    """(pairs, gradient, Hessian) of the logistic loss of ``diff``, summed over its rows and laid out flat."""
    p = 1 / (1 + np.exp(np.clip(diff @ w, -40, 40)))        # chance given to the wrong order
    return np.concatenate([[len(diff)], diff.T @ p, ((diff * (p * (1 - p))[:, None]).T @ diff).ravel()])


def newton(terms: Callable[[np.ndarray], np.ndarray], width: int, ridge: float = 1e-3) -> np.ndarray:
    """Weights that minimise the mean logistic loss, whose sums ``terms`` gives for any weights."""
    w = np.zeros(width)
    for _ in range(25):
        sums = terms(w)
        n, grad, hess = sums[0], sums[1:width + 1], sums[width + 1:].reshape(width, width)
        step = np.linalg.solve(hess / n + (ridge + 1e-9) * np.eye(width), ridge * w - grad / n)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def threshold(bins: np.ndarray, good: np.ndarray, bad: np.ndarray) -> int:
    """The bin at whose lower edge the threshold lies; ``bins`` ascend, with their numbers of rows labelled 1 and 0."""
    below = np.cumsum(good + bad)
    n_good, n_bad = good.sum(), bad.sum()
    level = n_bad / (n_good + n_bad)
    levels = np.clip(level * np.linspace(0.7, 1.3, 25), 0, 1)
    at = np.searchsorted(below, levels * (below[-1] - 1), side="right").clip(0, len(bins) - 1)
    good_below, bad_below = np.cumsum(good) - good, np.cumsum(bad) - bad
    balanced = ((n_good - good_below[at]) / n_good + bad_below[at] / n_bad) / 2
    return int(bins[at[max(range(len(at)), key=lambda i: (balanced[i], -abs(levels[i] - level)))]])


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8)


def _no_model(width: int) -> Ranker:
    return Ranker(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0, 0.5)


def _ranker(mean: np.ndarray, scale: np.ndarray, w: np.ndarray, deviation: float, counts: Callable[[float], tuple], cut: float) -> Ranker:
    """``counts``: for a width of bins, (bins, good, bad) of the ranks."""
    width = max(deviation, 1e-9) / BINS
    return Ranker(mean, scale, w, threshold(*counts(width)) * width, 2 / max(deviation, 1e-9), cut)


def fit(x: np.ndarray, y: np.ndarray, cut: float = 0.3, ridge: float = 1e-3) -> Ranker:
    """The model of rows in memory; ``fit_table`` does the same for a table."""
    if len(np.unique(y)) < 2:
        return _no_model(x.shape[1])
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = _standard(x, mean, scale)
    diff = pairs(z, y)
    w = newton(lambda at: loss_terms(diff, at), x.shape[1], ridge)
    ranks = z @ w

    def counts(width):
        bins, place = np.unique(np.floor(ranks / width).astype(np.int64), return_inverse=True)
        return bins, np.bincount(place, y == 1), np.bincount(place, y == 0)

    return _ranker(mean, scale, w, float(ranks.std()), counts, cut)


def _x(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    return batch[column].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, N_FEATURES)


def _summed(table: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of ``of`` over the batches of ``table``: one row a task, added in the order of the tasks."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    rows = table.mapInArrow(run, "s array<double>").collect()
    return np.sum([r.s for r in rows], axis=0)


def fit_table(labelled: DataFrame, scratch: Scratch, cut: float = 0.3) -> Ranker:
    """Bradley-Terry weights and threshold from all rows of ``labelled``: doc_id (each once), quality, x."""
    number = {r.quality: r["count"] for r in labelled.groupBy("quality").count().collect()}
    if len(number) < 2:
        return _no_model(N_FEATURES)
    n, few = sum(number.values()), min(number.values())
    mean = _summed(labelled, lambda b: _x(b).sum(axis=0)) / n
    scale = np.maximum(np.sqrt(_summed(labelled, lambda b: ((_x(b) - mean) ** 2).sum(axis=0)) / n), 1e-6)

    def differences(group):
        group = group.sort_by("doc_id").combine_chunks()
        diff = pairs(_standard(_x(group.to_batches()[0]), mean, scale), group["quality"].to_numpy()).astype(np.float32)
        return pa.table({"x": pa.FixedSizeListArray.from_arrays(pa.array(diff.ravel()), N_FEATURES).cast(pa.list_(pa.float32()))})

    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(max(few // BUCKET, 1))).alias("bucket")
    dealt = labelled.select(bucket, "doc_id", "quality", "x").groupBy("bucket").applyInArrow(differences, "x array<float>")
    met = scratch.save(dealt, "pairs")
    w = newton(lambda at: _summed(met, lambda b: loss_terms(_x(b), at)), N_FEATURES)
    scratch.drop("pairs")
    ranks = lambda b: _standard(_x(b), mean, scale) @ w     # noqa: E731
    middle = _summed(labelled, lambda b: np.array([ranks(b).sum()]))[0] / n
    deviation = float(np.sqrt(_summed(labelled, lambda b: np.array([((ranks(b) - middle) ** 2).sum()]))[0] / n))

    def counts(width):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array(np.floor(ranks(b) / width).astype(np.int64)), b["quality"]], names=["bin", "quality"])

        # Ranks lie within the bounds of clipped features, so the bins are bounded whatever the rows.
        rows = labelled.mapInArrow(run, "bin long, quality int").groupBy("bin").agg(
            F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")).orderBy("bin").collect()
        return tuple(np.array([r[i] for r in rows]) for i in range(3))

    return _ranker(mean, scale, w, deviation, counts, cut)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def labelled_rows(described: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, quality, x) of every labelled row that is not held out, one of a repeated doc_id; ``described``: doc_id, x."""
    one = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("quality"))
    first = Window.partitionBy("doc_id").orderBy("x")
    rows = described.join(one, "doc_id").select("doc_id", "quality", "x")
    return rows.withColumn("k", F.row_number().over(first)).where("k = 1").drop("k")


def score(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """(row, score, predicted): ``row`` holds the columns of ``docs`` other than text.

    ``docs``: doc_id and text among others; ``labels``: doc_id, quality.
    """
    scratch = Scratch(docs.sparkSession, "pair-ranking")
    carried = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*carried).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def describe(batches):
        for batch in batches:
            x = pa.array([features(t) for t in batch["text"].to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["row"], batch["doc_id"], x], names=["row", "doc_id", "x"])

    described = scratch.save(rows.mapInArrow(describe, rows.drop("text").schema.add("x", T.ArrayType(T.DoubleType()))), "features")
    labelled = scratch.save(labelled_rows(described.select("doc_id", "x"), labels.select(F.col("doc_id").cast("long"), "quality")), "labelled")
    model = fit_table(labelled, scratch, cut)
    scratch.drop("labelled")
    schema = rows.select("row").schema.add("score", "double").add("predicted", "integer")

    def run(batches):
        for batch in batches:
            s = model.score(_x(batch))
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(s), pa.array((s >= cut).astype(np.int32))], names=["row", "score", "predicted"])

    return described.select("row", "x").mapInArrow(run, schema)
