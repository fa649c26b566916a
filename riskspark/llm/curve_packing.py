"""Packing along a space-filling curve.

Each document's token counts are hashed into a signed vector of
``HASHED`` buckets, scaled to length 1 and projected on ``DIMS`` fixed random
directions. The coordinates, cut to ``BITS`` bits each, give the position on
the Hilbert curve. Documents are sorted by that key and concatenated, and the
stream is cut every ``capacity`` tokens: neighbours on the curve share
sequences, every sequence but the last is full, and a document longer than
what is left of a sequence goes on in the next.

Order and cut positions are global. The rows that are sorted hold a key and
a length only: they are range-partitioned by (key, doc_id, row), so equal
keys (copies) are split over tasks as any others; each task sums its own
lengths, and the tasks' totals, one row each, are summed up for the tasks'
offsets. The ids join in once, to be cut into pieces.

Edge cases. Null text is empty: the document is the end id alone. Repeated
rows are packed each on its own, in the order of the written table. An empty
table gives no pieces. A very long text is cut into many pieces.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import Scratch
from riskspark.llm.tokens import encoder

HASHED, DIMS, BITS, SEED = 256, 4, 8, 20


@lru_cache(maxsize=1)
def _tables(n_ids: int):
    """Bucket and sign of each id, and the directions: fixed by the seed."""
    rnd = np.random.default_rng(SEED)
    bucket, sign = rnd.integers(0, HASHED, n_ids), rnd.choice([-1.0, 1.0], n_ids)
    return bucket, sign, rnd.standard_normal((HASHED, DIMS))


def coordinates(ids: list[np.ndarray], n_ids: int) -> np.ndarray:
    """(documents, DIMS) integers below 2**BITS."""
    bucket, sign, directions = _tables(n_ids)
    vectors = np.zeros((len(ids), HASHED))
    for row, x in zip(vectors, ids):
        if len(x):
            row += np.bincount(bucket[x], sign[x], HASHED)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    spread = (np.tanh(vectors @ directions) + 1) / 2      # a unit vector's projections are nearly standard normal
    return np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points below 2**bits, one row each."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):         # undo the turns of each level, coarsest first
        low = (1 << level) - 1
        for i in range(dims):
            turned = (x[i] >> level & 1).astype(bool)
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):                     # to the Gray code's rank
        x[i] ^= x[i - 1]
    parity = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        parity ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= parity
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> level & 1)
    return key


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, n_ids: int = 1 << 16) -> DataFrame:
    """(doc_id, key, n, ids): each row's curve key, number of ids with the end id, and the ids as bytes of two each."""

    def run(batches):
        enc, end = encoder(tokenizer), np.array([end_id], "<u2").tobytes()
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            for at in range(0, len(texts), 1000):
                ids = enc.encode(texts[at:at + 1000])
                keys = hilbert_keys(coordinates([np.frombuffer(x, "<u2") for x in ids], n_ids), BITS)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(at, 1000), pa.array(keys), pa.array([len(x) // 2 + 1 for x in ids], pa.int64()),
                     pa.array([x + end for x in ids], pa.binary())], names=["doc_id", "key", "n", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, key long, n long, ids binary")


def global_starts(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """(row, at): the sum of ``n`` over all rows before each row, in the order of ``order`` then ``row``."""

    def run(batches):
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch["n"].to_numpy()
            ends = total + np.cumsum(n)
            total = int(ends[-1]) if len(ends) else total
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(np.full(len(n), part, np.int64)), pa.array(ends - n), batch["n"]], names=["row", "part", "local", "n"])

    ordered = rows.select("row", "n", *order).repartitionByRange(*order, "row").sortWithinPartitions(*order, "row")
    local = scratch.save(ordered.mapInArrow(run, "row long, part long, local long, n long"), "starts")
    parts = local.groupBy("part").agg(F.sum("n").alias("n"))       # one row per task of the range exchange
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    return local.join(F.broadcast(parts), "part").select("row", (F.col("base") + F.col("local")).alias("at"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, scratch: Scratch | None = None) -> DataFrame:
    """Pieces: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``docs``: doc_id, text. ``ids`` are the piece's ids as unsigned
    little-endian 32-bit integers; ``start`` counts the document's ids before
    the piece; ``offset`` counts the ids before it in its sequence.
    """
    scratch = scratch or Scratch(docs.sparkSession, "curve-packing")
    rows = tokenized(docs.select("doc_id", "text"), tokenizer, end_id).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.save(rows, "tokens")          # row numbers hold from here on
    starts = global_starts(rows, ["key", "doc_id"], scratch)

    def cut(batches):
        for batch in batches:
            out = {c: [] for c in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
            for doc, at, data in zip(batch["doc_id"].to_pylist(), batch["at"].to_pylist(), batch["ids"]):
                ids = np.frombuffer(data.as_buffer(), "<u2").astype("<u4")
                edges = [0, *range(capacity - at % capacity, len(ids), capacity), len(ids)]
                for a, b in zip(edges, edges[1:]):
                    out["doc_id"].append(doc), out["start"].append(a), out["length"].append(b - a)
                    out["ids"].append(ids[a:b].tobytes()), out["doc_tokens"].append(len(ids))
                    out["sequence_id"].append((at + a) // capacity), out["offset"].append((at + a) % capacity)
            kinds = {"ids": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()], names=list(out))

    # Starts grow with the documents: never broadcast.
    return rows.join(starts.hint("merge"), "row").select("doc_id", "at", "ids").mapInArrow(
        cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
