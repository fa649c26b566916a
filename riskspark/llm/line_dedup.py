"""Reversible line dedup: sharded cuckoo filters backed by exact reference-count tables.

A line's key is the line stripped of blanks at both ends, with A-Z
lower-cased. The index keeps two exact tables and one filter per shard:

* ``refs``: one row per (key, document) with the number of such lines;
* ``counts``: one row per key: how many documents hold it, and the
  smallest of them, its owner;
* ``filters``: per shard a cuckoo filter of the keys that two documents or
  more hold.

Inserting documents adds their reference rows, recounts the keys they touch
and inserts the keys that became shared; deleting documents removes
their rows, recounts, and deletes from the filters the keys that are no
longer shared. A filter never misses a shared key; a line that it takes
for shared is looked up in ``counts``. So ``apply`` after a deletion
gives what it would have given had the documents never come.

A shared key's lines are dropped from every document but its owner; keys of
fewer than ``min_chars`` code points are no keys. Keys are compared by two
64-bit hashes. Scale: a shard holds a bounded number of keys, as the number
of shards follows the number of keys; reference rows meet their filter in
slices of a shard (a hot line's shard gets as many slices as its rows need),
streamed past the filter, so no task holds a shard's rows.

Edge cases. Null text or empty: one empty line, nothing dropped. Rows
with equal doc_id (null too) are one document: lines found only in
them are not shared. Empty tables give empty results.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import Scratch

BLANK_BYTES = b" \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]
REF_SCHEMA = "h1 long, h2 long, doc_id long, n long"
SLOTS = 4
#: A null doc_id's place in the tables, which hold no nulls.
NO_ID = -(2**63)


# ---------------------------------------------------------------- cuckoo filter

class CuckooFilter:
    """16-bit fingerprints, four to a bucket; partial-key cuckoo hashing with deletion."""

    def __init__(self, n_buckets: int, cells: np.ndarray | None = None):
        self.n_buckets = n_buckets   # a power of two
        self.cells = np.zeros((n_buckets, SLOTS), np.uint16) if cells is None else cells
        self.stash: list[tuple[int, int]] = []

    @classmethod
    def for_keys(cls, n: int) -> "CuckooFilter":
        return cls(1 << max(2, int(np.ceil(np.log2(max(n, 1) / (SLOTS * 0.8) + 1)))))

    def places(self, h1: np.ndarray, h2: np.ndarray):
        mask = self.n_buckets - 1
        fp = (h2.astype(np.uint64) >> np.uint64(48)).astype(np.int64)
        fp = np.where(fp == 0, 1, fp)
        first = (h1.astype(np.uint64) >> np.uint64(20)).astype(np.int64) & mask
        return fp, first, first ^ self._jump(fp)

    def _jump(self, fp):
        return ((fp * 0x5BD1E995) >> 7) & (self.n_buckets - 1)

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> None:
        cells = self.cells
        for fp, a, b in zip(*(x.tolist() for x in self.places(h1, h2))):
            for turn in range(500):
                for at in (a, b):
                    free = np.flatnonzero(cells[at] == 0)
                    if len(free):
                        cells[at, free[0]] = fp
                        break
                else:
                    slot = turn % SLOTS     # put out an entry, which moves to its other bucket
                    fp, cells[b, slot] = int(cells[b, slot]), fp
                    a, b = b, b ^ int(self._jump(fp))
                    continue
                break
            else:
                self.stash.append((fp, min(a, b)))

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        for fp, a, b in zip(*(x.tolist() for x in self.places(h1, h2))):
            for at in (a, b):
                found = np.flatnonzero(self.cells[at] == fp)
                if len(found):
                    self.cells[at, found[0]] = 0
                    break
            else:
                for entry in ((fp, min(a, b)),):
                    if entry in self.stash:
                        self.stash.remove(entry)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        fp, a, b = self.places(h1, h2)
        found = ((self.cells[a] == fp[:, None]) | (self.cells[b] == fp[:, None])).any(axis=1)
        for f, at in self.stash:
            found |= (fp == f) & ((a == at) | (b == at))
        return found

    def dump(self) -> bytes:
        flat = [x for entry in self.stash for x in entry]
        return struct.pack("<qq", self.n_buckets, len(self.stash)) + struct.pack(f"<{len(flat)}q", *flat) + self.cells.tobytes()

    @classmethod
    def load(cls, data: bytes) -> "CuckooFilter":
        n, stashed = struct.unpack_from("<qq", data)
        flat = struct.unpack_from(f"<{2 * stashed}q", data, 16)
        out = cls(n, np.frombuffer(data, np.uint16, offset=16 + 16 * stashed).reshape(n, SLOTS).copy())
        out.stash = list(zip(flat[::2], flat[1::2]))
        return out


# ---------------------------------------------------------------- lines and keys

def line_keys(text: str | None, min_chars: int) -> list[tuple[int, int] | None]:
    """The key hashes of each line, None for a line that has no key."""
    out = []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        key = line.strip(BLANK_BYTES).lower()      # bytes.lower changes A-Z only
        if len(key) < min_chars or len(key.decode("utf-8", "surrogatepass")) < min_chars:
            out.append(None)
        else:
            h = xxhash.xxh3_128_intdigest(key)
            out.append(((h >> 64) - 2**63, (h & (2**64 - 1)) - 2**63))
    return out


def line_refs(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(h1, h2, doc_id, n): one row per key and document row. ``docs``: doc_id, text."""

    def run(batches):
        for batch in batches:
            h1, h2, ids, ns = [], [], [], []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                seen: dict[tuple[int, int], int] = {}
                for k in line_keys(text, min_chars):
                    if k is not None:
                        seen[k] = seen.get(k, 0) + 1
                for (a, b), n in seen.items():
                    h1.append(a), h2.append(b), ids.append(doc), ns.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (h1, h2, ids, ns)], names=["h1", "h2", "doc_id", "n"])

    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, REF_SCHEMA)


# ---------------------------------------------------------------- the index

@dataclass(frozen=True)
class LineIndex:
    """The state after some insertions and deletions: written tables."""

    refs: DataFrame        # h1, h2, doc_id, n
    counts: DataFrame      # h1, h2, n_docs, owner
    filters: DataFrame     # shard, payload
    n_shards: int
    min_chars: int
    scratch: Scratch
    keys_per_shard: int = 250_000


def _shard(n_shards: int):
    return F.pmod(F.col("h1"), F.lit(n_shards)).cast("int")


def _count(refs: DataFrame) -> DataFrame:
    return refs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("owner"))


def _build_filters(counts: DataFrame, n_shards: int) -> DataFrame:
    def build(key, frame):
        filt = CuckooFilter.for_keys(len(frame) * 2)     # room to insert as many again
        filt.insert(frame["h1"].to_numpy(np.int64), frame["h2"].to_numpy(np.int64))
        import pandas as pd

        return pd.DataFrame({"shard": [key[0]], "payload": [filt.dump()]})

    shared = counts.where("n_docs >= 2").select(_shard(n_shards).alias("shard"), *KEY)
    return shared.groupBy("shard").applyInPandas(build, "shard int, payload binary")


def build(docs: DataFrame, min_chars: int = 10, keys_per_shard: int = 250_000, scratch: Scratch | None = None) -> LineIndex:
    """The index of a first batch of documents (doc_id, text)."""
    scratch = scratch or Scratch(docs.sparkSession, "line-dedup")
    refs = scratch.save(line_refs(docs, min_chars).groupBy(*KEY, "doc_id").agg(F.sum("n").alias("n")), "refs")
    counts = scratch.save(_count(refs), "counts")
    n_shards = max(1, -(-counts.count() // keys_per_shard))
    filters = scratch.save(_build_filters(counts, n_shards), "filters")
    return LineIndex(refs, counts, filters, n_shards, min_chars, scratch, keys_per_shard)


def _changed(index: LineIndex, refs: DataFrame, touched: DataFrame) -> LineIndex:
    """The index with other ``refs``, of which only the ``touched`` keys differ."""
    save = index.scratch.save
    touched = save(touched.select(*KEY).distinct(), "touched")
    now = save(_count(refs.join(touched, KEY, "left_semi")), "recounted")
    counts = save(index.counts.join(touched, KEY, "left_anti").unionByName(now), "counts")
    wanted = -(-counts.count() // index.keys_per_shard)
    if wanted > index.n_shards:                    # more keys than the shards are to hold: deal all out anew
        return LineIndex(refs, counts, save(_build_filters(counts, wanted), "filters"), wanted, index.min_chars, index.scratch, index.keys_per_shard)
    before = index.counts.join(touched, KEY, "left_semi").where("n_docs >= 2").select(*KEY, F.lit(-1).alias("step"))
    after = now.where("n_docs >= 2").select(*KEY, F.lit(1).alias("step"))
    steps = before.union(after).groupBy(*KEY).agg(F.sum("step").alias("step")).where("step != 0")
    steps = steps.withColumn("shard", _shard(index.n_shards))

    def update(key, old, new):
        import pandas as pd

        filt = CuckooFilter.load(bytes(old["payload"].iloc[0])) if len(old) else CuckooFilter.for_keys(2 * len(new))
        for step, act in ((-1, filt.delete), (1, filt.insert)):
            part = new[new["step"] == step]
            act(part["h1"].to_numpy(np.int64), part["h2"].to_numpy(np.int64))
        return pd.DataFrame({"shard": [key[0]], "payload": [filt.dump()], "full": [len(filt.stash) > 0]})

    moved = index.filters.groupBy("shard").cogroup(steps.groupBy("shard")).applyInPandas(
        update, "shard int, payload binary, full boolean")
    moved = save(moved, "filters")
    n_shards, filters = index.n_shards, moved.select("shard", "payload")
    if moved.where("full").limit(1).count():       # a filter has outgrown its table: deal the keys out anew
        n_shards *= 2
        filters = save(_build_filters(counts, n_shards), "filters")
    return LineIndex(refs, counts, filters, n_shards, index.min_chars, index.scratch, index.keys_per_shard)


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """The index with more documents. A doc_id that it holds already gets the new lines besides its own."""
    batch = index.scratch.save(line_refs(docs, index.min_chars), "batch")
    refs = index.scratch.save(index.refs.unionByName(batch).groupBy(*KEY, "doc_id").agg(F.sum("n").alias("n")), "refs")
    return _changed(index, refs, batch)


def delete(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """The index without the documents of ``doc_ids`` (doc_id)."""
    ids = doc_ids.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id")).distinct()
    gone = index.scratch.save(index.refs.join(ids, "doc_id", "left_semi"), "gone")
    refs = index.scratch.save(index.refs.join(ids, "doc_id", "left_anti").select(*index.refs.columns), "refs")
    return _changed(index, refs, gone)


def _maybe_shared(index: LineIndex, refs: DataFrame, rows_per_slice: int) -> DataFrame:
    """The reference rows that their shard's filter takes for shared.

    Rows and filters are sorted together so that each slice of a shard
    starts with its filter, and streamed.
    """
    shards = refs.groupBy(_shard(index.n_shards).alias("shard")).agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / rows_per_slice)).cast("int").alias("slices"))
    shards = index.scratch.save(shards, "shards")
    empty = F.lit(None)
    rows = refs.withColumn("shard", _shard(index.n_shards)).join(shards, "shard").select(
        "shard", F.pmod(F.xxhash64("doc_id"), F.col("slices")).cast("int").alias("slice"),
        *KEY, "doc_id", empty.cast("binary").alias("payload"))
    filters = index.filters.join(shards, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
        empty.cast("long").alias("h1"), empty.cast("long").alias("h2"), empty.cast("long").alias("doc_id"), "payload")
    both = filters.unionByName(rows).repartition("shard", "slice").sortWithinPartitions(
        "shard", "slice", F.col("payload").isNull())

    def probe(batches):
        filt, at = None, None
        for batch in batches:
            shard, part, fresh = batch["shard"].to_numpy(), batch["slice"].to_numpy(), batch["payload"].is_valid().to_numpy(zero_copy_only=False)
            h1, h2, ids = (batch[c].fill_null(0).to_numpy() for c in ("h1", "h2", "doc_id"))
            cuts = np.flatnonzero(np.r_[True, (np.diff(shard) != 0) | (np.diff(part) != 0)])
            keep = np.zeros(len(shard), bool)
            for a, b in zip(cuts, np.r_[cuts[1:], len(shard)]):
                if (shard[a], part[a]) != at:
                    at, filt = (shard[a], part[a]), None     # a shard without shared keys has no filter
                if fresh[a]:
                    filt, a = CuckooFilter.load(batch["payload"][int(a)].as_py()), a + 1
                if filt is not None and a < b:
                    keep[a:b] = filt.contains(h1[a:b], h2[a:b])
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (h1, h2, ids)], names=["h1", "h2", "doc_id"])

    return both.mapInArrow(probe, "h1 long, h2 long, doc_id long")


def dropped_keys(index: LineIndex, refs: DataFrame, rows_per_slice: int = 1_000_000) -> DataFrame:
    """(doc_id, keys): the keys that each document loses, an array bounded by its own lines."""
    shared = index.counts.where("n_docs >= 2").select(*KEY, "owner")
    sure = _maybe_shared(index, refs, rows_per_slice).join(shared, KEY).where(F.col("doc_id") != F.col("owner"))
    return sure.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("keys"))


def apply(index: LineIndex, docs: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """(row, kept_text, n_lines, n_dropped): each document with the lines it keeps.

    ``row`` holds all columns of ``docs`` (doc_id and text among them). The
    documents must be in the index; ``refs`` saves reading their lines again.
    """
    min_chars = index.min_chars
    drops = dropped_keys(index, line_refs(docs, min_chars) if refs is None else refs)
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    joined = rows.join(drops, "doc_id", "left").select("row", "text", "keys")
    done = F.array().cast("array<struct<h1:bigint,h2:bigint>>")
    schema = joined.select("row", F.col("text").alias("kept_text")).schema.add("n_lines", "long").add("n_dropped", "long")

    def run(batches):
        for batch in batches:
            texts, lines, lost = [], [], []
            for text, keys in zip(batch["text"].to_pylist(), batch["keys"].to_pylist()):
                n, m = text.count("\n") + 1, 0
                if keys:
                    out = {(k["h1"], k["h2"]) for k in keys}
                    stay = [s for s, k in zip(text.split("\n"), line_keys(text, min_chars)) if k not in out]
                    m, text = n - len(stay), "\n".join(stay)
                texts.append(text), lines.append(n), lost.append(m)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(lost, pa.int64())],
                names=["row", "kept_text", "n_lines", "n_dropped"])

    return joined.withColumn("keys", F.coalesce("keys", done)).mapInArrow(run, schema)


def dedup(docs: DataFrame, min_chars: int = 10, scratch: Scratch | None = None) -> DataFrame:
    """Index ``docs`` and apply the index to them."""
    index = build(docs.select("doc_id", "text"), min_chars, scratch=scratch)
    return apply(index, docs, index.refs)


