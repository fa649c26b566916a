"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: words are lower-cased (A-Z) runs of non-blanks, shingles of
``shingle`` words are hashed by XXH64, and a bit of the fingerprint is 1 if
it is set in over half of the hashes.

Links (at most ``max_bits`` differing bits) come from an index whose top
level is distributed and whose lower levels live in a task:

* top nodes: the 64 positions are cut into ``max_bits + 1`` blocks. Two
  fingerprints within the distance agree in one block at least, so each
  (block, value), a masked bit pattern with many members, is a node, and
  only members of a node are compared. A node with over ``max_node``
  members is factored again by blocks of its free positions, by the same
  argument, up to ``DEPTH`` times; the last level takes any size, so no
  member is dropped.
* lower nodes: a node's members are sorted by Gray rank, so that neighbours
  share long bit patterns. Runs of ``FANOUT`` members, and runs of such
  runs, carry the mask of the positions on which all agree and their
  common pattern. A query adds up its differences on the way down, counting
  at each level only the positions that are new there, and leaves a whole
  run once the sum passes ``max_bits``.

Equal fingerprints are one member, so copies cost nothing here. A task emits
a forest of the links it finds, not all pairs; components are found over all
forests together. Edge cases: null or blank text has fingerprint 0 and links
like any other; rows with equal doc_id are one document; a null doc_id
is a document of its own kind, larger than no other: it is given the
component of its fingerprint. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import Scratch
from riskspark.llm.components import connected_components

SEED = 42
FANOUT = 8
#: Top levels. The last one takes nodes of any size; by then a node's members agree in over half of their positions.
DEPTH = 4


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, shingle: int) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()    # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    ones, n = np.zeros(64, np.int64), len(words) - shingle + 1
    digest, block = xxhash.xxh64_intdigest, 8192
    for at in range(0, n, block):        # blocks bound the memory of a very long text
        part = words[at:min(at + block, n) + shingle - 1]
        hashes = [digest(b" ".join(x), SEED) for x in zip(*(part[i:] for i in range(shingle)))]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp): fp as a signed long, one row per row of ``docs`` (doc_id, text)."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- lower index levels

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a codeword in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """Masked patterns over members that are sorted by (node, Gray rank)."""

    def __init__(self, node: np.ndarray, fps: np.ndarray):
        order = np.lexsort((gray_rank(fps), node))
        self.node, self.fps, self.order = node[order], fps[order], order
        self.levels = []       # from the leaves up: pattern, mask, first and last child, node
        pattern, mask, own = self.fps, np.full(len(fps), ~np.uint64(0)), self.node
        first, last = np.arange(len(fps)), np.arange(len(fps)) + 1
        while True:
            self.levels.append((pattern, mask, first, last, own))
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
            if len(starts) == len(own):
                break
            sizes = np.diff(np.r_[starts, len(own)])
            at = np.arange(len(own)) - np.repeat(starts, sizes)
            cut = np.flatnonzero(at % FANOUT == 0)
            ands = np.bitwise_and.reduceat(pattern, cut)
            ors = np.bitwise_or.reduceat(pattern, cut)
            held = np.bitwise_and.reduceat(mask, cut)
            mask, pattern, own = held & ~(ands ^ ors), ands, own[cut]
            first, last = cut, np.r_[cut[1:], len(at)]
        self.top = starts

    def pairs(self, max_bits: int, block: int = 4096):
        """Arrays (i, j) of sorted positions, i < j, of the members of a node within the distance; in blocks of queries."""
        top_pattern, top_mask, *_ , top_node = self.levels[-1]
        for a in range(0, len(self.fps), block):
            q = np.arange(a, min(a + block, len(self.fps)))
            k = np.searchsorted(top_node, self.node[q])
            diff = np.bitwise_count((self.fps[q] ^ top_pattern[k]) & top_mask[k]).astype(np.int64)
            keep = diff <= max_bits
            q, k, diff = q[keep], k[keep], diff[keep]
            for level in range(len(self.levels) - 1, 0, -1):
                _, mask, first, last, _ = self.levels[level]
                below_pattern, below_mask = self.levels[level - 1][:2]
                n = last[k] - first[k]
                child = np.repeat(first[k] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                q, k, diff = np.repeat(q, n), np.repeat(k, n), np.repeat(diff, n)
                new = below_mask[child] & ~mask[k]       # positions that this level is the first to fix
                diff = diff + np.bitwise_count((self.fps[q] ^ below_pattern[child]) & new)
                keep = diff <= max_bits
                q, k, diff = q[keep], child[keep], diff[keep]
            keep = k > q
            yield q[keep], k[keep]


def forest(index: GrayIndex, ids: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (id, smaller id) that span the components of an index's members."""
    ids = ids[index.order]
    root = np.arange(len(ids))
    for i, j in index.pairs(max_bits):
        while len(i):           # hook the larger root under the smaller, then shorten, until all pairs agree
            a, b = root[i], root[j]
            differ = a != b
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                short = root[root]
                if np.array_equal(short, root):
                    break
                root = short
    linked = root != np.arange(len(ids))
    return ids[linked], ids[root[linked]]


# ---------------------------------------------------------------- top index levels

def _blocks(free: list[int], n: int) -> list[int]:
    """Masks that cut the free positions into n blocks of nearly equal size."""
    cuts = [round(i * len(free) / n) for i in range(n + 1)]
    return [sum(1 << p for p in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _factor(members: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Members (mask, value, fp, id) dealt to the nodes below: one row per block of their node's free positions.

    A mask stands for its node's fixed positions; ``masks`` lists the masks below it.
    """
    cases = None
    for above, below in masks.items():
        made = F.array(*[F.lit(_signed(m)) for m in below])
        cases = F.when(F.col("mask") == _signed(above), made) if cases is None else cases.when(F.col("mask") == _signed(above), made)
    out = members.withColumn("mask", F.explode(cases))
    return out.withColumn("value", F.col("fp").bitwiseAND(F.col("mask"))).select("mask", "value", "fp", "id")


def spanning_links(members: DataFrame, max_bits: int, max_node: int, scratch: Scratch) -> DataFrame:
    """(id, to): links between members (fp, id; fp distinct) that leave the components of all links within the distance as they are."""
    n = max_bits + 1
    level = members.select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("value"), "fp", "id")
    masks, found = {0: _blocks(list(range(64)), n)}, None
    for depth in range(DEPTH):
        level = scratch.save(_factor(level, masks), f"level-{depth}")
        free = {m: [p for p in range(64) if not m >> p & 1] for below in masks.values() for m in below}
        masks = {m: [m | x for x in _blocks(p, n)] for m, p in free.items() if len(p) >= 2 * n}
        sizes = level.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        level = level.join(scratch.save(sizes, f"sizes-{depth}"), ["mask", "value"])
        big = F.col("size") > max_node
        last = depth == DEPTH - 1 or not masks
        done = level if last else level.where(~big)
        links = scratch.save(_search(done, max_bits), f"links-of-level-{depth}")
        found = links if found is None else found.union(links)
        if last:
            break
        level = scratch.save(level.where(big).select("mask", "value", "fp", "id"), f"big-{depth}")
        if not level.limit(1).count():
            break
    return found


def _search(members: DataFrame, max_bits: int) -> DataFrame:
    """Links inside each node (mask, value, fp, id). A task streams its nodes through one index at a time."""
    rows_at_once = 20_000

    def links(frames):
        node = np.concatenate([f[0] for f in frames])
        index = GrayIndex(node, np.concatenate([f[1] for f in frames]))
        a, b = forest(index, np.concatenate([f[2] for f in frames]), max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["id", "to"])

    def run(batches):
        held, n, serial, last = [], 0, -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            mask, value = batch["mask"].to_numpy(), batch["value"].to_numpy()
            new = np.r_[last != (mask[0], value[0]), (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])]
            node, last = serial + np.cumsum(new), (mask[-1], value[-1])
            fps, ids, serial = batch["fp"].to_numpy().view(np.uint64), batch["id"].to_numpy(), node[-1]
            if n >= rows_at_once and new.any():     # whole nodes only: cut before the first new one
                cut = int(np.argmax(new))
                held.append((node[:cut], fps[:cut], ids[:cut]))
                yield links(held)
                held, n, node, fps, ids = [], 0, node[cut:], fps[cut:], ids[cut:]
            held.append((node, fps, ids))
            n += len(node)
        if n:
            yield links(held)

    dealt = members.select("mask", "value", "fp", "id").repartition("mask", "value").sortWithinPartitions("mask", "value")
    return dealt.mapInArrow(run, "id long, to long")


# ---------------------------------------------------------------- the operator

def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, max_node: int = 4096,
                    scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs`` (doc_id, text): component_id is the smallest doc_id reachable by links."""
    scratch = scratch or Scratch(docs.sparkSession, "simhash")
    prints = scratch.save(fingerprints(docs.select("doc_id", "text"), shingle), "fingerprints")
    one = scratch.save(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "members")
    named = one.where("id IS NOT NULL")
    # Rows of one doc_id with different texts link their fingerprints too.
    texts = prints.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("f"), F.max("fp").alias("g")).where("f != g")
    held = scratch.save(prints.join(texts.select("doc_id"), "doc_id", "left_semi").join(one, "fp").select("doc_id", "id"), "twins")
    twins = held.join(held.groupBy("doc_id").agg(F.min("id").alias("to")), "doc_id").select("id", "to").where("id != to")
    links = spanning_links(named.select("fp", "id"), max_bits, max_node, scratch).union(twins)
    roots = connected_components(scratch.save(links, "links"), scratch)
    labels = one.join(roots, one["id"] == roots["node"], "left").select("fp", F.coalesce("root", "id").alias("component_id"))
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, scratch: Scratch | None = None) -> DataFrame:
    """The documents that are the smallest of their component, with all columns (rows without a doc_id stay)."""
    found = near_duplicates(docs, shingle, max_bits, scratch=scratch)
    lost = found.where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(lost, "doc_id", "left_anti").select(docs.columns)
